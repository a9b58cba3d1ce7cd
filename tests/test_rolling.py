import math
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import trade, trades_df
from tapewright.config import DEFAULTS
from tapewright.operators.moments import with_rolling_moments
from tapewright.operators.rolling import FEATURES, ml_features, rolling_zscore, scaled_features
from tapewright.operators.slicing import series_window


def naive_z(values, window=100, least=20):
    out = []
    for i, x in enumerate(values):
        frame = values[max(0, i + 1 - window) : i + 1]
        std = statistics.stdev(frame) if len(frame) > 1 else 0.0
        out.append((x - statistics.fmean(frame)) / std if len(frame) >= least and std else 0.0)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(0.01, 1e5), min_size=1, max_size=260))
def test_zscores_equal_a_plain_loop(spark, prices):
    rows = [trade("A", i, p, 1.0, i // 3) for i, p in enumerate(prices)]
    made = [r["price_zscore"] for r in rolling_zscore(trades_df(spark, rows)).orderBy("trade_id").collect()]
    assert made == pytest.approx(naive_z(prices), abs=1e-7)


def test_constant_and_short_series(spark):
    rows = [trade("flat", i, 97000.1, 0.1, i) for i in range(150)]
    rows += [trade("short", 1000 + i, float(i * i), 1.0, i) for i in range(1, 20)]
    for row in rolling_zscore(trades_df(spark, rows)).collect():
        assert row["price_zscore"] == 0.0 and row["is_anomaly"] is False


def test_first_scored_row_is_the_twentieth(spark):
    rows = [trade("A", i, 100.0 if i < 19 else 200.0, 1.0, i) for i in range(20)]
    scored = rolling_zscore(trades_df(spark, rows)).orderBy("trade_id").collect()
    assert scored[18]["price_zscore"] == 0.0
    assert scored[19]["price_zscore"] == pytest.approx(19 / math.sqrt(20))
    assert scored[19]["is_anomaly"] is True


@pytest.mark.parametrize("width", [1, 2, 3, 7, 64, 100])
def test_moments_of_any_width(spark, width):
    values = [1e9 if i == 5 else 100.0 + (i * 37 % 11) for i in range(150)]
    rows = [trade("A", i, v, 1.0, i) for i, v in enumerate(values)]
    made = with_rolling_moments(trades_df(spark, rows), series_window(), width, ["price"])
    for i, row in enumerate(made.orderBy("trade_id").collect()):
        frame = values[max(0, i + 1 - width) : i + 1]
        assert row["__last_price_n"] == len(frame)
        assert row["__last_price_mean"] == pytest.approx(statistics.fmean(frame), rel=1e-12)
        if len(frame) > 1:
            assert row["__last_price_std"] == pytest.approx(statistics.stdev(frame), rel=1e-9)
        else:
            assert row["__last_price_std"] is None


def test_nulls_do_not_count(spark):
    rows = [trade("A", i, None if i % 2 else float(i), 1.0, i) for i in range(60)]
    last = with_rolling_moments(trades_df(spark, rows), series_window(), 10, ["price"])
    row = last.filter("trade_id = 59").first()
    assert (row["__last_price_n"], row["__last_price_mean"]) == (5.0, 54.0)


def test_features(spark):
    rows = [trade("A", i, 100.0 * 2**i, 1.0, i) for i in range(3)]
    rows += [trade("B", 50 + i, 10.0, 1.0 + i, i) for i in range(30)]
    made = ml_features(trades_df(spark, rows)).orderBy("trade_id").collect()
    assert [r["price_return"] for r in made[:3]] == [0.0, 1.0, 1.0]
    assert [r["rolling_trade_count"] for r in made[3:]] == [float(min(i, 25)) for i in range(1, 31)]
    assert made[-1]["rolling_trade_value_mean"] == pytest.approx(
        sum(10.0 * (1 + i) for i in range(5, 30)) / 25
    )


def test_scaling(spark):
    rows = [trade("A", i, 5.0, float(i), i) for i in range(1, 11)]
    made = scaled_features(ml_features(trades_df(spark, rows))).orderBy("trade_id").collect()
    quantities = [float(i) for i in range(1, 11)]
    mean, std = statistics.fmean(quantities), statistics.pstdev(quantities)
    assert [r["quantity"] for r in made] == pytest.approx([(q - mean) / std for q in quantities])
    assert all(r["price"] == 0.0 for r in made)  # constant: divided by one
    assert set(FEATURES) <= set(made[0].asDict())


def test_required_columns(spark):
    df = trades_df(spark, [trade("A", 1, 1.0)])
    with pytest.raises(ValueError, match=r"\['price', 'trade_value'\]"):
        rolling_zscore(df.drop("trade_value", "price"), DEFAULTS)
    with pytest.raises(ValueError, match=r"\['trade_id'\]"):
        ml_features(df.drop("trade_id"), DEFAULTS)
