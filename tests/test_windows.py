import pytest

from helpers import at, trade, trades_df
from tapewright.config import DEFAULTS
from tapewright.operators.reports import stream_symbol_aggregates
from tapewright.operators.windows import window_aggregates, window_anomalies

LOOSE = DEFAULTS.with_options(
    spread_threshold_pct=50.0, large_trade_value=100.0, high_trade_count=3
)


def test_window_edges_and_metrics(spark):
    trades = trades_df(
        spark,
        [
            trade("A", 1, 10.0, 1.0, 0),
            trade("A", 2, 20.0, 2.0, 59.999),
            trade("A", 3, 30.0, 1.0, 60),  # starts the next window
        ],
    )
    rows = window_aggregates(trades, LOOSE).orderBy("window_start").collect()
    assert [(r["window_start"], r["window_end"]) for r in rows] == [(at(0), at(60)), (at(60), at(120))]
    first = rows[0]
    assert (first["avg_price"], first["volume"], first["notional_volume"]) == (15.0, 3.0, 50.0)
    assert first["price_spread_pct"] == pytest.approx(10 / 15 * 100)
    assert rows[1]["price_spread_pct"] == 0.0


def test_thresholds_are_inclusive_and_reasons_ordered(spark):
    trades = trades_df(
        spark,
        [trade("calm", 1, 10.0)]
        + [trade("edge", 10 + i, 100.0, 1.0) for i in range(3)]
        + [trade("wide", 20, 60.0), trade("wide", 21, 100.0)],
    )
    rows = {r["symbol"]: r for r in window_aggregates(trades, LOOSE).collect()}
    assert (rows["calm"]["is_anomaly"], rows["calm"]["anomaly_reason"]) == (False, "")
    assert rows["edge"]["anomaly_reason"] == "large_trade,traffic_spike"
    assert rows["wide"]["price_spread_pct"] == 50.0
    assert rows["wide"]["anomaly_reason"] == "price_spread,large_trade"
    assert {r["symbol"] for r in window_anomalies(window_aggregates(trades, LOOSE)).collect()} == {
        "edge", "wide",
    }


def test_weighted_price_equals_direct_mean(spark):
    trades = trades_df(spark, [trade("A", i, 1.0 + i * i, 1.0, i * 17) for i in range(40)])
    row = stream_symbol_aggregates(window_aggregates(trades)).first()
    assert row["avg_price"] == pytest.approx(sum(1.0 + i * i for i in range(40)) / 40)
    assert row["trade_count"] == 40
