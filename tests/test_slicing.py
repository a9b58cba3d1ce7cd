"""Sliced computation of long series equals one window per symbol, whatever the skew."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import same_rows, trade, trades_df
from tapewright.config import DEFAULTS
from tapewright.operators import slicing
from tapewright.operators.rolling import ml_features, rolling_zscore
from tapewright.operators.sampling import thin_series
from tapewright.operators.slicing import (
    POSITION,
    SLICE,
    Slices,
    hot_intervals,
    plan_slices,
    sampled_borders,
    series_window,
    with_position,
)

UNCUT = Slices((), (), (), ())
CUT = DEFAULTS.with_options(rows_per_slice=60)


def skewed(seed: int = 5, rows: int = 1500):
    """One hot symbol; many trades at one instant, and many without a time."""
    rng = random.Random(seed)
    made = []
    for i in range(rows):
        symbol = "HOT" if rng.random() < 0.8 else rng.choice(["A", "B"])
        pick = rng.random()
        if pick < 0.3:
            seconds = 500.0
        elif pick < 0.5:
            seconds = None
        else:
            seconds = rng.uniform(0, 1000)
        made.append(trade(symbol, i, round(rng.uniform(1, 500), 2), rng.randint(1, 99), seconds))
    rng.shuffle(made)
    return made


@pytest.fixture(scope="module")
def trades(spark):
    return trades_df(spark, skewed()).cache()


def test_cuts_follow_the_order(trades):
    slices = plan_slices(trades, CUT)
    assert slices.hot_symbols and "HOT" in slices.hot_symbols
    assert len(slices.hot_times) == 2  # the crowded instant and the missing times
    sliced = slices.assign(trades)
    numbered = sliced.withColumn("rn", F.row_number().over(series_window()))
    rows = numbered.select("symbol", "rn", SLICE).orderBy("symbol", "rn").collect()
    for before, after in zip(rows, rows[1:]):
        if before["symbol"] == after["symbol"]:
            assert before[SLICE] <= after[SLICE]
    largest = sliced.groupBy("symbol", SLICE).count().agg(F.max("count")).first()[0]
    assert largest <= 4 * CUT.rows_per_slice


def test_small_tables_stay_uncut(trades):
    assert plan_slices(trades, DEFAULTS) == UNCUT


def test_zscores(trades):
    assert same_rows(rolling_zscore(trades, CUT), rolling_zscore(trades, slices=UNCUT))


def test_features(trades):
    assert same_rows(ml_features(trades, CUT), ml_features(trades, slices=UNCUT))


def test_slices_shorter_than_the_frame(trades):
    tiny = DEFAULTS.with_options(rows_per_slice=7)
    assert same_rows(rolling_zscore(trades, tiny), rolling_zscore(trades, slices=UNCUT))


def test_hot_symbols_beyond_a_broadcast(trades):
    salted = CUT.with_options(lookup_rows=0, salt_rows=50)
    assert same_rows(rolling_zscore(trades, salted), rolling_zscore(trades, slices=UNCUT))


def test_fifty_slices_of_many_hot_symbols(spark):
    """Cut in 50, with hot symbols side by side and crowded instants next to each other."""
    rng = random.Random(8)
    rows = [trade(rng.choice([None, "", "=", "A", "B"]), i, 1.0 + i % 37, 2.0, rng.choice([3.0, 3.000001, 9.0]))
            for i in range(1000)]
    frame = trades_df(spark, rows)
    fine = DEFAULTS.with_options(rows_per_slice=20)
    slices = plan_slices(frame, fine)
    assert len(slices.hot_symbols) == 5
    assert slices.assign(frame).select("symbol", SLICE).distinct().count() >= 50
    assert same_rows(with_position(frame, slices, total="n"), with_position(frame, UNCUT, total="n"))
    assert same_rows(rolling_zscore(frame, fine), rolling_zscore(frame, slices=UNCUT))


def test_ranks_by_range(spark, monkeypatch):
    """A sample sorted by several tasks gives borders that cut evenly, and repeats of a crowded value."""
    monkeypatch.setattr(slicing, "_SAMPLE_TASK_ROWS", 100)
    values = [float(i) for i in range(2000)] + [700.5] * 1000
    borders = sampled_borders(spark.createDataFrame([(v,) for v in values], "x double"), "x", 3000, 30, 100)
    assert borders == sorted(borders) and borders.count(700.5) >= 9
    edges = [float("-inf"), *sorted(set(borders)), float("inf")]
    assert max(sum(a <= v < b for v in values if v != 700.5) for a, b in zip(edges, edges[1:])) <= 200


def test_hot_intervals():
    last = slicing._LAST
    times = [5.0, 6.0, 9.0, last]
    borders = hot_intervals(times)
    assert borders == [5.0, 7.0, 9.0, 10.0, last]
    for v in (4.0, 5.0, 6.0, 7.0, 9.0, 10.0, last):
        assert (sum(b <= v for b in borders) % 2 == 1) == (v in times)


def test_positions(trades):
    cut = with_position(trades, plan_slices(trades, CUT), total="n")
    plain = with_position(trades, UNCUT, total="n")
    assert same_rows(cut, plain)
    assert cut.filter("symbol = 'HOT'").agg(F.max(POSITION) == F.max("n")).first()[0]


@pytest.mark.parametrize("points", [10, 50, 5000])
def test_thinning(trades, points):
    cut = thin_series(trades, points, CUT)
    assert same_rows(cut, thin_series(trades, points, slices=UNCUT))
    for row in cut.groupBy("symbol").count().collect():
        assert row["count"] < 2 * points


def test_instants_and_wall_clock_agree(spark, trades):
    instants = trades.withColumn("trade_time", F.col("trade_time").cast("timestamp"))
    drop = lambda df: df.drop("trade_time")
    assert same_rows(
        drop(rolling_zscore(instants, CUT)), drop(rolling_zscore(trades, slices=UNCUT))
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_lookup_equals_broadcast(spark, trades, how):
    from tapewright.operators.joins import join_lookup

    names = spark.createDataFrame([("HOT", 1.5), ("A", 2.5), ("Z", 3.5)], "symbol string, w double")
    salted = DEFAULTS.with_options(lookup_rows=0, salt_rows=7)
    made = join_lookup(trades, names, ["symbol"], salted, how)
    assert made.columns == trades.join(names, ["symbol"], how).columns
    assert same_rows(made, join_lookup(trades, names, ["symbol"], how=how))
    assert same_rows(made, trades.join(names, ["symbol"], how))


def test_missing_symbols_are_kept_when_cut(spark):
    """Missing symbols form a series like any other, hot or not."""
    for share in (0.1, 0.7):
        rng = random.Random(3)
        rows = [trade(None if rng.random() < share else "HOT", i % 400, 1.0 + i, 2.0, float(i % 7)) for i in range(900)]
        frame = trades_df(spark, rows)
        slices = plan_slices(frame, CUT)
        assert slices.hot_symbols
        placed = with_position(frame, slices, total="n")
        assert placed.count() == 900
        by = {r["symbol"]: (r["n"], r["k"]) for r in placed.groupBy("symbol").agg(
            F.max("n").alias("n"), F.countDistinct(POSITION).alias("k")).collect()}
        counts = {r["symbol"]: r["count"] for r in frame.groupBy("symbol").count().collect()}
        assert by == {s: (n, n) for s, n in counts.items()}
        assert thin_series(frame, 50, CUT, slices).count() == thin_series(frame, 50, CUT, UNCUT).count()
