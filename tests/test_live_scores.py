"""Kept forests, live scores, and thresholds from sketches."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import trade, trades_df
from tapewright.config import DEFAULTS
from tapewright.functions.times import as_instant
from tapewright.operators import forest
from tapewright.operators.quantiles import (
    exact_quantiles,
    merged_sketches,
    quantile_sketches,
    sketch_size,
    sketched_quantiles,
)
from tapewright.plans import documents
from tapewright.sources.storage import list_names
from tapewright.streaming.scoring import read_live_scores, score_batch, start_live_scores

SMALL = DEFAULTS.with_options(forest_trees=20, forest_tree_rows=64)


def market(n=240):
    draw = random.Random(2)
    rows = [trade("AB"[i % 2], i, 100 + draw.gauss(0, 2), 1 + draw.random(), i * 3) for i in range(n)]
    return rows + [trade("NEW", 9_000 + i, 5.0, 1.0, i * 40) for i in range(18)]


@pytest.fixture(scope="module")
def given(spark):
    return as_instant(trades_df(spark, market()), "trade_time").cache()


@pytest.fixture(scope="module")
def model_path(spark, given, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    forest.save_model(forest.fit_model(given, SMALL), path)
    return path


def values(df):
    keep = ("symbol", "trade_id", "price", "rolling_trade_count", "rolling_trade_value_mean", "price_return", "ml_anomaly_score", "is_ml_anomaly", "ml_model")
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*keep).collect())


def slices_of(given):
    time = F.unix_seconds("trade_time")
    start = given.agg(F.min(time)).first()[0]
    return [given.where((time >= start + a) & (time < start + b)) for a, b in ((0, 20), (20, 300), (300, 10_000))]


def test_live_scores_are_those_of_the_batch(spark, given, model_path, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in slices_of(given):
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(given.schema).parquet(inbox)
        start_live_scores(stream, model_path, out, str(tmp_path / "check"), SMALL, available_now=True).awaitTermination()
    live = read_live_scores(spark, out)
    assert live.select("batch_id").distinct().count() == 3
    assert values(live) == values(forest.iforest_scores(given, SMALL))
    assert live.where("is_ml_anomaly").count() > 0


def test_a_batch_that_runs_again_repeats_nothing(spark, given, model_path, tmp_path):
    out = str(tmp_path / "out")
    parts = slices_of(given)
    for number in (0, 1, 1, 2, 2, 2):
        score_batch(parts[number], number, model_path, out, SMALL)
    assert values(read_live_scores(spark, out)) == values(forest.iforest_scores(given, SMALL))
    assert len(list_names(spark, f"{out}/_tail")) == 2


def test_symbols_without_a_model_score_nothing(spark, given, model_path):
    strange = given.where("symbol = 'A'").withColumn("symbol", F.lit("UNSEEN"))
    from tapewright.operators.rolling import ml_features

    scored = forest.apply_model(ml_features(strange, SMALL), forest.load_model(spark, model_path), SMALL).collect()
    assert len(scored) == 120 and {(r["ml_anomaly_score"], r["is_ml_anomaly"], r["ml_model"]) for r in scored} == {(0.0, False, None)}


def test_a_newer_model_takes_over(spark, given, tmp_path):
    path = str(tmp_path)
    forest.save_model(forest.fit_model(given, SMALL), path)
    opened = forest.load_model(spark, path)
    none = SMALL.with_options(forest_min_rows=10_000)
    forest.save_model(forest.fit_model(given, none), path)
    assert opened.trees.count() == 40 and forest.load_model(spark, path).trees.count() == 0


@pytest.mark.parametrize("error", [0.02, 0.005])
def test_sketches_keep_their_rank_error(spark, error):
    n = 30_000
    frame = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("symbol"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("value"),
    ).repartition(7)
    with_null = frame.unionByName(spark.createDataFrame([("A", None), ("C", None)], frame.schema))
    ranks = [0.0, 0.02, 0.5, 0.98, 1.0]
    sketches = quantile_sketches(with_null, ["symbol"], "value", error)
    found = {r["symbol"]: r["quantiles"] for r in sketched_quantiles(sketches, ["symbol"], ranks).collect()}
    assert set(found) == {"A", "B"}
    by = {s: sorted(r["value"] for r in frame.where(F.col("symbol") == s).collect()) for s in found}
    for symbol, quantiles in found.items():
        for rank, value in zip(ranks, quantiles):
            share = sum(v <= value for v in by[symbol]) / len(by[symbol])
            assert abs(share - rank) <= 2 * error + 1 / len(by[symbol])
    days = frame.withColumn("day", F.pmod(F.hash("value"), F.lit(5)))
    kept = quantile_sketches(days, ["symbol", "day"], "value", error)
    merged = {r["symbol"]: r["quantiles"] for r in sketched_quantiles(merged_sketches(kept, ["symbol"]), ["symbol"], [0.5]).collect()}
    exact = {r["symbol"]: r["quantiles"] for r in exact_quantiles(frame, ["symbol"], "value", [0.5]).collect()}
    for symbol, (value,) in merged.items():
        between = sum(min(value, exact[symbol][0]) <= v <= max(value, exact[symbol][0]) for v in by[symbol])
        assert between / len(by[symbol]) <= 2 * error + 1 / len(by[symbol])


def test_sketched_thresholds_flag_the_wanted_share(spark):
    error, n = 0.002, 40_000
    scored = spark.range(n).select(
        F.when(F.col("id") % 4 == 0, "A").otherwise("B").alias("symbol"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e9).alias("raw_score")
    )
    settings = DEFAULTS.with_options(threshold_rank_error=error)
    offsets = {r["symbol"]: r[1] for r in forest.score_thresholds(scored, settings).collect()}
    sizes = {r["symbol"]: r["count"] for r in scored.groupBy("symbol").count().collect()}
    for symbol, offset in offsets.items():
        flagged = scored.where((F.col("symbol") == symbol) & (F.col("raw_score") + offset > 0)).count()
        assert abs(flagged / sizes[symbol] - 0.02) <= 2 * error
    plan = forest.score_thresholds(scored, settings)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_kll" in plan.lower()


def test_no_sketch_is_that_exact():
    assert 290 < sketch_size(0.0133) < 315 and sketch_size(0.9) == 8
    with pytest.raises(ValueError, match="the least is"):
        sketch_size(1e-6)


def test_one_slice_is_scored_by_several_tasks(spark, given, model_path):
    model = forest.load_model(spark, model_path)
    features = forest.ml_features(given, SMALL).coalesce(1)
    scored = forest.apply_model(features, model, SMALL).withColumn("task", F.spark_partition_id())
    assert scored.where("ml_model is not null").select("task").distinct().count() > 1


def test_the_query_fits_one_forest(spark, small_sf, monkeypatch):
    fitted, fit = [], forest.fit_forest
    monkeypatch.setattr(forest, "fit_forest", lambda *args: fitted.append(1) or fit(*args))
    found = documents.live_forest_scores(spark, small_sf)
    assert found.where("as_in_batch").count() == found.count() > 0
    assert len(fitted) == 1
