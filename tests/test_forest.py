import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import same_rows, trade, trades_df
from tapewright.config import DEFAULTS
from tapewright.functions.trees import average_path, fit_tree, mean_paths
from tapewright.operators.forest import iforest_scores
from tapewright.schemas import FOREST_SCORED_TRADE


def market(seed=11, big=700, mid=120, small=19):
    rng = random.Random(seed)
    rows = []
    for symbol, count in (("BIG", big), ("MID", mid), ("FEW", small)):
        for i in range(count):
            rows.append(
                trade(symbol, len(rows), rng.gauss(100, 2), rng.uniform(1, 3), i * 5 + rng.random())
            )
    rows.append(trade("BIG", 9_999, 5_000.0, 80.0, 1_000.5))
    return rows


@pytest.fixture(scope="module")
def trades(spark):
    return trades_df(spark, market()).cache()


@pytest.fixture(scope="module")
def scored(trades):
    return iforest_scores(trades).cache()


def test_invariants(scored):
    assert set(FOREST_SCORED_TRADE.fieldNames()) == set(scored.columns)
    rows = scored.collect()
    assert len(rows) == 840
    assert all(r["is_ml_anomaly"] == (r["ml_anomaly_score"] > 0) for r in rows)
    few = [r for r in rows if r["symbol"] == "FEW"]
    assert len(few) == 19
    assert all(r["ml_anomaly_score"] == 0.0 and r["ml_model"] is None for r in few)
    for symbol, size in (("BIG", 701), ("MID", 120)):
        flagged = sum(r["is_ml_anomaly"] for r in rows if r["symbol"] == symbol)
        assert abs(flagged - 0.02 * size) <= 1.5
    top = max((r for r in rows if r["symbol"] == "BIG"), key=lambda r: r["ml_anomaly_score"])
    assert top["trade_id"] in (9_999, *[r["trade_id"] for r in rows if r["price"] == 5_000.0])
    assert {r["ml_model"] for r in rows if r["symbol"] != "FEW"} == {"IsolationForest"}


def test_same_for_any_partitioning(trades, scored):
    again = iforest_scores(trades.repartition(13, "price"))
    assert same_rows(scored, again)


def test_cogrouped_scoring_gives_the_same(trades, scored):
    spread = DEFAULTS.with_options(forest_broadcast_bytes=0, forest_chunk_rows=100)
    assert same_rows(scored, iforest_scores(trades, spread))


def test_sliced_everything_gives_the_same(trades, scored):
    cut = DEFAULTS.with_options(rows_per_slice=90, quantile_rows=100)
    assert same_rows(scored, iforest_scores(trades, cut))


def test_reservoir_is_smaller_than_a_large_symbol(trades):
    tight = DEFAULTS.with_options(forest_trees=5, forest_tree_rows=16)
    rows = iforest_scores(trades, tight)
    assert rows.count() == 840
    assert rows.agg(F.count_if("is_ml_anomaly")).first()[0] > 0


def walk(point, feature, threshold, path):
    node, inner = 0, len(feature)
    while node < inner:
        node = 2 * node + 1 + bool(point[feature[node]] > threshold[node])
    return path[node - inner]


def test_tree_paths_by_hand():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(200, 3)).astype(np.float32)
    points[:, 2] = 1.0  # never split on
    trees = [fit_tree(points, 8, np.random.default_rng(s)) for s in range(6)]
    feature, threshold, path = (np.stack(part) for part in zip(*trees))
    assert not (feature[np.isfinite(threshold)] == 2).any()
    probe = rng.normal(size=(50, 3)).astype(np.float32)
    wanted = [np.mean([walk(p, *tree) for tree in trees]) for p in probe]
    assert np.allclose(mean_paths(probe, feature, threshold, path), wanted, rtol=1e-6)


def test_single_and_equal_rows():
    for points in (np.ones((1, 2), np.float32), np.ones((30, 2), np.float32)):
        feature, threshold, path = fit_tree(points, 4, np.random.default_rng(0))
        assert np.isinf(threshold).all()
        assert walk(points[0], feature, threshold, path) == pytest.approx(
            float(average_path(len(points)))
        )
    assert average_path(np.array([0, 1, 2])).tolist() == [0.0, 0.0, 1.0]
