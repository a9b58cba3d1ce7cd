"""Isolation Forest per symbol, after Liu, Ting and Zhou (ICDM 2008).

Trees are fitted from bounded random subsamples, one small task group per (symbol, tree); rows are
scored where they lie. Nothing depends on how the input is partitioned: sampling is by hash of the
row and the seed, and each tree draws from a generator seeded by (seed, symbol, tree).
"""

from __future__ import annotations

import dataclasses
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.config import DEFAULTS, Settings
from tapewright.functions import trees as tree_functions
from tapewright.functions.trees import anomaly, fit_tree, stacked, tree_depth
from tapewright.operators.joins import join_lookup
from tapewright.operators.quantiles import exact_quantiles, quantile_sketches, sketched_quantiles
from tapewright.operators.rolling import FEATURES, feature_moments, ml_features, scaled_features
from tapewright.operators.slicing import Slices
from tapewright.session import materialize
from tapewright.sources.storage import current, publish

# Python workers get the tree functions with the job, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(tree_functions)

# Fixed value: tag of scored rows.
MODEL_NAME = "IsolationForest"

TREE_SCHEMA = (
    "symbol string, tree int, rows int, feature array<int>, threshold array<float>, "
    "path array<float>"
)
_CHUNK, _OFFSET = "__chunk", "__offset"
_RAW = "__raw_"
# What random draws are made from: given columns, as derived ones may differ in the last digit.
ROW_KEY = ("trade_id", "trade_time", f"{_RAW}price", f"{_RAW}quantity")


def with_scaled_features(
    features: DataFrame, moments: DataFrame, settings: Settings = DEFAULTS, how: str = "inner"
) -> DataFrame:
    """Feature columns standardised per symbol; the given values stay under prefixed names."""
    given = features.withColumns({_RAW + c: F.col(c) for c in FEATURES})
    return scaled_features(given, settings, moments, how)


def symbol_sizes(moments: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Row count of each symbol that is large enough for a model."""
    return moments.filter(F.col("rows") >= settings.forest_min_rows).select("symbol", "rows")


def _uniform(mixed: Column) -> Column:
    """Reproducible draw in [0, 1) from a hash."""
    return F.pmod(mixed, F.lit(2**53)).cast("double") / float(2**53)


def tree_samples(
    scaled: DataFrame, sizes: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Random subsample of at most ``forest_tree_rows`` rows for each symbol and tree.

    First a reservoir per symbol of trees * tree rows at most, taken by hash: a threshold that
    keeps about twice as many rows cuts the table down where it is read, then a rank makes it
    exact. The trees draw from the reservoir in the same way.
    """
    per_tree, trees = settings.forest_tree_rows, settings.forest_trees
    reservoir = per_tree * trees
    # Few bytes but much work per byte: a fixed partition count keeps adaptive execution from
    # merging partitions by size. Ranking and fitting the trees share the second shuffle.
    partitions = fit_partitions(scaled.sparkSession)
    drawn = (
        join_lookup(scaled, sizes, ["symbol"], settings, written=True)
        .withColumn("__row", F.xxhash64(F.lit(settings.forest_seed), *ROW_KEY))
        .withColumn("__draw", _uniform(F.col("__row")))
        .filter(F.col("__draw") * F.col("rows") < 2.0 * reservoir)
        .withColumn(
            "__rank", F.row_number().over(Window.partitionBy("symbol").orderBy("__draw"))
        )
        .filter(F.col("__rank") <= reservoir)
        .repartition(partitions, "trade_id", "__draw")
    )
    pool = F.least(F.col("rows"), F.lit(reservoir))
    spread = (
        drawn.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("__draw", _uniform(F.xxhash64("__row", "tree")))
        .filter(F.col("__draw") * pool < 2.0 * per_tree)
        .repartition(partitions, "symbol", "tree")
    )
    in_tree = Window.partitionBy("symbol", "tree").orderBy("__draw")
    return (
        spread.withColumn("__rank", F.row_number().over(in_tree))
        .filter(F.col("__rank") <= per_tree)
        .select("symbol", "tree", *FEATURES)
    )


def fit_partitions(spark: SparkSession) -> int:
    planned = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(planned, 2 * spark.sparkContext.defaultParallelism)


def fit_forest(
    scaled: DataFrame, sizes: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """One row per (symbol, tree); every fitting group holds at most ``forest_tree_rows`` rows."""
    depth, seed = tree_depth(settings.forest_tree_rows), settings.forest_seed

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        symbol, tree = sample["symbol"].iloc[0], int(sample["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree, zlib.crc32(symbol.encode())])
        points = sample[list(FEATURES)].to_numpy(dtype=np.float32)
        # A group arrives in shuffle order: sort it so that refits give the same tree.
        points = points[np.lexsort(points.T)]
        feature, threshold, path = fit_tree(points, depth, rng)
        return pd.DataFrame(
            {
                "symbol": [symbol], "tree": [tree], "rows": [len(points)],
                "feature": [feature], "threshold": [threshold], "path": [path],
            }
        )

    samples = tree_samples(scaled, sizes, settings)
    return samples.groupBy("symbol", "tree").applyInPandas(fit, TREE_SCHEMA)


def forest_bytes(trees: int, settings: Settings) -> int:
    nodes = 2 ** tree_depth(settings.forest_tree_rows)
    return trees * nodes * 12


def score_rows(
    scaled: DataFrame, forest: DataFrame, sizes: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Add ``raw_score``, null for symbols without a model.

    While all trees together stay below ``forest_broadcast_bytes`` they are shipped to the
    executors, and rows are dealt out evenly for scoring: it takes much time per byte, and where rows
    lie, a slice of a symbol is one task. Beyond that, rows meet their symbol's trees by
    co-grouping, in hash chunks of bounded size so that a hot symbol is spread over many tasks.
    """
    trees = forest.count()
    if forest_bytes(trees, settings) <= settings.forest_broadcast_bytes:
        return _score_shipped(scaled.repartition(fit_partitions(scaled.sparkSession), *ROW_KEY), forest)
    return _score_cogrouped(scaled, forest, sizes, settings)


def _score_shipped(scaled: DataFrame, forest: DataFrame) -> DataFrame:
    collected = forest.toPandas()
    forests = {s: stacked(part) for s, part in collected.groupby("symbol")}
    shared = scaled.sparkSession.sparkContext.broadcast(forests)

    @F.pandas_udf("double")
    def raw_score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        models = shared.value
        for symbol, *columns in parts:
            points = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
            scores = np.full(len(symbol), np.nan)
            for name, rows in symbol.groupby(symbol, sort=False).indices.items():
                if name in models:
                    scores[rows] = anomaly(points[rows], models[name])
            yield pd.Series(scores)

    score = raw_score("symbol", *FEATURES)
    return scaled.withColumn("raw_score", F.nanvl(score, F.lit(None).cast("double")))


def _score_cogrouped(
    scaled: DataFrame, forest: DataFrame, sizes: DataFrame, settings: Settings
) -> DataFrame:
    chunks = F.ceil(F.col("rows") / settings.forest_chunk_rows).cast("int")
    chunked = sizes.select("symbol", chunks.alias("__chunks"))
    rows = (
        join_lookup(scaled, chunked, ["symbol"], settings, "left", written=True)
        .withColumn(
            _CHUNK,
            F.pmod(F.xxhash64(*ROW_KEY), F.coalesce(F.col("__chunks"), F.lit(1))).cast("int"),
        )
        .drop("__chunks")
    )
    models = forest.join(chunked, "symbol").withColumn(
        _CHUNK, F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))
    )
    schema = T.StructType([*scaled.schema.fields, T.StructField("raw_score", T.DoubleType())])
    names = scaled.columns

    def score(part: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        scored = part[names].copy()
        if len(trees) and len(part):
            points = part[list(FEATURES)].to_numpy(dtype=np.float64)
            scored["raw_score"] = anomaly(points, stacked(trees))
        else:
            scored["raw_score"] = np.nan
        return scored

    scored = (
        rows.groupBy("symbol", _CHUNK)
        .cogroup(models.groupBy("symbol", _CHUNK))
        .applyInPandas(score, schema)
    )
    return scored.withColumn(
        "raw_score", F.nanvl(F.col("raw_score"), F.lit(None).cast("double"))
    )


@dataclass(frozen=True)
class ForestModel:
    """What scoring needs, as written tables with a few rows per symbol.

    moments: row count, means and deviations of the features; trees; thresholds: symbol and the
    measure above which a trade is flagged, negated.
    """

    moments: DataFrame
    trees: DataFrame
    thresholds: DataFrame


def score_thresholds(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """symbol, offset: what is added to ``raw_score`` so that the wanted share is positive.

    Exact, or within ``threshold_rank_error`` of all ranks from mergeable sketches: one pass, in
    which a symbol is a small row per task.
    """
    # The flagged share is the lower tail of the negated measure.
    negated = scored.select("symbol", (-F.col("raw_score")).alias("negated"))
    share, error = [settings.contamination], settings.threshold_rank_error
    if error:
        found = sketched_quantiles(quantile_sketches(negated, ["symbol"], "negated", error), ["symbol"], share)
    else:
        found = exact_quantiles(negated, ["symbol"], "negated", share, settings)
    return found.select("symbol", F.col("quantiles")[0].alias(_OFFSET))


def _fit(features: DataFrame, settings: Settings) -> tuple[ForestModel, DataFrame]:
    """The model of written ``features``, and their raw scores."""
    moments = materialize(feature_moments(features), "forest-moments")
    sizes = symbol_sizes(moments, settings)
    scaled = with_scaled_features(features, moments, settings)
    trees = materialize(fit_forest(scaled, sizes, settings), "forest-trees")
    scored = materialize(score_rows(scaled, trees, sizes, settings), "forest-raw")
    thresholds = materialize(score_thresholds(scored, settings), "forest-thresholds")
    return ForestModel(moments, trees, thresholds), scored


def _judged(scored: DataFrame, thresholds: DataFrame, columns: list[str], settings: Settings) -> DataFrame:
    """The given columns with score, flag and tag, from raw scores and written thresholds."""
    modelled = F.col("raw_score").isNotNull()
    score = F.when(modelled, F.col("raw_score") + F.col(_OFFSET)).otherwise(0.0)
    return join_lookup(scored, thresholds, ["symbol"], settings, "left", written=True).select(
        *[F.col(_RAW + c).alias(c) if c in FEATURES else F.col(c) for c in columns],
        score.alias("ml_anomaly_score"),
        (modelled & (score > 0)).alias("is_ml_anomaly"),
        F.when(modelled, MODEL_NAME).alias("ml_model"),
    )


def iforest_scores(
    trades: DataFrame, settings: Settings = DEFAULTS, slices: Slices | None = None
) -> DataFrame:
    """Trades with features, anomaly score, flag and model tag.

    The score is the anomaly measure minus the symbol's contamination threshold; positive means
    flagged. Symbols below ``forest_min_rows`` get score 0, no flag and no model. Features, moments,
    trees and raw scores feed several consumers each, so they are written once to the shared folder.
    """
    return fit_and_score(trades, settings, slices)[1]


def fit_and_score(
    trades: DataFrame, settings: Settings = DEFAULTS, slices: Slices | None = None
) -> tuple[ForestModel, DataFrame]:
    """The model of a batch run, to keep, and what ``iforest_scores`` gives, from one fit."""
    features = materialize(ml_features(trades, settings, slices), "forest-features")
    model, scored = _fit(features, settings)
    return model, _judged(scored, model.thresholds, features.columns, settings)


def fit_model(trades: DataFrame, settings: Settings = DEFAULTS) -> ForestModel:
    """A model to keep, fitted on ``trades``."""
    return _fit(materialize(ml_features(trades, settings), "forest-features"), settings)[0]


def save_model(model: ForestModel, path: str, keep: int = 2) -> str:
    """Write the model as the current version at ``path``; returns the version's directory."""
    spark = model.trees.sparkSession
    version = f"model-{uuid.uuid4().hex}"
    for part in dataclasses.fields(model):
        getattr(model, part.name).write.parquet(f"{path}/{version}/{part.name}")
    publish(spark, path, version, keep)
    return f"{path}/{version}"


def load_model(spark: SparkSession, path: str) -> ForestModel:
    """The current version of the model at ``path``."""
    version = current(spark, path)
    return ForestModel(*(spark.read.parquet(f"{version}/{f.name}") for f in dataclasses.fields(ForestModel)))


def apply_model(features: DataFrame, model: ForestModel, settings: Settings = DEFAULTS) -> DataFrame:
    """As ``iforest_scores``, of rows with features by a kept model; symbols without one score 0."""
    sizes = symbol_sizes(model.moments, settings)
    scaled = with_scaled_features(features, model.moments, settings, "left")
    scored = score_rows(scaled, model.trees, sizes, settings)
    return _judged(scored, model.thresholds, features.columns, settings)
