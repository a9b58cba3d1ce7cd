"""Live trades scored by a kept forest, batch by batch, with writes that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapewright.config import DEFAULTS, Settings
from tapewright.operators.forest import apply_model, load_model
from tapewright.operators.rolling import ml_features
from tapewright.schemas import FOREST_SCORED_TRADE
from tapewright.session import materialize
from tapewright.sources.storage import delete, list_names
from tapewright.streaming.sinks import paced

_BATCH, _TAIL, _NEW = "batch_id", "_tail", "__new"


def _tails(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.partition("=")[2]) for name, _ in list_names(spark, f"{path}/{_TAIL}") if "=" in name)


def score_batch(batch: DataFrame, number: int, model_path: str, path: str, settings: Settings = DEFAULTS) -> None:
    """Score the trades of a micro-batch and keep what the next one's rolling features reach back to.

    Features go over the last trades per symbol of the batches before, then the batch's own, so they
    are those of one table as long as batches follow each other in time. Scores and the new tail are
    folders named by the batch; a batch that runs again reads the same older tail and writes the
    same folders anew. The model is loaded per batch: a newer version takes over between batches.
    """
    spark = batch.sparkSession
    new = materialize(batch.withColumn(_NEW, F.lit(True)), "live-batch")
    older = [n for n in _tails(spark, path) if n < number]
    rows = new
    if older:
        tail = spark.read.schema(batch.schema).parquet(f"{path}/{_TAIL}/{_BATCH}={older[-1]}")
        rows = tail.withColumn(_NEW, F.lit(False)).unionByName(new)
    features = ml_features(rows, settings).where(_NEW).drop(_NEW)
    scored = apply_model(features, load_model(spark, model_path), settings)
    scored.select(*FOREST_SCORED_TRADE.fieldNames()).write.mode("overwrite").parquet(f"{path}/{_BATCH}={number}")
    newest = Window.partitionBy("symbol").orderBy(F.desc_nulls_first("trade_time"), F.desc_nulls_first("trade_id"))
    reach = max(settings.feature_window - 1, 1)
    # Spark keeps no more than ``reach`` rows per symbol and task before it shuffles.
    last = rows.drop(_NEW).withColumn("__n", F.row_number().over(newest)).where(F.col("__n") <= reach).drop("__n")
    last.write.mode("overwrite").parquet(f"{path}/{_TAIL}/{_BATCH}={number}")
    for old in older[:-1]:  # the one that this batch has read stays, should it run again
        delete(spark, f"{path}/{_TAIL}/{_BATCH}={old}")


def start_live_scores(
    trades: DataFrame, model_path: str, path: str, checkpoint: str, settings: Settings = DEFAULTS,
    available_now: bool = False,
) -> StreamingQuery:
    """Score a stream of clean trades with the current forest at ``model_path``."""
    writer = paced(trades, settings, available_now).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda batch, number: score_batch(batch, number, model_path, path, settings)).start()


def read_live_scores(spark: SparkSession, path: str) -> DataFrame:
    """All scored trades, with the batch that scored them."""
    kept = T.StructType([*FOREST_SCORED_TRADE.fields, T.StructField(_BATCH, T.LongType())])
    return spark.read.schema(kept).parquet(path)
