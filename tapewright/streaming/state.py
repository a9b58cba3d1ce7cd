"""What a live query still holds back: windows that are open, and trades that come too late."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.values import ratio
from tapewright.operators.windows import flag_windows, spread_pct, window_end_micros
from tapewright.streaming.sinks import start_table_sink

#: Name of the operator, in a checkpoint's metadata, that holds windows.
_WINDOWS = "stateStoreSave"
_BUFFERS = T.StructType(
    [T.StructField(n, T.LongType() if n.endswith("count") else T.DoubleType()) for n in (
        "price_sum", "price_count", "min_price", "max_price", "volume", "notional_volume",
        "max_trade_value", "trade_count",
    )]
)


def open_windows(
    spark: SparkSession, checkpoint: str, settings: Settings = DEFAULTS, batch: int | None = None
) -> DataFrame:
    """Windows that a windowed job has begun and not yet emitted, as they stand.

    They are read from the state of the newest batch in ``checkpoint`` (or of ``batch``), by state
    partition; the query may run or not. Together with the emitted rows they are all windows of the
    trades that were read in time.
    """
    holders = spark.read.format("state-metadata").load(checkpoint)
    (operator,) = holders.where(F.col("operatorName") == _WINDOWS).select("operatorId").distinct().collect()
    reader = spark.read.format("statestore").option("operatorId", operator[0])
    held = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    # Buffers of equal aggregates share a name; a cast goes by position.
    buffers = F.col("value").cast(_BUFFERS).alias("held")
    named = held.select("key.window.start", "key.window.end", "key.symbol", buffers).select(
        F.col("start").alias("window_start"), F.col("end").alias("window_end"), "symbol", "held.*"
    )
    metrics = named.withColumn("avg_price", ratio(F.col("price_sum"), F.col("price_count")))
    return flag_windows(metrics.withColumn("price_spread_pct", spread_pct()), settings)


LATE = "late"


def split_late(trades: DataFrame, settings: Settings = DEFAULTS, buckets: int = 64) -> DataFrame:
    """All rows of a stream with a watermark on ``trade_time``, and ``late``: is their window closed?

    A windowed aggregate drops late rows without a trace. Here each row meets the watermark of its
    batch; ``late`` tells that the window of its time had ended by then. Rows are dealt out by a
    hash of the whole row, so no symbol gathers in one task; nothing is kept between batches. Rows
    without a time are not late.
    """
    hashed = F.pmod(F.xxhash64(*trades.columns), F.lit(buckets)).alias("__bucket")
    closes = window_end_micros(F.unix_micros("trade_time"), settings.window_seconds).cast("double")
    # Values pass through Python as text, so that nulls, long ids and times come back as they were.
    timed = [f.name for f in trades.schema if isinstance(f.dataType, T.TimestampType)]
    texts = [
        (F.unix_micros(c) if c in timed else F.col(c)).cast("string").alias(f"__{c}") for c in trades.columns
    ]
    names = [f"__{c}" for c in trades.columns]
    rows = trades.select("trade_time", hashed, closes.alias("__closes"), *texts)

    def tell(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        for part in parts:
            out = part[names].copy()
            out[LATE] = (part["__closes"] <= mark).to_numpy()
            yield out

    schema = ", ".join(f"`{n}` string" for n in names) + f", {LATE} boolean"
    told = rows.groupBy("__bucket").applyInPandasWithState(tell, schema, "nothing int", "append", GroupStateTimeout.NoTimeout)

    def back(field: T.StructField):
        text = F.col(f"`__{field.name}`")
        value = F.timestamp_micros(text.cast("bigint")) if field.name in timed else text.cast(field.dataType)
        return value.alias(field.name)

    return told.select(*map(back, trades.schema), LATE)


def start_late_split(
    trades: DataFrame, path: str, checkpoint: str, settings: Settings = DEFAULTS, available_now: bool = False
) -> StreamingQuery:
    """Write a stream's rows below ``path`` as two tables, late=false and late=true."""
    rows = split_late(trades, settings)
    return start_table_sink(rows, path, checkpoint, "parquet", settings, available_now, [LATE])


def read_late_split(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of both tables of ``start_late_split``; a filter on ``late`` reads one of them."""
    kept = T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())])
    return spark.read.schema(kept).parquet(path)
