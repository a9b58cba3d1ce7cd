"""Trades seen through the generic star-schema tables used for tests and scale runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.times import wall_clock_micros


def trades_from_events(events: DataFrame) -> DataFrame:
    """``events`` as uncleaned trades: type is the symbol, value the price, ``props.k`` the size.

    The size passes through a generator, so that filters on it do not parse the text again.
    """
    size = F.get_json_object("props", "$.k").try_cast("double")
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        F.explode(F.array(size)).alias("quantity"),
        F.col("ts").alias("trade_time"),
    )


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def compact_from_events(events: DataFrame) -> DataFrame:
    """``events`` as compact records, with times cut to milliseconds as on the wire."""
    trade_ms = F.floor(wall_clock_micros(F.col("ts")) / 1000).cast("bigint")
    return events.select(
        F.lit("trade").alias("kind"),
        trade_ms.alias("event_ms"),
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").cast("string").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").cast("string").alias("quantity"),
        trade_ms.alias("trade_ms"),
        (F.col("user_id") % 2 == 0).alias("sell_side"),
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trades, for aggregates only: days as times, ids not unique."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    unit_price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return items.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_orderkey").alias("trade_id"),
        unit_price.cast("double").alias("price"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("trade_time"),
    )
