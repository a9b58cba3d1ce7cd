"""Tumbling event-time metrics per symbol and the threshold rules on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.values import ratio
from tapewright.schemas import WINDOW_AGGREGATE


def window_metrics(trades: DataFrame, seconds: int) -> DataFrame:
    """Metrics per epoch-aligned ``[start, end)`` window and symbol.

    All aggregates have fixed-size buffers, so Spark combines them before the shuffle and a hot
    symbol costs no more than one row per window and task. Usable on a stream after
    ``withWatermark``.
    """
    price, value = F.col("price"), F.col("trade_value")
    grouped = trades.groupBy(F.window("trade_time", f"{seconds} seconds").alias("span"), "symbol")
    # Names of the result columns.
    metrics = grouped.agg(
        F.avg(price).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.sum("quantity").alias("volume"),
        F.sum(value).alias("notional_volume"),
        F.max(value).alias("max_trade_value"),
        F.count("*").alias("trade_count"),
    )
    return metrics.select(
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), "*", spread_pct()
    ).drop("span")


def spread_pct() -> Column:
    """Price range of a window in percent of its mean; 0 without a positive mean."""
    spread = ratio(F.col("max_price") - F.col("min_price"), F.col("avg_price")) * 100
    return F.when(F.col("avg_price") > 0, spread).otherwise(0.0).alias("price_spread_pct")


def window_end_micros(micros: Column, seconds: int) -> Column:
    """The end of the window that holds an instant, both in microseconds since the epoch."""
    length = seconds * 1_000_000
    return (F.floor(micros / length) + 1) * length


def window_rules(settings: Settings = DEFAULTS) -> list[tuple[str, Column]]:
    """Reason text and condition of each rule, in reporting order; thresholds are inclusive."""
    # Reason texts.
    return [
        ("price_spread", F.col("price_spread_pct") >= settings.spread_threshold_pct),
        ("large_trade", F.col("max_trade_value") >= settings.large_trade_value),
        ("traffic_spike", F.col("trade_count") >= settings.high_trade_count),
    ]


def flag_windows(metrics: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    rules = window_rules(settings)
    flagged = metrics.withColumns(
        {
            "is_anomaly": reduce(Column.__or__, [hit for _, hit in rules]),
            "anomaly_reason": F.concat_ws(",", *[F.when(hit, name) for name, hit in rules]),
        }
    )
    return flagged.select(*WINDOW_AGGREGATE.fieldNames())


def window_aggregates(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Clean trades to flagged window rows: the transform batch and stream share."""
    return flag_windows(window_metrics(trades, settings.window_seconds), settings)


def window_anomalies(aggregates: DataFrame) -> DataFrame:
    return aggregates.filter("is_anomaly")
