"""Summaries and chart datasets over trades and over window rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.times import hour_of_day
from tapewright.functions.values import ratio, text_or
from tapewright.operators.joins import join_lookup
from tapewright.operators.quantiles import exact_quantiles
from tapewright.operators.slicing import Slices
from tapewright.operators.sampling import thin_series

# Fallback reasons and tags in anomaly lists.
STREAM_RULE = "stream_rule"
SCORE_THRESHOLD = "score_threshold"
FOREST_REASON = "isolation_forest"
STREAM_SOURCE, BATCH_SOURCE, EMPTY_SOURCE = "spark_stream", "cleaned_batch", "empty"
WHISKER_REACH = 1.5


# --- over trades -----------------------------------------------------------------------------


def volume_by_symbol(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(F.sum("quantity").alias("volume"))


def trade_count_by_symbol(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(F.count("*").alias("trade_count"))


def trade_count_by_hour(trades: DataFrame) -> DataFrame:
    hour = hour_of_day(trades, "trade_time").alias("hour")
    timed = trades.filter(F.col("trade_time").isNotNull())
    return timed.groupBy(hour).agg(F.count("*").alias("trade_count"))


def trade_value_histogram(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins are listed."""
    bins = settings.histogram_bins
    values = trades.select(F.col("trade_value").alias("v")).filter(F.col("v").isNotNull())
    extremes = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    # A single distinct value gets a range of one unit around it.
    margin = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    low = extremes.select(F.col("lo") - margin).scalar()
    high = extremes.select(F.col("hi") + margin).scalar()
    number = F.least(F.lit(bins), F.floor((F.col("v") - low) / ((high - low) / bins)) + 1)
    counts = values.groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    edge = lambda i: low + i * ((high - low) / bins)
    every = trades.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("bin_start"),
        edge(F.col("bin")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("trade_count"),
    )


def price_box_stats(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 IQR) and outlier count of the price by symbol."""
    quartiles = exact_quantiles(trades, ["symbol"], "price", [0.25, 0.5, 0.75], settings).select(
        "symbol",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    reach = WHISKER_REACH * (F.col("q3") - F.col("q1"))
    price = F.col("price")
    below, above = price < F.col("q1") - reach, price > F.col("q3") + reach
    return (
        join_lookup(trades.select("symbol", "price"), quartiles, ["symbol"], settings)
        .groupBy("symbol", "q1", "median", "q3")
        .agg(
            F.min(F.when(~below, price)).alias("low"),
            F.max(F.when(~above, price)).alias("high"),
            F.count_if(below | above).alias("outlier_count"),
        )
        .select(
            "symbol", "q1", "median", "q3",
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
            "outlier_count",
        )
    )


def price_outliers(
    trades: DataFrame, box_stats: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """The single trades a box plot draws beyond its whiskers."""
    beyond = (F.col("price") < F.col("whisker_low")) | (F.col("price") > F.col("whisker_high"))
    limits = box_stats.select("symbol", "whisker_low", "whisker_high")
    joined = join_lookup(trades, limits, ["symbol"], settings)
    return joined.filter(beyond).select(*trades.columns)


def trade_summary(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: size, symbols, time range and central values."""
    median = exact_quantiles(trades, [], "price", [0.5], settings)
    return trades.agg(
        F.count("*").alias("total_records"),
        F.sort_array(F.collect_set("symbol")).alias("symbols"),
        F.min("trade_time").alias("time_start"),
        F.max("trade_time").alias("time_end"),
        F.avg("price").alias("mean_price"),
        F.avg("quantity").alias("mean_quantity"),
        F.avg("trade_value").alias("mean_trade_value"),
    ).withColumn("median_price", median.select(F.col("quantiles")[0]).scalar())


def flagged_total(scored: DataFrame | None, flag: str) -> Column:
    """Number of flagged rows of another table, as a scalar subquery; 0 without a table."""
    if scored is None:
        return F.lit(0).cast("bigint")
    return scored.agg(F.count_if(F.col(flag)).alias("n")).select("n").scalar()


def batch_summary(
    trades: DataFrame, zscored: DataFrame | None = None, forest_scored: DataFrame | None = None
) -> DataFrame:
    totals = trades.agg(
        F.count("*").alias("total_records"),
        F.sort_array(F.collect_set("symbol")).alias("symbols"),
        F.min("trade_time").alias("time_start"),
        F.max("trade_time").alias("time_end"),
        F.coalesce(F.avg("trade_value"), F.lit(0.0)).alias("avg_trade_value"),
    )
    filled = F.col("total_records") > 0
    count = lambda n: F.when(filled, n).otherwise(0)
    return totals.select(
        F.when(filled, BATCH_SOURCE).otherwise(EMPTY_SOURCE).alias("source"),
        "total_records", "symbols", "time_start", "time_end", "avg_trade_value",
        count(flagged_total(zscored, "is_anomaly")).alias("anomaly_count"),
        count(flagged_total(forest_scored, "is_ml_anomaly")).alias("ml_anomaly_count"),
    )


def batch_symbol_aggregates(trades: DataFrame) -> DataFrame:
    return (
        trades.groupBy("symbol")
        .agg(
            F.avg("price").alias("avg_price"),
            F.sum("quantity").alias("volume"),
            F.count("*").alias("trade_count"),
            F.max("trade_value").alias("max_trade_value"),
        )
        .orderBy("symbol")
    )


def price_points(trades: DataFrame) -> DataFrame:
    return trades.select(
        "symbol", F.col("trade_time").alias("time"), "price", "quantity", "trade_value"
    )


def price_series_sampled(
    trades: DataFrame, points: int | None = None, settings: Settings = DEFAULTS,
    slices: Slices | None = None,
) -> DataFrame:
    """Thinned price points per symbol, in time order."""
    thinned = thin_series(trades, points or settings.payload_series_points, settings, slices)
    return price_points(thinned).orderBy("symbol", F.asc_nulls_last("time"))


def series_bounds(points: DataFrame) -> DataFrame:
    """Vertical chart range per symbol: the extremes, padded by a tenth or by 1 at least."""
    bounds = points.groupBy("symbol").agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )
    pad = F.greatest((F.col("max_price") - F.col("min_price")) * 0.1, F.lit(1.0))
    return bounds.select(
        "symbol", "min_price", "max_price",
        (F.col("min_price") - pad).alias("low"), (F.col("max_price") + pad).alias("high"),
    )


def sample_head(trades: DataFrame, rows: int | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    order = [F.asc_nulls_last("trade_time"), F.asc_nulls_last("trade_id")]
    return trades.orderBy(*order).limit(rows or settings.top_rows)


# --- scores ----------------------------------------------------------------------------------


def zscore_size() -> Column:
    return F.greatest(F.abs("price_zscore"), F.abs("trade_value_zscore"))


def largest_zscores(scored: DataFrame, rows: int) -> DataFrame:
    ranked = scored.filter("is_anomaly").withColumn("score", zscore_size())
    return ranked.orderBy(F.desc("score"), "trade_id").limit(rows)


def top_zscore_anomalies(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return largest_zscores(scored, settings.top_rows).select(
        "trade_time", "symbol", "price", "quantity", "trade_value",
        "price_zscore", "trade_value_zscore",
    )


def zscore_anomaly_history(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The highest-scoring flagged trades with the scores that crossed the threshold."""
    crossed = [
        F.when(F.abs(F.col(c)) >= settings.z_threshold, c)
        for c in ("price_zscore", "trade_value_zscore")
    ]
    return largest_zscores(scored, settings.history_rows).select(
        F.col("trade_time").alias("detected_at"),
        "symbol", "price", "quantity", "trade_value", "price_zscore", "trade_value_zscore",
        text_or(F.concat_ws(", ", *crossed), SCORE_THRESHOLD).alias("reason"),
    )


def highest_forest_scores(scored: DataFrame, rows: int) -> DataFrame:
    flagged = scored.filter("is_ml_anomaly")
    return flagged.orderBy(F.desc("ml_anomaly_score"), "trade_id").limit(rows)


def iforest_top(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return highest_forest_scores(scored, settings.top_rows).select(
        "trade_time", "symbol", "price", "quantity", "trade_value", "ml_anomaly_score"
    )


def iforest_history(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return highest_forest_scores(scored, settings.history_rows).select(
        F.col("trade_time").alias("detected_at"),
        "symbol", "price", "quantity", "trade_value", "ml_anomaly_score",
        F.coalesce("ml_model", F.lit("IsolationForest")).alias("model"),
        F.lit(FOREST_REASON).alias("reason"),
    )


# --- over window rows ------------------------------------------------------------------------


def stream_count_by_hour(windows: DataFrame) -> DataFrame:
    hour = hour_of_day(windows, "window_start").alias("hour")
    return windows.groupBy(hour).agg(F.sum("trade_count").alias("trade_count"))


def stream_volume_over_time(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start").agg(F.sum("volume").alias("volume"))


def stream_anomaly_counts(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start").agg(
        F.count_if("is_anomaly").alias("anomaly_windows")
    )


def stream_price_points(windows: DataFrame) -> DataFrame:
    return windows.select(
        "symbol",
        F.col("window_start").alias("time"),
        F.col("avg_price").alias("price"),
        F.col("volume").alias("quantity"),
        F.col("notional_volume").alias("trade_value"),
    )


def stream_price_series(
    windows: DataFrame, points: int | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """Average price over time per symbol; with ``points``, thinned as trades are."""
    series = stream_price_points(windows)
    if points:
        keyed = series.withColumnRenamed("time", "trade_time").withColumn(
            "trade_id", F.lit(None).cast("bigint")
        )
        series = thin_series(keyed, points, settings).select(
            "symbol", F.col("trade_time").alias("time"), "price", "quantity", "trade_value"
        )
    return series.orderBy("time", "symbol")


def stream_summary(windows: DataFrame, forest_scored: DataFrame | None = None) -> DataFrame:
    mean_value = ratio(F.sum("notional_volume"), F.sum("trade_count"))
    flagged = flagged_total(forest_scored, "is_ml_anomaly")
    return windows.agg(
        F.coalesce(F.sum("trade_count"), F.lit(0)).alias("total_records"),
        F.sort_array(F.collect_set("symbol")).alias("symbols"),
        F.min("window_start").alias("time_start"),
        F.max("window_end").alias("time_end"),
        F.coalesce(mean_value, F.lit(0.0)).alias("avg_trade_value"),
        F.count_if("is_anomaly").alias("anomaly_count"),
    ).select(F.lit(STREAM_SOURCE).alias("source"), "*", flagged.alias("ml_anomaly_count"))


def stream_symbol_aggregates(windows: DataFrame) -> DataFrame:
    """Windows re-aggregated to symbols; prices weighted by trade count."""
    weighted = ratio(F.sum(F.col("avg_price") * F.col("trade_count")), F.sum("trade_count"))
    return (
        windows.groupBy("symbol")
        .agg(
            F.coalesce(weighted, F.avg("avg_price")).alias("avg_price"),
            F.sum("volume").alias("volume"),
            F.sum("trade_count").alias("trade_count"),
            F.max("max_trade_value").alias("max_trade_value"),
        )
        .orderBy("symbol")
    )


def stream_anomaly_history(windows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The newest flagged windows."""
    newest = windows.filter("is_anomaly").orderBy(F.desc("window_start"), "symbol")
    return newest.limit(settings.history_rows).select(
        F.col("window_start").alias("detected_at"),
        "symbol",
        F.col("avg_price").alias("price"),
        F.col("volume").alias("quantity"),
        F.col("notional_volume").alias("trade_value"),
        F.lit(0.0).alias("price_zscore"),
        F.lit(0.0).alias("trade_value_zscore"),
        text_or(F.col("anomaly_reason"), STREAM_RULE).alias("reason"),
    )
