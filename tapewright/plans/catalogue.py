"""Every operator as a query over the star-schema tables, keyed by name.

Windows are one hour wide with thresholds near the 90th percentile, so that each rule fires on
the given ``events``. Doubles are rounded so that a different order of addition does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.config import Settings
from tapewright.functions.times import as_instant, as_wall_clock, iso_text
from tapewright.operators import clean, forest, payload, reports, rolling, windows
from tapewright.operators.joins import join_lookup
from tapewright.operators.parse import (
    compact_json,
    keyed_records,
    normalize_messages,
    parse_messages,
    parse_trades,
)
from tapewright.session import for_streams, materialize, scratch_path
from tapewright.sources.files import read_sink, read_stream_aggregates
from tapewright.sources.generate import faulty_copies, synthesize
from tapewright.sources.streams import table_stream
from tapewright.sources.tables import (
    compact_from_events,
    event_trades,
    lineitem_trades,
    trades_from_events,
)
from tapewright.streaming.jobs import keyed_message_records, windowed_trades
from tapewright.streaming.monitor import progress_table
from tapewright.streaming.sinks import start_table_sink

Query = Callable[[SparkSession, str], DataFrame]

HOURLY = Settings(
    window_seconds=3600, spread_threshold_pct=245.0, large_trade_value=10_000.0,
    high_trade_count=6,
)
STREAM_POINTS = 100
SYNTHETIC_START_MS = 1_704_067_200_000
LATE_SPLIT = "2024-01-16 00:00:00"


def rounded(df: DataFrame, places: int = 6, **special: int) -> DataFrame:
    """Round all doubles; adding zero turns minus zero into zero."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns(
        {c: F.round(F.col(c), special.get(c, places)) + F.lit(0.0) for c in doubles}
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.valid_trades(event_trades(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_aggregates(
        clean.clean_trades_stream(event_trades(spark, sf_dir)), HOURLY
    )


# --- parsing and cleaning ----------------------------------------------------------------------


def parse_query(spark, sf_dir):
    records = compact_from_events(events(spark, sf_dir))
    lines = records.select(compact_json(records).alias("value"))
    return as_wall_clock(parse_trades(lines), "trade_time")


def dirty_trades(spark, sf_dir):
    """All records and a faulty copy of each, through JSON text and the parser."""
    records = compact_from_events(events(spark, sf_dir))
    first_id = records.agg(F.min("trade_id").alias("id")).select("id").scalar()
    copies = faulty_copies(records, F.col("trade_id") % 5, first_id)
    every = records.unionByName(copies)
    lines = every.select(compact_json(every).alias("value"))
    return as_wall_clock(parse_trades(lines), "trade_time")


def clean_query(spark, sf_dir):
    return clean.in_time_order(clean.clean_trades(dirty_trades(spark, sf_dir)))


def clean_stream_query(spark, sf_dir):
    return clean.clean_trades_stream(dirty_trades(spark, sf_dir))


def dedupe_query(spark, sf_dir):
    return clean.dedupe_trades(dirty_trades(spark, sf_dir))


def cleaning_report_query(spark, sf_dir):
    return clean.cleaning_report(dirty_trades(spark, sf_dir))


def symbol_filter_query(spark, sf_dir):
    return clean.symbol_filter(event_trades(spark, sf_dir), ["click", "view"])


def sample_head_query(spark, sf_dir):
    return reports.sample_head(valid(spark, sf_dir))


def synthetic_query(spark, sf_dir):
    """Generated trades: as many per symbol as given, around each symbol's mean given price."""
    given = valid(spark, sf_dir)
    bases = given.groupBy("symbol").agg(F.round(F.avg("price"), 2).alias("base_price"))
    slots = join_lookup(given, bases, ["symbol"]).select(
        "symbol", "base_price", F.col("trade_id").alias("n"), F.lit(100_000_000).alias("first_id")
    )
    made = synthesize(slots, 42, F.lit(SYNTHETIC_START_MS), rows_per_block=20_000)
    return rounded(made.drop("kind"))


# --- exchange messages -------------------------------------------------------------------------


def messages_from_events(frame: DataFrame) -> DataFrame:
    """``events`` as raw exchange messages in JSON text, with gaps in every field."""
    n = F.col("event_id")
    kinds = F.array(*[F.lit(k) for k in ("ticker", "match", "last_match", "heartbeat")])
    size = F.get_json_object("props", "$.k")
    every = lambda k, value: F.when(n % k != 0, value)
    message = F.struct(
        F.get(kinds, (n % 4).cast("int")).alias("type"),
        every(11, F.concat(F.upper("event_type"), F.lit("-USD"))).alias("product_id"),
        every(13, F.concat(iso_text(frame, "ts"), F.lit("Z"))).alias("time"),
        every(7, F.col("value").cast("string")).alias("price"),
        F.when(n % 3 == 0, F.lit("")).otherwise(size).alias("last_size"),
        every(5, size).alias("size"),
        every(17, n).alias("trade_id"),
        F.when(n % 2 == 0, F.lit("sell")).when(n % 3 == 0, F.lit("buy")).alias("side"),
    )
    return frame.select(
        F.to_json(message).alias("value"),
        F.lit("2024-02-01T00:00:00Z").cast("timestamp").alias("timestamp"),
    )


def normalize_query(spark, sf_dir):
    messages = parse_messages(messages_from_events(events(spark, sf_dir)), keep=("timestamp",))
    return normalize_messages(messages, F.col("timestamp"))


def keyed_query(spark, sf_dir):
    return keyed_records(normalize_query(spark, sf_dir))


# --- scores ------------------------------------------------------------------------------------


def zscored(spark, sf_dir):
    return rolling.rolling_zscore(valid(spark, sf_dir))


def zscore_query(spark, sf_dir):
    return rounded(zscored(spark, sf_dir))


def features_query(spark, sf_dir):
    return rounded(rolling.ml_features(valid(spark, sf_dir)))


def scaled_query(spark, sf_dir):
    return rounded(rolling.scaled_features(rolling.ml_features(valid(spark, sf_dir))))


def top_zscores_query(spark, sf_dir):
    return rounded(reports.top_zscore_anomalies(zscored(spark, sf_dir)))


def zscore_history_query(spark, sf_dir):
    return rounded(reports.zscore_anomaly_history(zscored(spark, sf_dir)))


def forest_scored(spark, sf_dir):
    return forest.iforest_scores(valid(spark, sf_dir))


def forest_query(spark, sf_dir):
    return rounded(forest_scored(spark, sf_dir))


def forest_top_query(spark, sf_dir):
    return rounded(reports.iforest_top(forest_scored(spark, sf_dir)))


def forest_history_query(spark, sf_dir):
    return rounded(reports.iforest_history(forest_scored(spark, sf_dir)))


# --- batch reports -----------------------------------------------------------------------------


def joined_symbols(df: DataFrame) -> DataFrame:
    return df.withColumn("symbols", F.array_join("symbols", ","))


def over_valid(report: Callable[[DataFrame], DataFrame], **places: int) -> Query:
    return lambda spark, sf_dir: rounded(report(valid(spark, sf_dir)), **places)


def batch_summary_query(spark, sf_dir):
    trades = valid(spark, sf_dir)
    return rounded(joined_symbols(reports.batch_summary(trades, rolling.rolling_zscore(trades))))


def by_hour_query(spark, sf_dir):
    hours = reports.trade_count_by_hour(valid(spark, sf_dir))
    return hours.withColumn("hour", F.col("hour").cast("bigint"))


def histogram_query(spark, sf_dir):
    bins = reports.trade_value_histogram(valid(spark, sf_dir))
    return rounded(bins.withColumn("bin", F.col("bin").cast("bigint")))


def summary_query(spark, sf_dir):
    return rounded(joined_symbols(reports.trade_summary(valid(spark, sf_dir))))


def sampled_series_query(spark, sf_dir):
    return rounded(reports.price_series_sampled(valid(spark, sf_dir)))


def supplier_aggregates_query(spark, sf_dir):
    trades = clean.valid_trades(lineitem_trades(spark, sf_dir))
    return rounded(reports.batch_symbol_aggregates(trades), 4)


# --- window rows -------------------------------------------------------------------------------


def over_hourly(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(report(hourly(spark, sf_dir)))


def stream_by_hour_query(spark, sf_dir):
    hours = reports.stream_count_by_hour(hourly(spark, sf_dir))
    return hours.withColumn("hour", F.col("hour").cast("bigint"))


def stream_summary_query(spark, sf_dir):
    summary = reports.stream_summary(hourly(spark, sf_dir))
    return rounded(joined_symbols(summary))


# --- streams -----------------------------------------------------------------------------------


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams: state partitions are fixed by the first start."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return for_streams(session, spark.sparkContext.defaultParallelism)


def stream_event_trades(session: SparkSession, directory: str, schema, pattern=None) -> DataFrame:
    stream = table_stream(session, directory, schema, pattern)
    return as_instant(trades_from_events(stream), "trade_time")


def run_window_stream(spark: SparkSession, sf_dir: str, sink: str) -> str:
    """Run the windowed job over ``events`` as a stream until all is read; returns the output."""
    session = stream_session(spark)
    schema = events(spark, sf_dir).schema
    trades = stream_event_trades(session, sf_dir, schema, "events.parquet")
    out = scratch_path(spark, f"windows-{sink}")
    query = start_table_sink(
        windowed_trades(trades, HOURLY), out, f"{out}-checkpoint", sink, HOURLY,
        available_now=True,
    )
    query.awaitTermination()
    return out


def stream_windows_query(spark, sf_dir):
    written = read_sink(spark, run_window_stream(spark, sf_dir, "parquet"))
    return rounded(as_wall_clock(written, "window_start", "window_end"))


def stream_scan_query(spark, sf_dir):
    rows = read_stream_aggregates(spark, run_window_stream(spark, sf_dir, "csv"))
    return rounded(as_wall_clock(rows, "window_start", "window_end"))


def stream_messages_query(spark, sf_dir):
    """Messages arriving as a stream, written as keyed records to files."""
    session = stream_session(spark)
    stream = table_stream(session, sf_dir, events(spark, sf_dir).schema, "events.parquet")
    keyed = keyed_message_records(messages_from_events(stream))
    out = scratch_path(spark, "keyed-records")
    start_table_sink(keyed, out, f"{out}-checkpoint", available_now=True).awaitTermination()
    return spark.read.schema("key string, value string").parquet(out)


def late_data_query(spark, sf_dir):
    """Three starts of one stream: early events, later events, early events once more.

    The last delivery lies behind the watermark, which the checkpoint carries across restarts.
    """
    given = events(spark, sf_dir)
    inbox = scratch_path(spark, "late-inbox")
    out = scratch_path(spark, "late-windows")
    session = stream_session(spark)
    early = F.col("ts") < F.lit(LATE_SPLIT).cast("timestamp_ntz")
    deliveries = [given.filter(early), given.filter(~early), given.filter(early)]
    runs = []
    for number, delivery in enumerate(deliveries, start=1):
        delivery.write.mode("append").parquet(inbox)
        trades = stream_event_trades(session, inbox, given.schema)
        query = start_table_sink(
            windowed_trades(trades, HOURLY), out, f"{out}-checkpoint", settings=HOURLY,
            available_now=True,
        )
        query.awaitTermination()
        runs.append(progress_table(spark, query).withColumn("run", F.lit(number)))
    progress = runs[0].unionByName(runs[1]).unionByName(runs[2])
    emitted = read_sink(spark, out).agg(F.sum("trade_count").alias("n")).select("n").scalar()
    per_run = progress.groupBy("run").agg(
        F.sum("input_rows").alias("input_rows"),
        (F.sum("late_rows_dropped") > 0).alias("dropped_late"),
        F.max("watermark").alias("watermark"),
    )
    return per_run.withColumn("trades_emitted", emitted)


# --- documents ---------------------------------------------------------------------------------


def payload_query(spark, sf_dir):
    """The batch document; the z-scores feed several parts, so they are written once."""
    trades = valid(spark, sf_dir)
    zscores = materialize(rolling.rolling_zscore(trades), "payload-zscores")
    return payload.batch_payload(trades, zscores, forest.iforest_scores(trades), pretty=False)


def stream_payload_query(spark, sf_dir):
    rows = materialize(hourly(spark, sf_dir), "payload-windows")
    return payload.stream_payload(rows, forest_scored(spark, sf_dir), HOURLY, pretty=False)


QUERIES: dict[str, Query] = {
    "parse_trades": parse_query,
    "dirty_trades": dirty_trades,
    "clean_trades": clean_query,
    "clean_trades_stream": clean_stream_query,
    "dedupe_trades": dedupe_query,
    "cleaning_report": cleaning_report_query,
    "symbol_filter": symbol_filter_query,
    "sample_head": sample_head_query,
    "synthetic_trades": synthetic_query,
    "normalize_messages": normalize_query,
    "keyed_trade_records": keyed_query,
    "window_agg": over_hourly(lambda w: w),
    "window_anomalies": over_hourly(windows.window_anomalies),
    "rolling_zscore": zscore_query,
    "top_zscore_anomalies": top_zscores_query,
    "zscore_anomaly_history": zscore_history_query,
    "ml_features": features_query,
    "scaled_features": scaled_query,
    "iforest_scores": forest_query,
    "iforest_top": forest_top_query,
    "iforest_history": forest_history_query,
    "volume_by_symbol": over_valid(reports.volume_by_symbol),
    "trade_count_by_symbol": over_valid(reports.trade_count_by_symbol),
    "trade_count_by_hour": by_hour_query,
    "trade_value_histogram": histogram_query,
    "price_box_stats": over_valid(reports.price_box_stats),
    "trade_summary": summary_query,
    "batch_summary": batch_summary_query,
    "batch_symbol_aggregates": over_valid(reports.batch_symbol_aggregates),
    "price_series_sampled": sampled_series_query,
    "series_bounds": over_valid(reports.series_bounds),
    "supplier_aggregates": supplier_aggregates_query,
    "stream_count_by_hour": stream_by_hour_query,
    "stream_volume_over_time": over_hourly(reports.stream_volume_over_time),
    "stream_anomaly_counts": over_hourly(reports.stream_anomaly_counts),
    "stream_summary": stream_summary_query,
    "stream_symbol_aggregates": over_hourly(reports.stream_symbol_aggregates),
    "stream_anomaly_history": over_hourly(reports.stream_anomaly_history),
    "stream_price_series": over_hourly(reports.stream_price_series),
    "stream_price_series_sampled": over_hourly(
        lambda w: reports.stream_price_series(w, STREAM_POINTS)
    ),
    "stream_window_agg": stream_windows_query,
    "stream_agg_scan": stream_scan_query,
    "stream_keyed_records": stream_messages_query,
    "late_data_report": late_data_query,
    "dashboard_payload": payload_query,
    "stream_dashboard_payload": stream_payload_query,
}
