"""Queries over live jobs: cleaning counts, dated sinks, open windows, late rows, first trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.times import as_instant, as_wall_clock
from tapewright.operators import clean
from tapewright.plans.catalogue import (
    HOURLY,
    LATE_SPLIT,
    Query,
    dirty_trades,
    events,
    rounded,
    run_window_stream,
    stream_event_trades,
    stream_session,
)
from tapewright.plans.oracle import HOURLY as HOURLY_SQL
from tapewright.plans.oracle import IN_BOUNDS, ORACLE, VALID, WINDOW_COLUMNS, WIRE
from tapewright.session import scratch_path
from tapewright.sources.files import DAY, read_days, read_sink, with_day
from tapewright.sources.streams import table_stream
from tapewright.streaming.jobs import windowed_trades, with_event_time
from tapewright.streaming.monitor import cleaning_progress
from tapewright.streaming.sinks import start_table_sink
from tapewright.streaming.state import open_windows, read_late_split, start_late_split

LIVE: dict[str, Query] = {}
LIVE_SQL: dict[str, str] = {}
ONE_DAY = ("2024-01-15", "2024-01-16")
MARK = "(SELECT max(trade_time) FROM t) - INTERVAL 120 SECOND"


def query(function: Query) -> Query:
    LIVE[function.__name__] = function
    return function


def dirty_deliveries(spark: SparkSession, sf_dir: str, parts: int) -> tuple[str, DataFrame]:
    """The dirty trades as files that arrive one after the other, in time order; and the trades."""
    trades = as_instant(dirty_trades(spark, sf_dir), "trade_time")
    inbox = scratch_path(spark, "inbox")
    trades.repartitionByRange(parts, "trade_time", "trade_id").write.parquet(inbox)
    return inbox, trades


@query
def stream_cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a live job dropped and why, from its own batches."""
    inbox, trades = dirty_deliveries(spark, sf_dir, 4)
    session = stream_session(spark)
    stream = table_stream(session, inbox, trades.schema, max_files=1)
    out = scratch_path(spark, "observed")
    running = start_table_sink(
        windowed_trades(stream, HOURLY, observe=True), out, f"{out}-checkpoint", settings=HOURLY, available_now=True
    )
    running.awaitTermination()
    batches = cleaning_progress(spark, running)
    return batches.agg(*[F.sum(c).alias(c) for c in clean.CLEANING_COUNTS])


LIVE_SQL["stream_cleaning_report"] = f"""WITH {WIRE},
tagged AS (
  SELECT *, CASE WHEN symbol IS NULL OR price IS NULL OR quantity IS NULL THEN 'null'
                 WHEN NOT ({IN_BOUNDS}) THEN 'invalid' ELSE 'ok' END AS verdict FROM dirty
)
SELECT count(*) AS before_rows, count(*) FILTER (WHERE verdict = 'null') AS null_rows,
       count(*) FILTER (WHERE verdict = 'invalid') AS invalid_rows,
       count(*) FILTER (WHERE verdict = 'ok' AND trade_time IS NULL) AS timeless_rows,
       count(*) FILTER (WHERE verdict = 'ok' AND symbol = '') AS blank_symbol_rows,
       count(*) FILTER (WHERE verdict = 'ok' AND trade_time IS NOT NULL) AS kept_rows
FROM tagged"""


@query
def stream_day_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of one day, from a live job's output that is kept by date."""
    session = stream_session(spark)
    trades = stream_event_trades(session, sf_dir, events(spark, sf_dir).schema, "events.parquet")
    out = scratch_path(spark, "by-day")
    start_table_sink(
        with_day(windowed_trades(trades, HOURLY)), out, f"{out}-checkpoint", settings=HOURLY,
        available_now=True, partition_by=[DAY],
    ).awaitTermination()
    day = read_days(spark, out, *ONE_DAY)
    return rounded(as_wall_clock(day.withColumn("anomaly_reason", F.coalesce("anomaly_reason", F.lit(""))), "window_start", "window_end"))


LIVE_SQL["stream_day_report"] = f"""WITH {HOURLY_SQL}
SELECT {WINDOW_COLUMNS} FROM w
WHERE window_start >= TIMESTAMP '{ONE_DAY[0]}' AND window_start < TIMESTAMP '{ONE_DAY[1]}' AND window_end <= {MARK}"""


@query
def stream_all_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emitted windows of a live job, and those that its checkpoint still holds open."""
    out = run_window_stream(spark, sf_dir, "parquet")
    still = open_windows(spark, f"{out}-checkpoint", HOURLY).withColumn("is_open", F.lit(True))
    every = read_sink(spark, out).withColumn("is_open", F.lit(False)).unionByName(still)
    return rounded(as_wall_clock(every, "window_start", "window_end"))


LIVE_SQL["stream_all_windows"] = f"""WITH {HOURLY_SQL}
SELECT {WINDOW_COLUMNS}, window_end > {MARK} AS is_open FROM w"""


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, the last one late: every row with what became of it."""
    given = events(spark, sf_dir)
    inbox, out = scratch_path(spark, "split-inbox"), scratch_path(spark, "split")
    early = F.col("ts") < F.lit(LATE_SPLIT).cast("timestamp_ntz")
    session = stream_session(spark)
    for delivery in (given.filter(early), given.filter(~early), given.filter(early)):
        delivery.write.mode("append").parquet(inbox)
        trades = clean.clean_trades_stream(stream_event_trades(session, inbox, given.schema))
        start_late_split(
            with_event_time(trades, HOURLY), out, f"{out}-checkpoint", HOURLY, available_now=True
        ).awaitTermination()
    return as_wall_clock(read_late_split(spark, out, trades.schema), "trade_time")


LIVE_SQL["stream_late_rows"] = f"""WITH {VALID}
SELECT *, false AS late FROM t
UNION ALL
SELECT *, time_bucket(INTERVAL 1 HOUR, trade_time) + INTERVAL 1 HOUR <= {MARK} AS late
FROM t WHERE trade_time < TIMESTAMP '{LATE_SPLIT}'"""


@query
def stream_first_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest trade per id of a live job that is started twice; repeats come within a day."""
    inbox, trades = dirty_deliveries(spark, sf_dir, 2)
    session = stream_session(spark)
    out = scratch_path(spark, "first-trades")
    settings = HOURLY.with_options(repeat_seconds=86_400)
    last = "2024-03-01T00:00:00Z"
    end = [(None, "end", -1, 1.0, 1.0, last)]
    ending = spark.createDataFrame(end, "nothing int, symbol string, trade_id bigint, price double, quantity double, at string")
    for start in range(2):
        if start:  # a trade far ahead lets every session end
            closing = ending.select("symbol", "trade_id", "price", "quantity", F.col("at").cast("timestamp").alias("trade_time"))
            closing.write.mode("append").parquet(inbox)
        stream = table_stream(session, inbox, trades.schema)
        timed = with_event_time(clean.clean_trades_stream(stream, settings), settings)
        start_table_sink(
            clean.dedupe_trades_stream(timed, settings), out, f"{out}-checkpoint", settings=settings, available_now=True
        ).awaitTermination()
    return as_wall_clock(spark.read.schema(timed.schema).parquet(out), "trade_time")


LIVE_SQL["stream_first_trades"] = ORACLE["clean_trades"]
