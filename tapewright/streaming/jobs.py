"""The live jobs: messages to keyed records, and records to flagged windows."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapewright.config import DEFAULTS, Settings
from tapewright.operators.clean import clean_trades_stream, observed_cleaning
from tapewright.operators.parse import (
    keyed_records,
    normalize_messages,
    parse_messages,
    parse_trades,
)
from tapewright.operators.windows import window_aggregates
from tapewright.streaming.monitor import progress_rows


def message_records(messages: DataFrame) -> DataFrame:
    """Stream of raw exchange messages (``value``, ``timestamp``) to compact records."""
    decoded = parse_messages(messages, keep=("timestamp",))
    return normalize_messages(decoded, F.col("timestamp"))


def keyed_message_records(messages: DataFrame) -> DataFrame:
    return keyed_records(message_records(messages))


def with_event_time(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return trades.withWatermark("trade_time", f"{settings.watermark_seconds} seconds")


def windowed_trades(
    trades: DataFrame, settings: Settings = DEFAULTS, drop_repeats: bool = False,
    observe: bool = False,
) -> DataFrame:
    """Typed trades to flagged windows, each emitted once after the watermark passes its end.

    ``drop_repeats`` also removes repeated ids within the watermark delay; ``observe`` counts what
    the cleaning rules drop (``monitor.cleaning_progress`` tells).
    """
    trades = observed_cleaning(trades, settings) if observe else trades
    timed = with_event_time(clean_trades_stream(trades, settings), settings)
    if drop_repeats:
        timed = timed.dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    return window_aggregates(timed, settings)


def windowed_records(
    records: DataFrame, settings: Settings = DEFAULTS, drop_repeats: bool = False,
    observe: bool = False,
) -> DataFrame:
    """As ``windowed_trades``, from compact JSON records in ``value``."""
    return windowed_trades(parse_trades(records), settings, drop_repeats, observe)


def run_bounded(
    query: StreamingQuery, seconds: float | None = None, max_rows: int | None = None,
    poll: float = 0.5,
) -> int:
    """Wait for the query; stop it after ``seconds`` or once ``max_rows`` input rows were read.

    Without limits, runs until the query ends. Returns the number of input rows read.
    """
    if not seconds and not max_rows:
        query.awaitTermination()
        return rows_read(query)
    deadline = time.monotonic() + seconds if seconds else None
    while query.isActive:
        if max_rows and rows_read(query) >= max_rows:
            break
        left = poll if deadline is None else min(poll, deadline - time.monotonic())
        if left <= 0 or query.awaitTermination(left):
            break
    if query.isActive:
        query.stop()
    return rows_read(query)


def rows_read(query: StreamingQuery) -> int:
    """Input rows of all batches of this run, however many progress updates Spark keeps."""
    return sum(row[1] for row in progress_rows(query))
