"""Stream and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tapewright.config import DEFAULTS, Settings
from tapewright.streaming.monitor import watch

TABLE_SINKS = ("parquet", "csv")
SINKS = (*TABLE_SINKS, "console", "kafka")


def paced(rows: DataFrame, settings: Settings, available_now: bool) -> DataStreamWriter:
    """Append-mode writer: a processing-time trigger, or one pass over what is there."""
    watch(rows.sparkSession)
    writer = rows.writeStream.outputMode("append")
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{settings.trigger_seconds} seconds")


def start_table_sink(
    rows: DataFrame, path: str, checkpoint: str, sink: str = "parquet",
    settings: Settings = DEFAULTS, available_now: bool = False, partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to a directory; the checkpoint makes a restart go on without repeats.

    With ``partition_by``, each value of these columns has a folder of its own, which readers skip
    if they do not want it; the sink's commit log still tells which files count.
    """
    if sink not in TABLE_SINKS:
        raise ValueError(f"Not a table sink: {sink}")
    writer = paced(rows, settings, available_now).format(sink).partitionBy(*partition_by)
    if sink == "csv":
        writer = writer.option("header", "true")
    return writer.option("checkpointLocation", checkpoint).start(path)


def start_console_sink(
    rows: DataFrame, settings: Settings = DEFAULTS, available_now: bool = False
) -> StreamingQuery:
    return paced(rows, settings, available_now).format("console").option("truncate", "false").start()


def start_topic_sink(
    keyed: DataFrame, topic: str, servers: str, checkpoint: str,
    settings: Settings = DEFAULTS, available_now: bool = False,
) -> StreamingQuery:
    """Write ``key`` / ``value`` rows to a topic; needs Spark's Kafka connector."""
    writer = paced(keyed, settings, available_now).format("kafka")
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return writer.options(**options).option("checkpointLocation", checkpoint).start()


def write_table(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if form == "csv":
        # Empty text is written unquoted and reads back as null; readers restore it.
        writer.option("header", "true").csv(path)
    else:
        writer.format(form).save(path)
    return path


def write_lines(df: DataFrame, path: str, column: str = "value", mode: str = "errorifexists") -> str:
    """One text line per row, as JSON-lines files or a JSON document need it."""
    df.select(column).write.mode(mode).text(path)
    return path
