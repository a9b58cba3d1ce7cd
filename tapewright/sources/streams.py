"""Streaming inputs: a broker topic, or a directory that receives files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.values import split_symbols

# Default topic and broker address.
DEFAULT_TOPIC = "crypto.trades"
DEFAULT_SERVERS = "localhost:9092"


def topic_stream(
    spark: SparkSession,
    topic: str = DEFAULT_TOPIC,
    servers: str = DEFAULT_SERVERS,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """``value`` and broker ``timestamp`` of a topic, from its beginning on the first start.

    Needs Spark's Kafka connector on the class path. Reading is as parallel as the topic has
    partitions; ``min_partitions`` splits them further.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return spark.readStream.format("kafka").options(**options).load().select("value", "timestamp")


def line_stream(
    spark: SparkSession, directory: str, max_files: int | None = None
) -> DataFrame:
    """``value`` lines of text files as they appear in ``directory``; blank lines skipped."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(directory).filter(F.trim("value") != "")


def table_stream(
    spark: SparkSession, directory: str, schema, pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Rows of parquet files as they appear in ``directory``."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(directory)


def subscription(products: str) -> list[str]:
    """Product ids to subscribe to, from comma-separated text."""
    return split_symbols(products)
