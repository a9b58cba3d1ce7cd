"""File inputs: newest match, JSON lines, typed CSV, optional and required tables."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.times import utc_day
from tapewright.functions.values import truthy_text
from tapewright.operators.parse import parse_trades
from tapewright.schemas import WINDOW_AGGREGATE
from tapewright.sources import storage
from tapewright.sources.storage import OPENED, current, open_uri

# Python workers get these functions with the job, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(storage)


def is_missing(error: AnalysisException) -> bool:
    """Whether an error says that there is no such input, and not that it is broken."""
    return error.getCondition() == "PATH_NOT_FOUND"


def latest_input(spark: SparkSession, directory: str, pattern: str) -> str | None:
    """Path of the most recently modified file, or directory of part files, that matches.

    Only names and times are listed; file contents are not read.
    """
    base = directory.rstrip("/")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = listing.load(f"{base}/{pattern}").select("path", "modificationTime")
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    where = spark._jvm.org.apache.hadoop.fs.Path(base)
    whole = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    entry = F.substring_index(F.substring(F.col("path"), len(whole) + 2, 1 << 20), "/", 1)
    newest = (
        files.groupBy(entry.alias("entry"))
        .agg(F.max("modificationTime").alias("changed"))
        .orderBy(F.desc("changed"), F.desc("entry"))
        .first()
    )
    return f"{base}/{newest['entry']}" if newest else None


def required_input(spark: SparkSession, directory: str, pattern: str) -> str:
    found = latest_input(spark, directory, pattern)
    if found is None:
        raise FileNotFoundError(f"No file matching {pattern} in {directory}")
    return found


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``, blank lines skipped."""
    return spark.read.text(path).filter(F.trim("value") != "")


def read_raw_trades(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines file or directory of compact records to typed, uncleaned trades."""
    return parse_trades(read_records(spark, path))


def typed_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to ``schema``; unreadable values give null, unreadable flags false."""

    def typed(field: T.StructField):
        text = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return truthy_text(text)
        if isinstance(field.dataType, T.TimestampType):
            return F.try_to_timestamp(text)
        return text.try_cast(field.dataType)

    return df.select(*[typed(f).alias(f.name) for f in schema])


#: Bytes that are read of a file at a time, and at most, to find the end of its first line.
HEAD_PIECE, HEAD_BYTES = 1 << 14, 1 << 20


def first_line(stream) -> str:
    """The first line of an open binary file; no more than HEAD_BYTES are read for it."""
    head = b""
    while b"\n" not in head and len(head) < HEAD_BYTES:
        piece = stream.read(HEAD_PIECE)
        if not piece:
            break
        head += piece
    return head.split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r").removeprefix("\ufeff")


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for path in batch.column("path").to_pylist():
            system, place = open_uri(path)
            with system.open_input_stream(place, compression="detect") as stream:
                lines.append(first_line(stream))
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), batch.column("path")], names=["header", "path"])


def _headers_by_scan(spark: SparkSession, path: str) -> DataFrame:
    """header, path from Spark's own reader, for paths that tasks cannot open; files are read in full."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = text.select("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"), "value")
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min(F.struct("n", "value"))["value"].alias("header"))
    named = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))  # Spark encodes it
    return first.select(F.ltrim("header", F.lit("\ufeff")).alias("header"), named.alias("path"))


def csv_layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The headers of the CSV files below ``path``, and the files of each.

    Tasks read the head of each file, a few kilobytes; files with the same header meet before the
    driver sees them, in one row per layout.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listed.where("length > 0").select("path")  # names and sizes; contents are not read
    whole = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = whole.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    found = listed.mapInArrow(_headers, "header string, path string") if scheme in OPENED else _headers_by_scan(spark, path)
    layouts = found.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files"))
    out: dict[tuple[str, ...], list[str]] = {}
    for row in layouts.orderBy(F.col("files")[0]).collect():
        names = tuple(name.strip() for name in next(csv.reader([row["header"]]), []))
        out.setdefault(names, []).extend(row["files"])
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV below ``path``, matched to ``schema`` by column name and read leniently.

    Files may have other orders of columns, further columns, or lack some, which are null then.
    """
    out = None
    layouts = csv_layouts(spark, path)
    for names, files in layouts.items():
        if not set(names) & set(schema.names):
            raise ValueError(f"No known column in the header of {files[0]}")
        text = T.StructType([T.StructField(name, T.StringType(), True) for name in names])
        # With one layout Spark lists the files itself.
        reader = spark.read.option("header", "true").schema(text)
        raw = reader.option("recursiveFileLookup", "true").csv(path) if len(layouts) == 1 else reader.csv(files)
        absent = {f.name: F.lit(None).cast("string") for f in schema if f.name not in names}
        rows = typed_columns(raw.withColumns(absent) if absent else raw, schema)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet or CSV table with ``schema``, told apart by the file names inside ``path``.

    Of a table that is replaced by snapshots the current one is read.
    """
    path = current(spark, path)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path").filter(F.lower("path").contains(".csv")).limit(1)
    )
    if files.isEmpty():
        return spark.read.schema(schema).parquet(path)
    return read_csv(spark, path, schema)


def read_optional(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one if there is none."""
    if path is not None:
        try:
            return read_table(spark, path, schema)
        except AnalysisException as error:
            if not is_missing(error):
                raise
    return spark.createDataFrame([], schema)


def read_stream_aggregates(spark: SparkSession, directory: str) -> DataFrame:
    """All window rows a streaming job has committed to ``directory``.

    Reading the directory, not single files, makes Spark follow the sink's commit log, so files
    of an unfinished batch are left out.
    """
    try:
        rows = read_sink(spark, directory)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        raise FileNotFoundError(f"No window aggregates under {directory}") from error
    return rows.withColumn("anomaly_reason", F.coalesce("anomaly_reason", F.lit("")))


def read_sink(spark: SparkSession, directory: str) -> DataFrame:
    """A streaming sink's output in CSV (header) or parquet form."""
    files = spark.read.option("recursiveFileLookup", "true").text(directory).inputFiles()
    if not any(".csv" in name.rsplit("/", 1)[-1] for name in files):
        return spark.read.schema(WINDOW_AGGREGATE).option("recursiveFileLookup", "true").parquet(directory)
    return read_csv(spark, directory, WINDOW_AGGREGATE)


#: The folder column of window rows that are kept by date.
DAY = "window_date"


def with_day(windows: DataFrame) -> DataFrame:
    """Window rows with the date (UTC) that they start on."""
    return windows.withColumn(DAY, utc_day(windows, "window_start"))


def read_days(spark: SparkSession, directory: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Window rows of a sink kept by date, of windows that start in [start, end) (UTC times as text).

    The times are turned into dates, by which folders are skipped before any file is listed for
    reading; which files count is told by the sink's commit log.
    """
    kept = T.StructType([*WINDOW_AGGREGATE.fields, T.StructField(DAY, T.DateType(), True)])
    rows = spark.read.schema(kept).parquet(directory)
    instant = lambda text: F.lit(f"{text}Z" if "T" in text or ":" in text else f"{text} 00:00:00Z").cast("timestamp")
    day = lambda text: F.lit(text[:10]).cast("date")
    if start:
        rows = rows.where((F.col(DAY) >= day(start)) & (F.col("window_start") >= instant(start)))
    if end:
        rows = rows.where((F.col(DAY) <= day(end)) & (F.col("window_start") < instant(end)))
        if end[10:].strip("T 0:.") == "":  # midnight: nothing of that day
            rows = rows.where(F.col(DAY) < day(end))
    return rows.drop(DAY)
