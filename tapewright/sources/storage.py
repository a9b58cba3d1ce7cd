"""Files and tables that are replaced at once, through the file system Spark uses for their path."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tapewright.streaming.sinks import write_table

#: Folder of the pointers to a table's snapshots.
POINTERS = "_snapshots"
#: Schemes of paths that tasks can open without the JVM.
OPENED = ("file", "hdfs", "s3", "gs")
_BUFFER = 1 << 20


def _at(spark: SparkSession, path: str):
    """(path, its file system) on the JVM's side."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def open_uri(uri: str):
    """Arrow's file system for a URI, and the path in it; for use in tasks."""
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:)?(?://(?=/))?(/.*)", uri)
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(uri)


def list_names(spark: SparkSession, directory: str) -> list[tuple[str, int]]:
    """Names and sizes of what a directory holds; nothing if there is no such directory."""
    where, system = _at(spark, directory)
    if not system.exists(where):
        return []
    return sorted((s.getPath().getName(), s.getLen()) for s in system.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)


def move_over(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, in place of another one if there is one; a directory there is removed first."""
    (old, system), (new, _) = _at(spark, source), _at(spark, target)
    if system.exists(new) and system.getFileStatus(new).isDirectory():
        system.delete(new, True)
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(system.makeQualified(old).toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(system.makeQualified(old), system.makeQualified(new), options)


def concatenate(spark: SparkSession, target: str, pieces: Iterable[str | tuple[str, int]]) -> None:
    """One file from texts and from files (path, bytes to skip), in order.

    Files are copied through a buffer of fixed size, whatever their number and length. The target
    appears, or changes, once all is written.
    """
    parent, _, name = target.rpartition("/")
    unfinished = f"{parent}/.{name}-{uuid.uuid4().hex}"
    where, system = _at(spark, unfinished)
    out = system.create(where)
    copy = spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    try:
        for piece in pieces:
            if isinstance(piece, str):
                out.write(bytearray(piece.encode()))
                continue
            file, skip = piece
            source, own = _at(spark, file)
            stream = own.open(source)
            try:
                stream.seek(skip)
                copy(stream, out, _BUFFER, False)
            finally:
                stream.close()
    finally:
        out.close()
    move_over(spark, unfinished, target)


# --- snapshots ---------------------------------------------------------------------------------


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, directory) of the snapshots of a table, oldest first."""
    names = [n.split("-", 1) for n, _ in list_names(spark, f"{path}/{POINTERS}") if not n.startswith(".")]
    return sorted((int(number), directory) for number, directory in names)


def current(spark: SparkSession, path: str) -> str:
    """Where the newest whole snapshot of a table lies; a table without snapshots lies at its path."""
    found = _pointers(spark, path)
    return f"{path}/{found[-1][1]}" if found else path


def write_snapshot(df: DataFrame, path: str, form: str = "parquet", keep: int = 2) -> str:
    """Replace the table at ``path`` as a whole; returns where the new rows lie.

    Rows are written to a directory of their own. Once Spark has committed it, an empty file that
    names it is created, in one step: from then on ``current`` leads there. A run that dies before
    leaves what was; readers that have resolved the table before go on with the old directory,
    which stays until ``keep`` newer ones exist. Two writers at a time give two snapshots.
    """
    data = f"rows-{uuid.uuid4().hex}"
    write_table(df, f"{path}/{data}", form, mode="errorifexists")
    publish(df.sparkSession, path, data, keep)
    return f"{path}/{data}"


def publish(spark: SparkSession, path: str, data: str, keep: int = 2) -> None:
    """Make the written directory ``data`` below ``path`` the current one."""
    known = _pointers(spark, path)
    number = known[-1][0] + 1 if known else 1
    where, system = _at(spark, f"{path}/{POINTERS}/{number:012d}-{data}")
    system.createNewFile(where)
    for old, directory in known[: max(0, len(known) + 1 - keep)]:
        delete(spark, f"{path}/{POINTERS}/{old:012d}-{directory}")
        delete(spark, f"{path}/{directory}")
