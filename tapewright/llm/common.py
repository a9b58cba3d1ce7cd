"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright import session

__all__ = ["anti_join", "column", "exact", "forget", "in_batches", "letters", "materialize", "release", "ship", "sub_batches", "table", "utf8", "worker"]


def ship(module: str) -> None:
    """Send a module's functions to Python workers by value, installed there or not."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker(key, make):
    """What ``make()`` gives, kept for as long as this Python worker lives."""
    kept = sys.modules.setdefault("tapewright_worker", types.ModuleType("tapewright_worker"))
    if key not in kept.__dict__:
        kept.__dict__[key] = make()
    return kept.__dict__[key]


def forget() -> None:
    """Let go of what ``worker`` keeps: the operators that come next in this Python worker need the memory."""
    sys.modules.get("tapewright_worker", types.ModuleType("none")).__dict__.clear()
    release()


def release() -> None:
    """Give back what Arrow has freed but still holds, which is several hundred MB after large batches."""
    pa.default_memory_pool().release_unused()


#: Whether Spark removes a written query's shuffle files at its end; else they stay until the driver collects its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """As ``session.materialize``; what the write shuffled, which nothing else reads, leaves the disk with its end."""
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLES_GO, None)
    conf.set(_SHUFFLES_GO, "true")
    try:
        return session.materialize(df, label)
    finally:
        conf.unset(_SHUFFLES_GO) if before is None else conf.set(_SHUFFLES_GO, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever else the table holds (dots, clashing case)."""
    return F.col(f"`{name}`")


def exact(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, by position: others may differ by case only, or repeat."""
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{at[n]}").alias(n) for n in names])


def in_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a function to Arrow batches where they lie; every batch is handled on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out
                del batch, out
                release()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def utf8(batch: pa.RecordBatch, name: str = "text"):
    """All UTF-8 bytes of a text column and the offsets of its rows, without a copy per row."""
    values = batch.column(name)
    if values.null_count:
        values = values.fill_null("")
    values = values.cast(pa.large_binary())
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + n + 1]
    data = values.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def sub_batches(batch: pa.RecordBatch, limit: int = 1 << 22, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text, or one longer text."""
    _, offsets = utf8(batch, name)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


#: Ids that are broadcast at most; beyond it tables are shuffled by id.
ID_ROWS = 400_000


def anti_join(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` without those whose ``key`` is among ``ids`` (counted once written)."""
    written = materialize(ids.select(key), "ids")
    return rows.join(F.broadcast(written) if written.count() <= ID_ROWS else written, key, "left_anti")


def letters(text: Column) -> Column:
    """Whether a text holds any letter."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


ship(__name__)
