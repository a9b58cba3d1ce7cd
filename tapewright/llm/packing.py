"""Best-fit packing by planning over the length histogram.

Texts become token ids with an end id; only longer ones are cut, into pieces of the full length. The
plan knows counts of lengths, not documents: lengths are taken from long to short, and all pieces of
one length go at once into the open sequences with the least room that fits them, then into new
ones (best-fit decreasing; equal sequences are one group with a count). Each piece then takes a
planned slot by joining on its rank within its length.

The plan holds at most a few rows per pair of length and room, however many documents there are, so
the driver and the broadcast stay small. Ranks are counted per (length, salt) and added up, so a
length that a third of all rows share is ranked by many tasks.

Defined results: a null or empty text is the end id alone; an empty table gives no rows; repeated
rows are packed one by one; ids may be null. Pieces of full length have a sequence of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.common import column, in_batches, materialize, ship, texts_of
from tapewright.llm.tokens import encoder
from tapewright.operators.joins import join_lookup

#: Pieces that one task ranks in one go.
CELL_ROWS = 100_000


@dataclass
class Slots:
    """Pieces of ``length`` with rank ``first`` to ``last`` - 1 fill sequences from ``sequence`` on,
    ``each`` to a sequence, from ``offset`` on."""

    length: int
    first: int
    last: int
    sequence: int
    each: int
    offset: int


def plan_slots(counts: dict[int, int], capacity: int) -> tuple[list[Slots], int]:
    """Best-fit decreasing over counts of lengths; the plan and the number of sequences."""
    slots: list[Slots] = []
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, how many)
    made = 0

    def put_back(room: int, first: int, many: int) -> None:
        if room and many:
            if not open_[room]:
                insort(rooms, room)
            open_[room].append((first, many))

    for length in sorted((n for n in counts if n), reverse=True):
        left, rank = counts[length], 0

        def fill(room: int, first: int, many: int) -> None:
            nonlocal left, rank
            each = room // length
            whole = min(many, left // each)
            if whole:
                slots.append(Slots(length, rank, rank + whole * each, first, each, capacity - room))
                rank, left = rank + whole * each, left - whole * each
                put_back(room - each * length, first, whole)
            if left and whole < many:
                slots.append(Slots(length, rank, rank + left, first + whole, left, capacity - room))
                put_back(room - left * length, first + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            put_back(room, first + whole, many - whole)

        while left and (at := bisect_left(rooms, length)) < len(rooms):
            room = rooms[at]
            first, many = open_[room].pop()
            if not open_[room]:
                rooms.pop(at)
            fill(room, first, many)
        if left:
            many = -(-left // (capacity // length))
            first, made = made, made + many
            fill(capacity, first, many)
    return slots, made


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, keep_ids: bool = True,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and (``keep_ids``) ids of every whole text."""
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        import zlib

        end = np.array([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        at, piece, start, length, check, ids = [], [], [], [], [], []
        for i, encoded in enumerate(encoder(tokenizer_path).encode(texts_of(batch))):
            encoded += end
            for k, lo in enumerate(range(0, len(encoded), step)):
                part = encoded[lo : lo + step] if len(encoded) > step else encoded
                at.append(i)
                piece.append(k)
                start.append(lo // 4)
                length.append(len(part) // 4)
                check.append(zlib.crc32(part))
                if keep_ids:
                    ids.append(np.frombuffer(part, "<i4"))
        columns = {
            "doc_id": batch.column("doc_id").take(pa.array(at)), "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(check, pa.int64()),
        }
        if keep_ids:
            columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
        return pa.record_batch(columns)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return in_batches(rows, cut, schema + (", ids array<int>" if keep_ids else ""))


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """Give each row of a written table with a ``length`` its sequence_id and offset.

    ``cut`` is read more than once and has to give the same rows each time, so it must be written.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots, _ = plan_slots(counts, capacity)
    salts = max(1, -(-max(counts.values(), default=0) // CELL_ROWS))
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    cells = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    order = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("__row", F.row_number().over(order) - 1)
    ranked = join_lookup(ranked, cells, ["length", "__salt"])
    key = lambda length, rank: (np.asarray(length, np.int64) << 40) + np.asarray(rank, np.int64)
    slots.sort(key=lambda s: (s.length, s.first))
    plan = spark.sparkContext.broadcast(
        (key([s.length for s in slots], [s.first for s in slots]),
         np.array([[s.first, s.sequence, s.each, s.offset] for s in slots], np.int64).reshape(-1, 4))
    )
    names = [c for c in cut.columns]

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, values = plan.value
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("__rank").to_numpy(zero_copy_only=False)
        wanted = (length.astype(np.int64) << 40) + rank
        first, sequence, each, offset = values[np.searchsorted(keys, wanted, side="right") - 1].T
        nth = rank - first
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(sequence + nth // each), pa.array(offset + nth % each * length)],
            names=[*names, "sequence_id", "offset"],
        )

    ranked = ranked.select(*names, (F.col("__base") + F.col("__row")).alias("__rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return in_batches(ranked, place, f"{schema}, sequence_id long, offset long")


def best_fit(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4_096, keep_ids: bool = True
) -> DataFrame:
    """Pieces of all ``docs`` with their sequence_id and offset."""
    return pack(materialize(pieces(docs, tokenizer_path, end_id, capacity, keep_ids), "pieces"), capacity)


ship(__name__)
