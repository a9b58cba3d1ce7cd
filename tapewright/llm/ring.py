"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has CELLS equal cells. Each shard owns ``virtual_nodes`` points on it; a document hashes to
a cell and prefers the shards in the order in which their points follow clockwise. A shard takes as
many rows as its bound and no more; what overflows goes on to the next shard clockwise. The bounds
differ by at most one and add up to all rows, so counts do too (law ``rows``).

Plan: only the count of each cell is needed. In round r each cell offers what it has left to its
r-th shard, and a shard takes offers in ring order, the first rows of the last one only. Rows then
take their place by their rank within the cell. The cells are a fixed number, so plan and broadcast
are bounded; each cell holds about an equal share of the rows, whatever the texts, as ids alone are
hashed (rows that share one id share a cell).

Defined results: a null text has size 1 and the checksum of the empty text; null ids are a key like
any other; repeated rows get slots of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.common import column

CELLS = 1 << 16


def ring_cell(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string"), F.lit("ring")), F.lit(CELLS)).cast("int")


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise. Points of a shard do not depend on others."""

    def cell(shard: int, node: int) -> int:
        digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "little") % CELLS

    return sorted((cell(s, v), s) for s in range(shards) for v in range(virtual_nodes))


def preferences(shards: int, virtual_nodes: int) -> np.ndarray:
    """For each cell all shards in clockwise order of their next point."""
    out = np.empty((CELLS, shards), np.int16)
    points = ring_points(shards, virtual_nodes)
    order: list[int] = []
    for _, s in points:  # the order seen from beyond the last point, going round
        if s not in order:
            order.append(s)
    hi = CELLS
    for cell, s in reversed(points):
        out[cell + 1 : hi] = order
        order.remove(s)
        order.insert(0, s)
        hi = cell + 1
    out[:hi] = order
    return out


def bounds(rows: int, shards: int) -> np.ndarray:
    """What each shard may hold: counts that differ by one at most and add up to all rows."""
    return rows // shards + (np.arange(shards) < rows % shards)


def place_cells(counts: np.ndarray, shards: int, virtual_nodes: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, last rank + 1, shard, first slot) for all cells with rows."""
    wish = preferences(shards, virtual_nodes)
    room = bounds(int(counts.sum()), shards).astype(np.int64)
    left, done = counts.astype(np.int64).copy(), np.zeros(CELLS, np.int64)
    used = np.zeros(shards, np.int64)
    out = []
    for r in range(shards):
        for shard in range(shards):
            cells = np.flatnonzero((wish[:, r] == shard) & (left > 0))
            if not len(cells) or not room[shard]:
                continue
            offered = left[cells]
            before = np.cumsum(offered) - offered
            taken = np.clip(room[shard] - before, 0, offered)
            for cell, n, b in zip(cells[taken > 0], taken[taken > 0], before[taken > 0], strict=True):
                out.append((int(cell), int(done[cell]), int(done[cell] + n), shard, int(used[shard] + b)))
            done[cells] += taken
            left[cells] -= taken
            used[shard] += taken.sum()
            room[shard] -= taken.sum()
    return out


def ring_shards(
    docs: DataFrame, shards: int = 16, virtual_nodes: int = 128, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    spark = docs.sparkSession
    body = F.coalesce(column(docs, text), F.lit(""))
    cell = ring_cell(column(docs, doc_id))
    counts = np.zeros(CELLS, np.int64)
    for row in docs.select(cell.alias("cell")).groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    plan = spark.createDataFrame(
        place_cells(counts, shards, virtual_nodes), "cell int, first long, last long, shard int, base long"
    )
    rows = docs.select(
        column(docs, doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        cell.alias("cell"),
    )
    order = Window.partitionBy("cell").orderBy("doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1)
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    # At most CELLS rows and one more for each round and shard: bounded, whatever the table.
    placed = ranked.join(F.broadcast(plan), "cell").where(inside)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("base") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
