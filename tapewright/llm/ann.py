"""Nearest neighbours by learned partitions, for the largest inner product.

1. A sample of at most about ``sample`` vectors (drawn by a hash of the id) gives a graph of nearest
   neighbours. Largest inner product is turned into smallest angle by one more coordinate that lifts
   all vectors to the same length (it is 0 for queries and for data of one length).
2. The graph is cut into balanced parts: starting from the nearest of random seeds, nodes move to the
   part of most of their neighbours, strongest wish first, while no part exceeds its share by more
   than a tenth.
3. A small neural network learns a node's part from its vector.
4. Every row goes to its most probable part. A query goes to its ``probes`` most probable parts, and
   on until these hold enough rows. ``probes`` is the least number with which sample nodes that the
   network has not seen, asked as queries, find ``aim`` of their true nearest in the sample.
5. Queries and rows of a part meet in cells of bounded size (large parts are split by a hash of the
   id, on both sides); each cell gives each query its best, and these are ranked by exact scores.

A table of n rows has at least sqrt(n) / 8 parts, and as many that a part holds about ``rows_per_part``
rows. Their number grows with the table up to ``most_parts``, which the network's sample bears; from
there on parts grow, and the work per query with them. How many parts a query needs depends on the
vectors: without any clusters it is most of them.

Defined results: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id; equal scores rank by smaller id; rows
that share one id are rows of their own, but a query's own id is never among its neighbours. With
fewer candidates than asked for, all of them are returned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.common import column, in_batches, materialize, ship

#: Rows and queries that meet in one cell.
CELL_ROWS, CELL_QUERIES = 20_000, 2_000


def valid_vectors(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part."""
    rows = df.select(
        column(df, vec_id).cast("long").alias("vec_id"), column(df, vector).cast("array<double>").alias("vector")
    )
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (common["n"] if common else 0))


def _matrix(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    flat = batch.column(name)
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    return np.asarray(flat.flatten()).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each row among the others, by inner product of lifted vectors."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for lo in range(0, len(x), 1024):
        scores = x[lo : lo + 1024] @ x.T
        scores[np.arange(len(scores)), lo + np.arange(len(scores))] = -np.inf
        out[lo : lo + 1024] = np.argpartition(-scores, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def query_neighbours(x: np.ndarray, asked: np.ndarray, k: int) -> np.ndarray:
    """The k rows other than itself with the largest inner product, of each row in the mask ``asked``."""
    nodes = np.flatnonzero(asked)
    out = np.empty((len(nodes), min(k, len(x) - 1)), np.int64)
    for lo in range(0, len(nodes), 1024):
        part = nodes[lo : lo + 1024]
        scores = x[part] @ x.T
        scores[np.arange(len(part)), part] = -np.inf
        out[lo : lo + 1024] = np.argpartition(-scores, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """A part for each node: few edges between parts, and no part over its share times ``slack``."""
    rng = np.random.default_rng(3)
    n = len(x)
    most = int(np.ceil(n / parts * slack))
    part = _assign(x @ x[rng.choice(n, parts, replace=False)].T, most)
    one = np.repeat(np.arange(n), graph.shape[1])
    two = graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (one, part[two]), 1.0)
        np.add.at(votes, (two, part[one]), 1.0)
        votes[np.arange(n), part] += 0.5
        new = _assign(votes, most)
        if (new == part).all():
            break
        part = new
    return part


def _assign(wish: np.ndarray, most: int) -> np.ndarray:
    """Each row its best column; a full column keeps the rows that would lose most by moving."""
    wish = wish.astype(float).copy()
    n, parts = wish.shape
    out = wish.argmax(axis=1)
    while True:
        counts = np.bincount(out, minlength=parts)
        over = np.flatnonzero(counts > most)
        if not len(over):
            return out
        for p in over:
            rows = np.flatnonzero(out == p)
            own = wish[rows, p]
            rest = wish[rows].copy()
            rest[:, p] = -np.inf
            leave = rows[np.argsort(own - rest.max(axis=1), kind="stable")[: len(rows) - most]]
            wish[leave, p] = -np.inf
        out = wish.argmax(axis=1)


@dataclass
class Router:
    """A network with one hidden layer, from lifted vectors to parts."""

    length: float  # all vectors are lifted to this length
    weights: list[np.ndarray]
    probes: int = 1

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            return np.hstack([x / norm, np.zeros_like(norm)])
        return np.hstack([x, np.sqrt(np.maximum(self.length**2 - norm**2, 0.0))]) / self.length

    def scores(self, lifted: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(lifted @ a + b, 0.0) @ c + d


def train_router(x: np.ndarray, target: np.ndarray, hidden: int, steps: int = 1_000, batch: int = 256) -> list[np.ndarray]:
    """Adam on cross-entropy; ``target`` holds the shares of parts among a node and its neighbours."""
    rng = np.random.default_rng(5)
    d, m = x.shape[1], target.shape[1]
    w = [rng.normal(0, np.sqrt(2 / d), (d, hidden)) * np.sqrt(d), np.zeros(hidden),
         rng.normal(0, np.sqrt(2 / hidden), (hidden, m)), np.zeros(m)]
    w = [v.astype(x.dtype) for v in w]
    first, second = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), min(batch, len(x)))
        h = np.maximum(x[rows] @ w[0] + w[1], 0.0)
        z = h @ w[2] + w[3]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
        gh = (g @ w[2].T) * (h > 0)
        grads = [x[rows].T @ gh, gh.sum(axis=0), h.T @ g, g.sum(axis=0)]
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad**2
            rate = 3e-3 * (1 - step / (steps + 1))
            w[i] = w[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return w


def learn(x: np.ndarray, length: float, parts: int, k: int, aim: float) -> Router:
    """Graph, parts, network and number of probes from a sample."""
    router = Router(length, [])
    lifted = router.lift(x, False)
    parts = max(1, min(parts, len(x) // 2))
    if parts == 1:
        router.weights = [np.zeros((lifted.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
        return router
    graph = neighbour_graph(lifted, k)
    part = balanced_parts(lifted, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    target[np.arange(len(x)), part] += graph.shape[1]
    target /= target.sum(axis=1, keepdims=True)
    unseen = np.zeros(len(x), bool)
    unseen[np.random.default_rng(9).permutation(len(x))[: max(1, len(x) // 10)]] = True
    router.weights = train_router(lifted[~unseen].astype(np.float32), target[~unseen].astype(np.float32), 64)
    placed = router.scores(lifted).argmax(axis=1)
    order = np.argsort(-router.scores(router.lift(x[unseen], True)), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(order), 0), axis=1)
    needed = np.take_along_axis(rank, placed[query_neighbours(x, unseen, k)], axis=1).ravel()
    found = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    router.probes = int(np.searchsorted(found, aim) + 1)
    return router


def nearest(
    vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, sample: int = 10_000,
    rows_per_part: int = 5_000, most_parts: int = 256, aim: float = 0.95, vector: str = "embedding", vec_id: str = "vec_id",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row with ``is_query(vec_id)``."""
    spark = vectors.sparkSession
    rows = materialize(valid_vectors(vectors, vector, vec_id), "vectors")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    size = rows.agg(F.count("*").alias("n"), F.sqrt(F.max(squares)).alias("length")).first()
    n = size["n"]
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    draw = F.pmod(F.xxhash64("vec_id", F.lit("partition")), F.lit(1 << 30))
    drawn = rows.where(draw < min(1 << 30, max(1, sample * (1 << 30) // n))).orderBy("vec_id").toArrow()
    if drawn.num_rows < 2:
        drawn = rows.limit(2).toArrow()
    parts = min(most_parts, max(-(-n // rows_per_part), int(np.ceil(np.sqrt(n) / 8))))
    router = learn(_matrix(drawn, "vector"), size["length"], parts, k, aim)
    model = spark.sparkContext.broadcast(router)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = model.value
        part = own.scores(own.lift(_matrix(batch, "vector"), False)).argmax(axis=1)
        return pa.record_batch(
            {"vec_id": batch.column("vec_id"), "vector": batch.column("vector"), "part": pa.array(part, pa.int32())}
        )

    placed = materialize(in_batches(rows, place, "vec_id long, vector array<double>, part int"), "placed")
    held = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    parts = len(router.weights[3])
    sizes = np.array([held.get(p, 0) for p in range(parts)])
    split = np.maximum(1, -(-sizes // CELL_ROWS))

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = model.value
        order = np.argsort(-own.scores(own.lift(_matrix(batch, "vector"), True)), axis=1)
        within = np.cumsum(sizes[order], axis=1) - sizes[order]  # rows in the parts before
        take = (np.arange(parts)[None, :] < own.probes) | (within <= k)
        take &= sizes[order] > 0
        at, nth = np.nonzero(take)
        return pa.record_batch(
            {"query_id": batch.column("vec_id").take(pa.array(at)), "query": batch.column("vector").take(pa.array(at)),
             "part": pa.array(order[at, nth], pa.int32())}
        )

    asked = rows.where(is_query(F.col("vec_id")))
    routed = materialize(in_batches(asked, route, "query_id long, query array<double>, part int"), "routed")
    wanted = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    # One row per part (at most most_parts of them).
    plan = F.broadcast(
        spark.createDataFrame(
            [(p, int(split[p]), max(1, -(-wanted.get(p, 0) // CELL_QUERIES))) for p in range(parts)],
            "part int, row_cells int, query_cells int",
        )
    )
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    cell = lambda what, c: F.pmod(F.xxhash64(what), F.col(c)).cast("int")
    left = placed.join(plan, "part").select(
        "vec_id", "vector", "part", cell("vec_id", "row_cells").alias("rc"), upto("query_cells").alias("qc")
    )
    right = routed.join(plan, "part").select(
        "query_id", "query", "part", upto("row_cells").alias("rc"), cell("query_id", "query_cells").alias("qc")
    )

    def best(own: pa.Table, queries: pa.Table) -> pa.Table:
        ids, asked_ids = own.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        out: tuple[list, list, list] = ([], [], [])
        if len(ids) and len(asked_ids):
            x, q = _matrix(own, "vector"), _matrix(queries, "query")
            for lo in range(0, len(q), 256):
                scores = q[lo : lo + 256] @ x.T
                scores[asked_ids[lo : lo + 256, None] == ids[None, :]] = -np.inf
                keep = min(k, len(ids)) - 1
                bar = -np.partition(-scores, keep, axis=1)[:, keep]
                for i, row in enumerate(scores):
                    near = np.flatnonzero((row >= bar[i] - 1e-9 * (1 + abs(bar[i]))) & (row > -np.inf))
                    exact = (x[near] * q[lo + i]).sum(axis=1)
                    order = np.lexsort((ids[near], -exact))[:k]
                    out[0].append(np.full(len(order), asked_ids[lo + i]))
                    out[1].append(ids[near[order]])
                    out[2].append(exact[order])
        joined = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.table(
            {"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)),
             "score": pa.array(joined[2].astype(np.float64))}
        )

    key = ("part", "rc", "qc")
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ship(__name__)
