"""Centroid clustering in whole numbers, with geometrically tightened bounds.

Every vector carries an upper bound of the distance to its centroid and a lower bound of that to any
other. When centroids have moved, the upper bound grows by the own centroid's drift. The lower bound
need not shrink by a full drift: all vectors of cluster ``i`` lie in a sphere around its old centroid,
and for another centroid that moved from ``p`` to ``q`` only the plane through the sphere's middle, p
and q counts. The vectors that came nearer by ``g`` lie inside a branch of a hyperbola with foci p
and q, thus within a cone from the middle of pq around its axis, whose half-angle has the cosine ``g /
|pq|``. The sphere is seen from there under an angle of ``asin(r / distance)``; so no vector of it came
nearer by more than ``|pq| cos(angle of the sphere's middle - that angle)``, nothing at all if the
sphere lies beyond the right angle (after Rysavy and Hamerly, 2016).

Vectors whose bounds do not meet stay where they are. For the others the own distance is computed,
and if that does not decide either, all centroids are scanned. Distances are whole numbers and exact;
bounds are widened by more than their rounding, so results are those of a full scan in each round.

Plan: state (vector, cluster, bounds) is a written table per round, the last two are kept. Sums,
counts and radii are added up per batch and cluster in tasks, so a cluster that holds most vectors
costs no more than others. The driver holds the centroids alone.

Defined results: vectors that are null, of another length, or hold null or non-finite components take
no part, nor do vectors with a component beyond LARGEST in size, whose distances a long could not
hold. Rows that share an id are vectors of their own. Rows without an id become starting centroids
last. With fewer vectors than clusters each is a centroid; an empty table gives no rows. Further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.llm.common import exact, ship
from tapewright.session import scratch_path

#: Whole components are below this in size: 64 squares of differences fit into a long.
LARGEST = 1 << 27
#: What bounds are widened by, relative to the largest distance in sight.
SLACK = 1e-9
#: Vectors handled at a time.
ROWS = 4_096


def whole_vectors(df: DataFrame, length: int, scale: int, vector: str, vec_id: str) -> DataFrame:
    """vec_id, v (floor(scale * x), in double precision) of the rows that take part."""
    rows = exact(df, vec_id, vector).toDF("vec_id", "x").withColumn("x", F.col("x").cast("array<double>"))
    limit = LARGEST / scale
    fine = F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
    rows = rows.where((F.size("x") == length) & fine)
    return rows.select(F.col("vec_id").cast("long"), F.transform("x", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def drift_bounds(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i, j]: what distances from vectors of cluster i to centroid j can have shrunk by, at most.

    ``radius``: of a sphere around the old centroid i that holds the cluster's vectors.
    """
    drift = np.linalg.norm(after - before, axis=1)
    out = np.tile(drift, (len(before), 1))
    middle = (before + after) / 2
    for j in np.flatnonzero(drift):
        axis = (after[j] - before[j]) / drift[j]
        away = before - middle[j]
        far = np.linalg.norm(away, axis=1)
        seen = far > radius * (1 + SLACK)
        angle = np.arccos(np.clip(away[seen] @ axis / far[seen], -1, 1))
        angle -= np.arcsin(np.clip(radius[seen] / far[seen], 0, 1))
        out[seen, j] *= np.where(angle <= 0, 1.0, np.maximum(np.cos(np.maximum(angle, 0)), 0.0))
    np.fill_diagonal(out, 0.0)
    return out


@dataclass
class Step:
    """What a round needs to know: the centroids, and how far bounds have to give way."""

    centroids: np.ndarray  # whole numbers
    own: np.ndarray | None = None  # drift of each centroid
    other: np.ndarray | None = None  # most that a distance to another centroid has shrunk by, per cluster

    @staticmethod
    def after(before: np.ndarray, centroids: np.ndarray, radius: np.ndarray) -> "Step":
        old, new = before.astype(float), centroids.astype(float)
        return Step(centroids, np.linalg.norm(new - old, axis=1), drift_bounds(old, new, radius).max(axis=1, initial=0.0))


def squares(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by centroids."""
    largest = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0))
    if largest**2 * 4 * v.shape[1] < 1 << 53:  # doubles are exact
        a, b = v.astype(float), centroids.astype(float)
        return ((a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(v), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        out[:, j] = ((v - c) ** 2).sum(axis=1)
    return out


def own_squares(v: np.ndarray, centroids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((v - centroids[at]) ** 2).sum(axis=1)


def assign(step: Step, v: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray):
    """Cluster, upper bound, lower bound of each vector, and whether it was scanned."""
    n, k = len(v), len(step.centroids)
    if step.own is None:
        open_ = np.arange(n)
        at, upper, lower = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    else:
        at = at.copy()
        upper = (upper + step.own[at]) * (1 + SLACK)
        lower = np.maximum(lower - step.other[at] * (1 + SLACK), 0.0) * (1 - SLACK)
        open_ = np.flatnonzero(upper >= lower)
        upper[open_] = np.sqrt(own_squares(v[open_], step.centroids, at[open_]))
        open_ = open_[upper[open_] * (1 + SLACK) >= lower[open_]]
    scanned = np.zeros(n, bool)
    scanned[open_] = True
    if len(open_):
        d = squares(v[open_], step.centroids)
        best = d.argmin(axis=1)  # the smallest number among equals
        at[open_] = best
        upper[open_] = np.sqrt(d[np.arange(len(open_)), best])
        d[np.arange(len(open_)), best] = np.iinfo(np.int64).max
        lower[open_] = np.sqrt(d.min(axis=1)) if k > 1 else np.inf
    return at, upper, lower, scanned


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("v").flatten()).reshape(batch.num_rows, -1).astype(np.int64)


_STATE = "vec_id long, v array<int>, cluster int, upper double, lower double, scanned boolean"


def _round(state: DataFrame, step: Step) -> DataFrame:
    sent = state.sparkSession.sparkContext.broadcast(step)  # the centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                old = [np.asarray(batch.column(c)) for c in ("cluster", "upper", "lower")]
                found = assign(sent.value, _vectors(batch), *old)
                kinds = (pa.int32(), pa.float64(), pa.float64(), pa.bool_())
                arrays = [pa.array(f, kind) for f, kind in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), *arrays],
                    names=["vec_id", "v", "cluster", "upper", "lower", "scanned"],
                )

    return state.mapInArrow(run, _STATE)


def cluster_sums(state: DataFrame, length: int) -> DataFrame:
    """cluster, n, radius, s0 ... of each cluster that has vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, v = np.asarray(batch.column("cluster")), _vectors(batch)
            order = np.argsort(at, kind="stable")
            names, first, counts = np.unique(at[order], return_index=True, return_counts=True)
            if not len(names):
                continue
            sums = np.add.reduceat(v[order], first, axis=0)
            far = np.maximum.reduceat(np.asarray(batch.column("upper"))[order], first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(counts, pa.int64()), pa.array(far), *map(pa.array, sums.T.copy())],
                names=["cluster", "n", "radius", *(f"s{i}" for i in range(length))],
            )

    parts = ", ".join(f"s{i} long" for i in range(length))
    some = state.select("v", "cluster", "upper").mapInArrow(run, f"cluster int, n long, radius double, {parts}")
    return some.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(length))
    )


def moved(state: DataFrame, centroids: np.ndarray) -> Step:
    """The next round's step from a written ``state``: centroids move to the floor of their means."""
    new, radius = centroids.copy(), np.zeros(len(centroids))
    for row in cluster_sums(state, centroids.shape[1]).collect():  # a row per cluster
        new[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(centroids.shape[1])]
        radius[row["cluster"]] = row["radius"]
    return Step.after(centroids, new, radius * (1 + SLACK))


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


class _Tables:
    """Written tables of which only the newest two stay."""

    def __init__(self, spark, label: str):
        self.spark, self.label, self.paths = spark, label, []

    def write(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, self.label))
        df.write.parquet(self.paths[-1])
        for path in self.paths[:-2]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        del self.paths[:-2]
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])


def clusters(
    vectors: DataFrame, k: int = 40, rounds: int = 5, length: int = 64, scale: int = 256, seed: int = 2,
    vector: str = "embedding", vec_id: str = "vec_id",
) -> tuple[DataFrame, np.ndarray]:
    """The state after ``rounds`` moves and one more assignment (vec_id, v, cluster, ...), and the centroids.

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``.
    """
    spark = vectors.sparkSession
    tables = _Tables(spark, "kmeans")
    nothing = (F.lit(0).cast("int").alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    kept = whole_vectors(vectors, length, scale, vector, vec_id)
    state = tables.write(kept.select("vec_id", "v", *nothing, F.lit(False).alias("scanned")))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = state.select("v", draw.alias("draw")).orderBy(F.asc_nulls_last("draw"), "v").limit(k)
    centroids = np.array([r["v"] for r in first.collect()], np.int64).reshape(-1, length)
    if not len(centroids):
        return state, centroids
    state, step = tables.write(_round(state, Step(centroids))), Step(centroids)
    for _ in range(rounds):
        step = moved(state, step.centroids)
        state = tables.write(_round(state, step))
    return state, step.centroids


def clustered(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    state, centroids = clusters(vectors, **options)
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column("cluster"))
            far = own_squares(_vectors(batch), sent.value, at) if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"), pa.array(far, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    near = state.select("vec_id", "v", "cluster").mapInArrow(run, "vec_id long, cluster int, distance long")
    total = {r["cluster"]: r["d"] for r in near.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    every = sum(total.values())
    rows = [(c, d, every, centroid_sha256(centroids[c])) for c, d in total.items()]
    # A row per cluster.
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return near.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


ship(__name__)
