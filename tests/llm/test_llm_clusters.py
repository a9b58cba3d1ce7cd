"""Centroid clustering against full scans in plain numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tapewright.llm import kmeans  # noqa: E402


def brute(rows, k=40, rounds=5, length=64):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == length and all(x is not None and math.isfinite(x) and abs(x) < kmeans.LARGEST / 256 for x in v)
    ]
    draw = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=draw)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        at = [nearest(v) for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, at) if a == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, nearest(v), v) for i, v in kept]
    inertia = {}
    for _, c, v in found:
        inertia[c] = inertia.get(c, 0) + far(v, centroids[c])
    name = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return sorted(((i, c, far(v, centroids[c]), inertia[c], sum(inertia.values()), name(c)) for i, c, v in found), key=repr)


SCHEMA = "vec_id long, embedding array<double>"


def blobs(n, length=64, middles=12, spread=0.05, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (middles, length))
    return [(i, (centres[i % middles] + rng.normal(0, spread, length)).tolist()) for i in range(n)]


def test_clusters_equal_full_scans(spark):
    rng = np.random.default_rng(3)
    rows = blobs(150) + [(1000 + i, rng.normal(0, 0.3, 64).tolist()) for i in range(60)]
    rows += [(5000, rows[0][1])] * 30 + [(None, rows[2][1]), (0, rows[3][1])]
    rows += [(6000, None), (6001, []), (6002, [1.0]), (6003, [None] * 64), (6004, [float("nan")] * 64), (6005, [float("inf")] * 64),
             (6006, [1e30] * 64), (6007, [200_000.0] * 32 + [-200_000.0] * 32), (6008, [0.0] * 64)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(map(tuple, kmeans.clustered(frame).collect()), key=repr) == brute(rows)
    few = frame.where("vec_id between 3 and 9")
    assert sorted(map(tuple, kmeans.clustered(few).collect()), key=repr) == brute([r for r in rows if r[0] and 3 <= r[0] <= 9])
    one = kmeans.clustered(frame, k=1)
    assert sorted(map(tuple, one.collect()), key=repr) == brute(rows, k=1)


def test_odd_tables(spark):
    frame = spark.createDataFrame(blobs(50), SCHEMA)
    assert kmeans.clustered(frame.where("false")).count() == 0
    clash = frame.select("*", F.lit(1).alias("VEC_ID"), F.lit(2).alias("v"), F.lit(3).alias("cluster"), F.lit(4).alias("a.b"))
    assert sorted(map(tuple, kmeans.clustered(clash).collect()), key=repr) == brute(blobs(50))
    floats = frame.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    want = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in floats.collect()]
    assert sorted(map(tuple, kmeans.clustered(floats).collect()), key=repr) == brute(want)


def test_drift_bounds_hold_and_are_tighter_than_drift():
    rng = np.random.default_rng(5)
    tighter = 0.0
    for _ in range(200):
        dim, k = int(rng.integers(2, 8)), 5
        before = rng.normal(0, 3, (k, dim))
        after = before + rng.normal(0, rng.choice([0.01, 0.5, 3]), (k, dim))
        after[0] = before[0]
        radius = rng.uniform(0, 2, k)
        bound = kmeans.drift_bounds(before, after, radius)
        drift = np.linalg.norm(after - before, axis=1)
        for i in range(k):
            way = rng.normal(0, 1, (300, dim))
            x = before[i] + radius[i] * way / np.linalg.norm(way, axis=1, keepdims=True) * rng.uniform(0, 1, (300, 1)) ** 0.2
            nearer = np.linalg.norm(x[:, None] - before[None], axis=2) - np.linalg.norm(x[:, None] - after[None], axis=2)
            nearer[:, i] = 0
            assert (nearer.max(axis=0) <= bound[i] + 1e-9).all()
            assert (bound[i] <= drift + 1e-12).all()
        tighter += (bound.sum() / (drift.sum() * (k - 1))) / 200
    assert tighter < 0.75


def test_bounds_spare_most_scans_of_clustered_vectors(spark):
    frame = spark.createDataFrame(blobs(1200, middles=40, spread=0.2), SCHEMA)
    state, _ = kmeans.clusters(frame)
    assert state.where("scanned").count() < 0.2 * 1200


def test_distances_are_exact_beyond_doubles():
    v = np.array([[kmeans.LARGEST - 1] * 64, [1 - kmeans.LARGEST] * 64, [3] * 64], np.int64)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in v] for x in v]
    assert kmeans.squares(v, v).tolist() == want
