"""Isolation trees over small arrays, for use inside tasks."""

from __future__ import annotations

import math

import numpy as np


def tree_depth(rows: int) -> int:
    """Depth at which trees over ``rows`` points are cut off."""
    return max(1, math.ceil(math.log2(max(rows, 2))))


def average_path(rows) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree over ``rows`` points."""
    rows = np.asarray(rows, dtype=np.float64)
    many = np.maximum(rows, 3.0)
    long_run = 2.0 * (np.log(many - 1.0) + np.euler_gamma) - 2.0 * (many - 1.0) / many
    return np.where(rows > 2, long_run, np.where(rows == 2, 1.0, 0.0))


def fit_tree(points: np.ndarray, depth: int, rng: np.random.Generator):
    """One tree as a full binary layout: split feature and threshold per inner node, path length
    per leaf slot. All nodes of a level are split at once. Where a node cannot be split, its
    infinite threshold sends everything left, down to a single leaf slot.
    """
    inner = 2**depth - 1
    feature = np.zeros(inner, dtype=np.int32)
    threshold = np.full(inner, np.inf, dtype=np.float32)
    path = np.zeros(inner + 1, dtype=np.float32)
    rows = np.arange(len(points))
    node = np.zeros(len(points), dtype=np.int64)
    ended = np.full(len(points), depth)
    for level in range(depth):
        order = np.argsort(node, kind="stable")
        present, starts, which = np.unique(node[order], return_index=True, return_inverse=True)
        mine = np.empty_like(which)
        mine[order] = which
        low = np.minimum.reduceat(points[order], starts, axis=0)
        high = np.maximum.reduceat(points[order], starts, axis=0)
        usable = high > low
        splits = usable.any(axis=1)
        column = np.where(usable, rng.random(usable.shape), -1.0).argmax(axis=1)
        at = np.arange(len(present)), column
        cut = (low[at] + rng.random(len(present)) * (high[at] - low[at])).astype(np.float32)
        # Rounding must not empty the upper side.
        cut = np.minimum(cut, np.nextafter(high[at], np.float32(-np.inf)))
        feature[present[splits]], threshold[present[splits]] = column[splits], cut[splits]
        ended = np.where(splits[mine], ended, np.minimum(ended, level))
        upper = splits[mine] & (points[rows, column[mine]] > cut[mine])
        node = 2 * node + 1 + upper
    slot = node - inner
    size = np.bincount(slot, minlength=inner + 1)
    path[slot] = ended + average_path(size)[slot]
    return feature, threshold, path


def mean_paths(points: np.ndarray, feature, threshold, path, block: int = 128) -> np.ndarray:
    """Mean path length of each point over all trees; arrays are (trees, nodes).

    The nodes of a level stand tree by tree, so a node's children are twice its place and the next
    one. Places are of the width that ``take`` wants, and buffers are used again.
    """
    trees, inner = feature.shape
    depth = (inner + 1).bit_length() - 1
    levels = [slice(2**d - 1, 2 ** (d + 1) - 1) for d in range(depth)]
    features = [feature[:, of].astype(np.intp).ravel() for of in levels]
    thresholds = [np.ascontiguousarray(threshold[:, of]).ravel() for of in levels]
    path = path.ravel()
    points = np.ascontiguousarray(points)
    size = block, trees
    place, at = np.empty(size, np.intp), np.empty(size, np.intp)
    x, cut, upper = np.empty(size, points.dtype), np.empty(size, threshold.dtype), np.empty(size, bool)
    leaf = np.empty(size, path.dtype)
    means = np.empty(len(points))
    for start in range(0, len(points), block):
        part = points[start : start + block]
        n = len(part)
        row_base = (np.arange(n) * part.shape[1])[:, None]
        values = part.ravel()
        node = place[:n]
        node[:] = np.arange(trees)
        # All places exist; "clip" spares a check and a copy.
        for of, below in zip(features, thresholds, strict=True):
            of.take(node, out=at[:n], mode="clip")
            at[:n] += row_base
            values.take(at[:n], out=x[:n], mode="clip")
            below.take(node, out=cut[:n], mode="clip")
            np.greater(x[:n], cut[:n], out=upper[:n])
            node += node
            node += upper[:n]
        path.take(node, out=leaf[:n], mode="clip")
        means[start : start + n] = leaf[:n].mean(axis=1, dtype=np.float64)
    return means


def stacked(trees) -> dict:
    """One symbol's trees, given as a table, as arrays over (tree, node)."""
    ordered = trees.sort_values("tree")
    kinds = {"feature": np.int32, "threshold": np.float32, "path": np.float32}
    forest = {name: np.stack(ordered[name].to_list()).astype(k) for name, k in kinds.items()}
    forest["unit"] = max(float(average_path(ordered["rows"].iloc[0])), 1e-12)
    return forest


def anomaly(points: np.ndarray, forest: dict) -> np.ndarray:
    """Anomaly measure in (0, 1]: 2 to the minus relative mean path."""
    arrays = (forest[name] for name in ("feature", "threshold", "path"))
    return np.exp2(-mean_paths(points.astype(np.float32), *arrays) / forest["unit"])
