"""A Merkle manifest of a table, as append logs whose nodes are addressed in closed form.

Every row is a leaf; the leaves of a group, in ascending order of the key, make one binary tree, and
the roots of the groups make one more. A run of two nodes becomes their hash; a last single node is
hashed alone, so all leaves of a tree lie equally deep.

Log: a tree's nodes are written in the order in which they are completed when leaves are appended:
a parent right behind its last child (postorder), the right edge at the end. Before leaf ``m`` there
are ``2 m - popcount(m)`` nodes, and the subtree over ``s`` leaves of which the highest node has level
``k`` takes ``sum(ceil(s / 2^j), j <= k)``. So the place of any node follows from its level, its index
and the number of leaves alone (``position``), and siblings are read from the log without a search.

Plan: leaf hashes are made in the JVM and written; one sort by range of (group, key, leaf) gives every
leaf its rank, from the positions of partitions, so a group that holds most rows is no larger task
than others. Builders take aligned blocks of ``2^BLOCK_LEVELS`` leaves and write the log of their
subtree, which is one unbroken run of the tree's log. The roots of blocks are leaves of the next
builders, and so on: a table of 10^10 rows takes four turns. For a proof a block meets its own run of
the log and the few siblings of its way up, once for all of its leaves.

Defined results: in a leaf a null is ``-``, else the number of UTF-8 bytes, ``:`` and the value.
Null groups come first, others by their UTF-8 bytes. Null keys come first in their group; rows that
share a key are ordered by leaf; repeated rows are leaves of their own. The only leaf of a tree is
its root; without siblings the proof is empty. An empty table gives no rows. Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapewright.llm.common import exact, materialize, ship
from tapewright.operators.joins import join_lookup

#: Leaves of a builder's block, as a power of two.
BLOCK_LEVELS = 10
#: Hex digits of a hash.
_WIDE = 64


def node_hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_height(leaves: int) -> int:
    """Levels above the leaves."""
    return (leaves - 1).bit_length()


def width(leaves: int, level: int) -> int:
    """Nodes of a level."""
    return -(-leaves >> level)


def position(level: int, index: int, leaves: int) -> int:
    """Where a node stands in the log of a tree with so many leaves."""
    first = index << level
    below = min(1 << level, leaves - first)
    size = sum(-(-below >> j) for j in range(level + 1))
    return 2 * first - first.bit_count() + size - 1


def append_nodes(leaves: Iterable[str], height: int) -> list[str]:
    """The log of a subtree of ``height`` levels: nodes in the order in which they are completed."""
    log: list[str] = []
    edge: list[tuple[int, str]] = []  # completed nodes without a parent yet

    def rise() -> None:
        level, last = edge.pop()
        pair = bool(edge) and edge[-1][0] == level
        log.append(node_hash(edge.pop()[1], last) if pair else node_hash(last))
        edge.append((level + 1, log[-1]))

    for leaf in leaves:
        log.append(leaf)
        edge.append((0, leaf))
        while len(edge) > 1 and edge[-1][0] == edge[-2][0]:
            rise()
    while edge[-1][0] < height or len(edge) > 1:
        rise()
    return log


def sibling_places(rank: int, leaves: int, low: int, high: int) -> list[tuple[int, int]]:
    """(level, index) of the siblings of a leaf's way up through the levels low to high - 1."""
    places = []
    for level in range(low, high):
        other = (rank >> level) ^ 1
        if other < width(leaves, level):
            places.append((level, other))
    return places


def fold(leaf: str, rank: int, leaves: int, siblings: Sequence[str]) -> str:
    """The root that follows from a leaf and its siblings, lowest first."""
    now, at = leaf, 0
    for level in range(tree_height(leaves)):
        index = rank >> level
        if index ^ 1 >= width(leaves, level):
            now = node_hash(now)
            continue
        now = node_hash(siblings[at], now) if index & 1 else node_hash(now, siblings[at])
        at += 1
    return now


def _hashes(joined: str) -> list[str]:
    return [joined[i : i + _WIDE] for i in range(0, len(joined), _WIDE)]


# --- leaves ------------------------------------------------------------------------------------


def leaf_hash(fields: Iterable[Column]) -> Column:
    """The hash of a row's fields: nulls as ``-``, else length and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ranked_leaves(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` (written; ``tree`` and more) with their ``rank`` in their tree and its ``leaves``."""
    # The last key parts equal rows, which are interchangeable, over tasks.
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    numbered = leaves.withColumn("__tie", F.monotonically_increasing_id())
    sorted_ = numbered.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie").drop("__tie")
    # The identifier holds the number of the partition and, in the low 33 bits, that of the row.
    placed = materialize(sorted_.withColumn("at", F.monotonically_increasing_id()), "leaves-in-order")
    placed = placed.withColumn("part", F.shiftrightunsigned("at", 33))
    spans = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # A row per tree and task of the sort that holds some of it.
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "tree", "part", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy("tree")).alias("leaves"),
    )
    rank = F.col("base") + F.col("at") - F.col("first")
    return join_lookup(placed, spans, ["tree", "part"]).withColumn("rank", rank).drop("part", "at", "first", "base")


# --- logs --------------------------------------------------------------------------------------

_NODE = "tree string, leaves long, level int, index long, place long, hash string"


@dataclass(frozen=True)
class Logs:
    """The logs of all trees of a forest, as written tables.

    leaves: the ranked leaves; runs: tree, leaves, block, log (a block's run of the log); nodes: the
    blocks' roots and all above, with their place in the log; roots: tree, leaves, root.
    """

    leaves: DataFrame
    runs: DataFrame
    nodes: DataFrame
    roots: DataFrame


def _block_run(block: pa.Table) -> pa.Table:
    leaves, rank = block.column("leaves")[0].as_py(), block.column("rank").to_pylist()
    first = min(rank) >> BLOCK_LEVELS << BLOCK_LEVELS
    if sorted(rank) != list(range(first, min(first + (1 << BLOCK_LEVELS), leaves))):
        raise ValueError(f"block at leaf {first}: ranks are not gapless")
    hashes = [h for _, h in sorted(zip(rank, block.column("leaf").to_pylist(), strict=True))]
    height = min(BLOCK_LEVELS, tree_height(leaves))
    return pa.table(
        {"tree": block.column("tree").slice(0, 1), "leaves": pa.array([leaves]), "block": pa.array([first >> BLOCK_LEVELS]),
         "level": pa.array([height], pa.int32()), "place": pa.array([position(height, first >> BLOCK_LEVELS, leaves)]),
         "log": pa.array(["".join(append_nodes(hashes, height))])}
    )


def _above(units: pa.Table) -> pa.Table:
    """The nodes that a builder appends over units of one level, each with its place in the log."""
    tree, leaves, low = (units.column(c)[0].as_py() for c in ("tree", "leaves", "level"))
    own = sorted(zip(units.column("index").to_pylist(), units.column("hash").to_pylist(), strict=True))
    first, row = own[0][0] >> BLOCK_LEVELS, [h for _, h in own]
    out = []
    for level in range(low + 1, min(low + BLOCK_LEVELS, tree_height(leaves)) + 1):
        row = [node_hash(*row[i : i + 2]) for i in range(0, len(row), 2)]
        at = first << (low + BLOCK_LEVELS - level)
        out += [(tree, leaves, level, at + i, position(level, at + i, leaves), h) for i, h in enumerate(row)]
    names = ("tree", "leaves", "level", "index", "place", "hash")
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*out, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def append_logs(leaves: DataFrame, order: Sequence[str]) -> Logs:
    """Logs of the trees over ``leaves`` (written: tree, leaf, and the columns of ``order``)."""
    block = F.shiftright("rank", BLOCK_LEVELS).alias("block")
    ranked = ranked_leaves(leaves, order).withColumn("block", block)
    built = ranked.select("tree", "leaves", "rank", "leaf", "block").groupBy("tree", "block")
    runs = materialize(
        built.applyInArrow(_block_run, "tree string, leaves long, block long, level int, place long, log string"), "log-runs"
    )
    units = runs.select(
        "tree", "leaves", "level", F.col("block").alias("index"), "place", F.expr(f"right(log, {_WIDE})").alias("hash")
    )
    nodes = units = materialize(units, "log-nodes")
    tallest = tree_height(runs.agg(F.max("leaves")).first()[0] or 1)
    for level in range(BLOCK_LEVELS, tallest, BLOCK_LEVELS):
        # Trees that end on this level have one unit and no node above.
        open_ = units.where((F.col("level") == level) & (F.col("leaves") > F.lit(1 << level)))
        groups = open_.groupBy("tree", F.shiftright("index", BLOCK_LEVELS).alias("group"))
        units = materialize(groups.applyInArrow(_above, _NODE), "log-nodes")
        nodes = nodes.unionByName(units)
    # A tree's root is the last node of its log.
    roots = nodes.groupBy("tree", "leaves").agg(F.max_by("hash", "place").alias("root"))
    return Logs(ranked, runs, nodes, materialize(roots, "log-roots"))


def block_paths(logs: Logs) -> DataFrame:
    """tree, block, leaves, log, upper: the runs with the siblings above their blocks, lowest first."""

    def wanted(runs: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in runs:
            out = []
            for tree, leaves, block in zip(*(batch.column(c).to_pylist() for c in ("tree", "leaves", "block")), strict=True):
                rank = block << BLOCK_LEVELS
                for level, index in sibling_places(rank, leaves, BLOCK_LEVELS, tree_height(leaves)):
                    out.append((tree, block, level, position(level, index, leaves)))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (("tree", pa.string()), ("block", pa.int64()), ("level", pa.int32()), ("place", pa.int64()))
            yield pa.record_batch({n: pa.array(c, k) for (n, k), c in zip(kinds, columns, strict=True)})

    asked = logs.runs.select("tree", "leaves", "block").mapInArrow(wanted, "tree string, block long, level int, place long")
    found = asked.join(logs.nodes.select("tree", "place", "hash"), ["tree", "place"])
    ways = found.groupBy("tree", "block").agg(F.array_sort(F.collect_list(F.struct("level", "hash"))).alias("way"))
    upper = ways.select("tree", "block", F.array_join(F.transform("way", lambda n: n["hash"]), "").alias("upper"))
    out = logs.runs.join(upper, ["tree", "block"], "left")
    return out.select("tree", "block", "leaves", "log", F.coalesce("upper", F.lit("")).alias("upper"))


def leaf_siblings(rank: int, leaves: int, log: str, upper: str) -> str:
    """The siblings of a leaf's way to its root, lowest first, from its block's run and what is above."""
    first = rank >> BLOCK_LEVELS << BLOCK_LEVELS
    start = 2 * first - first.bit_count()
    own = []
    for level, index in sibling_places(rank, leaves, 0, min(BLOCK_LEVELS, tree_height(leaves))):
        at = _WIDE * (position(level, index, leaves) - start)
        own.append(log[at : at + _WIDE])
    return "".join(own) + upper


# --- the manifest ------------------------------------------------------------------------------

_TOP = "tree string, top_rank long, top_leaves long, top_siblings string, root string"


def _top_proofs(subroots: pa.Table, path: pa.Table) -> pa.Table:
    log, upper = path.column("log")[0].as_py(), path.column("upper")[0].as_py()
    out = []
    for name, leaf, rank, leaves in zip(*(subroots.column(c).to_pylist() for c in ("name", "leaf", "rank", "leaves")), strict=True):
        siblings = leaf_siblings(rank, leaves, log, upper)
        out.append((name, rank, leaves, siblings, fold(leaf, rank, leaves, _hashes(siblings))))
    names = ("tree", "top_rank", "top_leaves", "top_siblings", "root")
    return pa.table(dict(zip(names, map(pa.array, zip(*out, strict=True)), strict=True)))


def manifest(
    docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
    key: str = "doc_id", changed: Sequence[Column] | None = None, keep_proof: bool = True,
) -> DataFrame:
    """key, leaf, subroot, root, proof, proof_sha256, folded_root, verified of every row of ``docs``.

    ``proof`` holds the siblings from the leaf to the root; ``folded_root`` is computed from it and
    from the row as it is to be verified: ``changed`` gives its fields (null: as they were written),
    as columns over ``fields``. ``verified`` tells whether that is the root.
    """
    rows = exact(docs, *dict.fromkeys((*fields, group, key)))
    name = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    other = F.lit(None).cast("string") if changed is None else leaf_hash(changed)
    leaf = leaf_hash(F.col(f) for f in fields)
    leaves = materialize(
        rows.select(name.alias("tree"), F.col(key).alias("key"), leaf.alias("leaf"), other.alias("seen")), "leaf-hashes"
    )
    logs = append_logs(leaves, ("key", "leaf"))
    # A row per group.
    subroots = logs.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"))
    top = append_logs(materialize(subroots, "subroots"), ("name",))
    joined = top.leaves.groupBy("tree", "block").cogroup(block_paths(top).groupBy("tree", "block"))
    tops = materialize(joined.applyInArrow(_top_proofs, _TOP), "top-proofs")
    paths = join_lookup(block_paths(logs), tops, ["tree"], written=True)

    def prove(own: pa.Table, path: pa.Table) -> pa.Table:
        found = {c: path.column(c)[0].as_py() for c in path.column_names}
        leaves, n, rank_above = found["leaves"], found["top_leaves"], found["top_rank"]
        above = _hashes(found["top_siblings"])
        proofs, folded = [], []
        for rank, leaf, seen in zip(*(own.column(c).to_pylist() for c in ("rank", "leaf", "seen")), strict=True):
            siblings = leaf_siblings(rank, leaves, found["log"], found["upper"])
            root = fold(leaf if seen is None else seen, rank, leaves, _hashes(siblings))
            proofs.append(siblings + found["top_siblings"])
            folded.append(fold(root, rank_above, n, above))
        subroot = fold(own.column("leaf")[0].as_py(), own.column("rank")[0].as_py(), leaves, _hashes(proofs[0]))
        roots = [found["root"]] * own.num_rows
        columns = {
            key: own.column("key"), "leaf": own.column("leaf"), "subroot": pa.array([subroot] * own.num_rows), "root": pa.array(roots),
            "proof": pa.array(proofs), "proof_sha256": pa.array([node_hash(p) for p in proofs]), "folded_root": pa.array(folded),
            "verified": pa.array([f == r for f, r in zip(folded, roots, strict=True)]),
        }
        if not keep_proof:
            del columns["proof"]
        return pa.table(columns)

    kind = leaves.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, leaf string, subroot string, root string, "
    schema += "proof string, " * keep_proof + "proof_sha256 string, folded_root string, verified boolean"
    own = logs.leaves.select("tree", "block", "key", "rank", "leaf", "seen").groupBy("tree", "block")
    return own.cogroup(paths.groupBy("tree", "block")).applyInArrow(prove, schema)


ship(__name__)
