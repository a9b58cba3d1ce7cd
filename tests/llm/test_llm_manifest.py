"""The Merkle manifest against trees built level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tapewright.llm import merkle  # noqa: E402


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves):
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([h(*rows[-1][i : i + 2]) for i in range(0, len(rows[-1]), 2)])
    return rows


@pytest.mark.parametrize("n", [*range(1, 40), 63, 64, 65, 100])
def test_log_positions_are_those_of_the_closed_form(n):
    leaves = [h(str(i)) for i in range(n)]
    rows = levels_of(leaves)
    log = merkle.append_nodes(leaves, merkle.tree_height(n))
    assert len(log) == sum(map(len, rows)) and log[-1] == rows[-1][0]
    for level, row in enumerate(rows):
        assert len(row) == merkle.width(n, level)
        for i, node in enumerate(row):
            assert log[merkle.position(level, i, n)] == node
    for r in range(n):
        siblings = [rows[k][i] for k, i in merkle.sibling_places(r, n, 0, len(rows) - 1)]
        assert merkle.fold(leaves[r], r, n, siblings) == rows[-1][0]


def brute(rows):
    """doc_id, leaf, subroot, root, proof of (doc_id, text, lang, source, n_chars), and roots of changed rows."""

    def leaf(row, more=0):
        doc_id, text, lang, source, n_chars = row
        n_chars = None if n_chars is None else n_chars + more
        shown = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
        return h(*shown)

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda k: b"" if k is None else b"1" + k.encode())
    made = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[lang] = levels_of([leaf(r) for r in trees[lang]])
    top = levels_of([made[k][-1][0] for k in order])
    out = []
    for at, lang in enumerate(order):
        for i, row in enumerate(trees[lang]):
            proof, now = [], leaf(row, int(row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0))
            for grid, place in ((made[lang], i), (top, at)):
                for level in grid[:-1]:
                    other = place ^ 1
                    pair = [now]
                    if other < len(level):
                        proof.append(level[other])
                        pair = [now, level[other]] if place % 2 == 0 else [level[other], now]
                    now, place = h(*pair), place // 2
            out.append((row[0], leaf(row), made[lang][-1][0], top[-1][0], "".join(proof), h(*proof), now, now == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def found(frame, **more):
    seen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    chars = F.when(seen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    changed = [F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text")]
    return sorted((tuple(r) for r in merkle.manifest(frame, changed=changed, **more).collect()), key=repr)


@pytest.mark.parametrize("levels", [2, 10])
def test_manifest_equals_trees_built_level_by_level(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    draw = random.Random(levels)
    rows = [
        (i, draw.choice([None, "", "text", "größer 漢字", "x" * 5000]), draw.choice(["en"] * 8 + ["de", None, "", "ß"]),
         draw.choice(["a", None]), draw.choice([None, 5, 7]))
        for i in draw.sample(range(1000), 70)
    ]
    rows += [rows[0]] * 5 + [(rows[1][0], "other", "en", None, 1), (None, "a", "en", "b", 1), (None, None, None, None, None)]
    rows += [(5000, "lone", "one", "b", 4)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    made = found(frame)
    assert made == brute(rows)
    assert {r[-1] for r in made} == {True, False}


def test_manifest_of_odd_tables(spark):
    rows = [(3, "t", "en", "s", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    (doc_id, leaf, subroot, root, proof, digest, *_), = found(frame)
    assert (doc_id, leaf, subroot, proof, digest) == (3, root, root, "", h())
    assert found(frame.where("false")) == []
    clash = frame.select("*", F.lit(1).alias("TEXT"), F.lit(2).alias("key"), F.lit(3).alias("tree"), F.lit(4).alias("doc.id"))
    assert found(clash) == found(frame)
    assert "proof" not in merkle.manifest(frame, keep_proof=False).columns


def test_a_hot_group_is_ranked_over_many_tasks(spark):
    rows = [(7, "same", "en", "s", 4)] * 300 + [(i, "t", "en", "s", 1) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    leaves = frame.select(F.lit("1en").alias("tree"), "doc_id", F.col("text").alias("leaf"))
    ranked = merkle.ranked_leaves(merkle.materialize(leaves, "t"), ("doc_id", "leaf")).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(600))
    ordered = [(r["doc_id"], r["leaf"]) for r in sorted(ranked, key=lambda r: r["rank"])]
    assert ordered == sorted(ordered)
