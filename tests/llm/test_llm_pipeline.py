"""The pipeline's stages and its run on a small table, against plain versions."""

import re

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tapewright.llm import skipcrf  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
EN = "the house and the garden were quiet when the old man came back from the market with bread and some apples number"
DE = "das haus und der garten waren still als der alte mann mit brot und einigen apfeln vom markt nach hause kam nummer"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def varied(text, i):
    words = text.split()
    return " ".join(words[(i * 7 + k * (i % 5 + 1)) % len(words)] + ("" if k % 3 else f" w{i}x{k}") for k in range(40))


def table_rows():
    rows = [(i, varied(EN if i % 2 else DE, i), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, rows[3][1], "en"), (101, rows[3][1] + " end", None), (102, rows[4][1], "de")]  # copies
    item = " ".join(f"question{k}" for k in range(12))
    rows += [(110, f"{varied(EN, 300)} {item} {varied(EN, 301)}", "en"), (111, f"{varied(EN, 302)} {' '.join(item.split()[:6])}", "en")]
    rows += [(120, f"{varied(EN, 303)} mail jo.e@mail.example.com or 10.1.2.3", "en"), (121, f"{varied(DE, 304)} card 4111 1111 1111 1111", "de")]
    rows += [(130, None, "en"), (131, "", None), (132, " 12 34 ", "en"), (133, "x", None)]
    rows += [rows[7], (None, varied(EN, 305), "en")]
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], item


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    rows, item = table_rows()
    root = tmp_path_factory.mktemp("tables")
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.withColumn("label", F.lit(1)).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return rows, item, str(root)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda i: (i is not None, i or 0))


def shingles(text, n=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_language_keeps_what_is_written_in_a_learnt_one(spark, given):
    rows, _, root = given
    kept = STAGES["language"](spark, spark.read.parquet(f"{root}/documents.parquet"), root)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    found = {(r["doc_id"], r["lang"]) for r in kept.collect()}
    assert not {i for i, _ in found} & {130, 131, 132}
    assert {(i, lang) for i, t, lang, *_ in rows if i is not None and i < 130 and lang} <= found
    assert (101, "en") in found  # a missing language is filled in


def test_near_copies_leave_the_smallest_id(spark, given):
    rows, _, root = given
    docs = spark.read.parquet(f"{root}/documents.parquet")
    gone = set()
    for i, t, *_ in rows:
        for j, u, *_ in rows:
            if i is not None and j is not None and j < i and t and u:
                a, b = shingles(t.lower()), shingles(u.lower())
                if a and 100 * len(a & b) >= 80 * len(a | b):
                    gone.add(i)
    assert gone == {100, 101, 102}
    want = sorted((r[0] for r in rows if r[0] not in gone), key=lambda i: (i is not None, i or 0))
    kept = STAGES["near_copies"](spark, docs, root)
    assert ids(kept) == want and kept.columns == list(corpus_pipeline.COLUMNS)


def test_contaminated_documents_go_and_data_is_masked(spark, given):
    rows, _, root = given
    docs = spark.read.parquet(f"{root}/documents.parquet")
    clean = STAGES["decontamination"](spark, docs, root)
    assert set(ids(docs)) - set(ids(clean)) == {110} and clean.count() == len(rows) - 1
    masked = {r["doc_id"]: r for r in STAGES["personal_data"](spark, docs, root).collect()}
    for i, text, *_ in rows:
        if i is not None:
            shown = masked[i]["text"]
            assert (shown is None) == (text is None)
            assert not skipcrf.base_spans(shown or "")
            if not skipcrf.base_spans(text or ""):
                assert shown == text
    assert "<email>" in masked[120]["text"] and "<ip>" in masked[120]["text"] and "<card>" in masked[121]["text"]
    assert masked[120]["n_chars"] == len(masked[120]["text"])


def test_run_applies_the_stages_one_after_the_other(spark, given):
    rows, _, root = given
    out = corpus_pipeline.run(spark, root).collect()
    kept = {r["doc_id"] for r in out}
    assert not kept & {100, 101, 102, 110, 130, 131, 132}
    assert {i for i, *_ in rows if i is not None and i < 60} | {111, 120, 121} <= kept
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_empty_tables(spark, given):
    _, _, root = given
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, root).count() == 0, name
