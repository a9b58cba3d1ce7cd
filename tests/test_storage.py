"""Documents in fragments, and tables that are replaced at once."""

import json

import pytest
from pyspark.sql import functions as F

from tapewright.operators.fragments import Part, read_fragments, write_document, write_fragments
from tapewright.sources.files import read_table
from tapewright.sources.storage import concatenate, current, list_names, move_over, write_snapshot

SCHEMA = "symbol string, n long, price double, time timestamp"


def rows(spark, n):
    ids = spark.range(n).select(
        F.concat(F.lit('S"'), F.col("id") % 7).alias("symbol"), F.col("id").alias("n"),
        F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("price"), F.timestamp_micros(F.col("id") * 1_000_003).alias("time"),
    )
    return ids.repartition(5, "n")


def test_fragments_make_the_document(spark, tmp_path):
    frame = rows(spark, 2_000)
    parts = {
        "long": Part(frame, [F.col("symbol"), -F.col("n")], "time"),
        "none": Part(frame.where("false"), [F.col("n")]),
        "one": Part(frame.where("n = 3"), [F.col("n")]),
    }
    target = f"{tmp_path}/site/document.json"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_document(spark, {"source": "ä", "n": None}, parts, f"{tmp_path}/work", target)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with open(target, encoding="utf-8") as file:
        made = json.load(file)
    want = sorted(((r["symbol"], -r["n"]) for r in frame.collect()))
    assert [(r["symbol"], -r["n"]) for r in made["long"]] == want
    assert made["summary"] == {"source": "ä", "n": None} and made["none"] == [] and len(made["one"]) == 1
    assert made["long"][0].keys() == {"symbol", "n", "price", "time"} and None in {r["price"] for r in made["long"]}
    files = [r for r in manifest.collect() if r["list"] == "long"]
    assert len(files) > 1 and [r["place"] for r in files] == list(range(len(files)))
    assert sum(r["bytes"] for r in files) < (tmp_path / "site" / "document.json").stat().st_size
    back = read_fragments(spark, f"{tmp_path}/work", "long", parts["long"].item_type())
    assert sorted(r["n"] for r in back.collect()) == list(range(2_000))
    assert [n for n, _ in list_names(spark, f"{tmp_path}/site") if not n.startswith(".")] == ["document.json"]


def test_a_document_replaces_what_was_there(spark, tmp_path):
    (tmp_path / "old.json").mkdir()
    (tmp_path / "old.json" / "part-0").write_text("x")
    concatenate(spark, f"{tmp_path}/old.json", ["a", "b"])
    assert (tmp_path / "old.json").read_text() == "ab"
    concatenate(spark, f"{tmp_path}/old.json", ["new"])
    assert (tmp_path / "old.json").read_text() == "new"
    (tmp_path / "piece").write_text("0123456789")
    concatenate(spark, f"{tmp_path}/old.json", ["<", (f"{tmp_path}/piece", 3), (f"{tmp_path}/piece", 9), ">"])
    assert (tmp_path / "old.json").read_text() == "<34567899>"
    with pytest.raises(Exception):
        concatenate(spark, f"{tmp_path}/old.json", ["half", (f"{tmp_path}/nothing", 0)])
    assert (tmp_path / "old.json").read_text() == "<34567899>"
    move_over(spark, f"{tmp_path}/piece", f"{tmp_path}/elsewhere")
    assert (tmp_path / "elsewhere").read_text() == "0123456789"


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_snapshots_replace_a_table_at_once(spark, tmp_path, form):
    path = f"{tmp_path}/latest"
    schema = spark.createDataFrame([], "symbol string, n long").schema
    frame = lambda n, name: spark.range(n).select(F.lit(name).alias("symbol"), F.col("id").alias("n"))
    assert current(spark, path) == path
    first = write_snapshot(frame(10, "a"), path, form)
    assert current(spark, path) == first
    opened = read_table(spark, path, schema)  # before the swap
    write_snapshot(frame(20, "b"), path, form)
    assert opened.count() == 10 and {r["symbol"] for r in opened.collect()} == {"a"}
    assert read_table(spark, path, schema).count() == 20

    def fails(n):
        raise RuntimeError("killed midway")

    broken = frame(20, "c").repartition(4).where(F.udf(fails, "boolean")("n"))
    with pytest.raises(Exception, match="killed midway"):
        write_snapshot(broken, path, form)
    assert {r["symbol"] for r in read_table(spark, path, schema).collect()} == {"b"}
    (tmp_path / "latest" / "rows-half").mkdir()  # what a dead writer leaves
    write_snapshot(frame(5, "d"), path, form)
    assert {r["symbol"] for r in read_table(spark, path, schema).collect()} == {"d"}
    kept = [n for n, _ in list_names(spark, path) if n.startswith("rows-")]
    assert set(kept) > {"rows-half"} and len(kept) <= 4 and first.rsplit("/", 1)[1] not in kept
    assert opened.sparkSession is spark and len(list_names(spark, f"{path}/_snapshots")) == 2


def test_a_fragment_is_sorted_by_range(spark, tmp_path):
    frame = rows(spark, 500)
    manifest = write_fragments(Part(frame, [F.col("n")]), "x", str(tmp_path)).collect()
    items = [json.loads(line[1:]) for r in manifest for line in open(f"{tmp_path}/{r['file']}")]
    assert [i["n"] for i in items] == list(range(500))
