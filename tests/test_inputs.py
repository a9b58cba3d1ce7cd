"""Inputs by name, odd paths, the shared folder, and counts beyond what Spark keeps."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tapewright.operators.clean import symbol_filter
from tapewright.operators.payload import stream_payload
from tapewright.schemas import TRADE, WINDOW_AGGREGATE
from tapewright.session import shared_dir
from tapewright.sources.files import latest_input, read_csv, read_optional, read_sink
from tapewright.streaming.jobs import rows_read
from tapewright.streaming.monitor import progress_table
from tapewright.streaming.sinks import start_table_sink


def test_csv_is_matched_by_name(spark, tmp_path):
    inner = tmp_path / "a b+c" / "x=1"
    inner.mkdir(parents=True)
    (inner / "one.csv").write_text("trade_id,symbol,quantity,price,extra\n7,BTC,2.0,100.0,z\n")
    (tmp_path / "a b+c" / "two.csv").write_text("symbol,price\nETH,5.5\n")
    rows = {r["symbol"]: r for r in read_csv(spark, str(tmp_path), TRADE).collect()}
    assert (rows["BTC"]["trade_id"], rows["BTC"]["price"], rows["BTC"]["quantity"]) == (7, 100.0, 2.0)
    assert rows["ETH"]["price"] == 5.5 and rows["ETH"]["quantity"] is None
    (tmp_path / "bad.csv").write_text("what,ever\n1,2\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), TRADE)


def test_sink_is_read_recursively(spark, tmp_path):
    for day in ("d1", "d2"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "part.csv").write_text("symbol,avg_price,is_anomaly\nBTC,1.5,true\n")
    rows = read_sink(spark, str(tmp_path)).collect()
    assert [(r["symbol"], r["avg_price"], r["is_anomaly"]) for r in rows] == [("BTC", 1.5, True)] * 2
    assert set(rows[0].asDict()) == set(WINDOW_AGGREGATE.names)


def test_newest_match_in_odd_folders(spark, tmp_path):
    folder = tmp_path / "a+b (c)" / "raw"
    folder.mkdir(parents=True)
    (folder / "t_1.jsonl").write_text("{}\n")
    assert latest_input(spark, str(folder), "t_*.jsonl") == f"{folder}/t_1.jsonl"
    assert latest_input(spark, str(folder), "none_*") is None


def test_broken_input_is_not_missing_input(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="."):
        read_optional(spark, str(tmp_path), TRADE).collect()
    assert read_optional(spark, str(tmp_path / "absent"), TRADE).count() == 0


def test_product_ids_are_symbols(spark):
    rows = spark.createDataFrame([("BTCUSD",), ("ETHUSD",)], "symbol string")
    assert [r["symbol"] for r in symbol_filter(rows, "btc-usd").collect()] == ["BTCUSD"]


def test_shared_folder():
    def session(conf, checkpoint, master):
        made = {"spark.checkpoint.dir": conf} if conf else {}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda k, d=None: made.get(k, d), set=made.__setitem__),
            sparkContext=SimpleNamespace(getCheckpointDir=lambda: checkpoint, master=master),
        )

    assert shared_dir(session("hdfs://x/y/", None, "yarn")) == "hdfs://x/y"
    assert shared_dir(session(None, "hdfs://x/z", "yarn")) == "hdfs://x/z"
    with pytest.raises(ValueError):
        shared_dir(session(None, None, "local-cluster[2,1,1024]"))
    local = session(None, None, "local[4]")
    assert shared_dir(local) == shared_dir(local)


def test_rows_of_all_batches_are_counted(spark, tmp_path):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        spark.range(50).repartition(5).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = start_table_sink(stream, str(tmp_path / "out"), str(tmp_path / "check"), available_now=True)
        query.awaitTermination()
        assert len(query.recentProgress) <= 2
        assert rows_read(query) == 50
        assert progress_table(spark, query).agg(F.sum("input_rows")).first()[0] == 50
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_document_holds_every_window(spark):
    windows = spark.range(1500).select(
        F.timestamp_seconds(F.col("id") * 60).alias("window_start"), F.timestamp_seconds(F.col("id") * 60 + 60).alias("window_end"),
        F.lit("BTC").alias("symbol"), *[F.lit(1.0).alias(f.name) for f in WINDOW_AGGREGATE if f.dataType.typeName() == "double"],
        F.lit(1).cast("long").alias("trade_count"), F.lit(False).alias("is_anomaly"), F.lit("").alias("anomaly_reason"),
    )
    forest = spark.createDataFrame([], "symbol string, trade_time timestamp, price double, trade_value double,"
                                   " ml_anomaly_score double, is_ml_anomaly boolean, ml_model string, quantity double, trade_id long")
    payload = stream_payload(windows, forest).select(F.from_json("payload", "price_series array<string>").alias("p"))
    assert payload.select(F.size("p.price_series")).first()[0] == 1500


class Counted:
    def __init__(self, data):
        self.data, self.read_bytes = data, 0

    def read(self, n):
        out = self.data[self.read_bytes : self.read_bytes + n]
        self.read_bytes += len(out)
        return out


def test_headers_are_found_in_the_head_of_a_file():
    from tapewright.sources.files import HEAD_BYTES, HEAD_PIECE, first_line

    stream = Counted(b"\xef\xbb\xbfsymbol,price\r\n" + b"x" * 10_000_000)
    assert first_line(stream) == "symbol,price" and stream.read_bytes <= HEAD_PIECE
    endless = Counted(b"y" * 10_000_000)
    assert len(first_line(endless)) <= HEAD_BYTES + HEAD_PIECE and endless.read_bytes <= HEAD_BYTES + HEAD_PIECE
    assert first_line(Counted(b"")) == "" and first_line(Counted(b"a,b")) == "a,b"


def test_layouts_come_as_one_row_each(spark, tmp_path):
    from tapewright.sources import files

    for i in range(12):
        folder = tmp_path / f"day {i % 3}" / "a+b%20c"
        folder.mkdir(parents=True, exist_ok=True)
        names = "symbol,trade_id" if i % 4 else "trade_id,symbol,other"
        values = f"S{i},{i}" if i % 4 else f"{i},S{i},x"
        (folder / f"f{i}.csv").write_text(f"{names}\n{values}\n")
    (tmp_path / "empty.csv").write_text("")
    found = files.csv_layouts(spark, str(tmp_path))
    assert {k: len(v) for k, v in found.items()} == {("symbol", "trade_id"): 9, ("trade_id", "symbol", "other"): 3}
    schema = spark.createDataFrame([], "symbol string, trade_id long").schema
    want = [(f"S{i}", i) for i in range(12)]
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path), schema).collect()), key=lambda r: r[1]) == want
    scanned = {r["header"]: r["n"] for r in files._headers_by_scan(spark, str(tmp_path)).groupBy("header").agg(F.count("*").alias("n")).collect()}
    assert scanned == {"symbol,trade_id": 9, "trade_id,symbol,other": 3}
