"""Micro-batch behaviour with files as the source."""

import json

import pytest

from helpers import START, at
from tapewright.config import DEFAULTS
from tapewright.operators.clean import clean_trades_stream
from tapewright.operators.parse import parse_trades
from tapewright.operators.windows import window_aggregates
from tapewright.sources.files import read_sink, read_stream_aggregates
from tapewright.sources.streams import line_stream, subscription
from tapewright.streaming.jobs import keyed_message_records, run_bounded, windowed_records
from tapewright.streaming.monitor import ProgressLog, progress_table
from tapewright.streaming.sinks import start_console_sink, start_table_sink

import datetime as dt

BASE_MS = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def record(symbol, trade_id, price, seconds, quantity="1"):
    return {
        "e": "trade", "s": symbol, "t": trade_id, "p": str(price), "q": quantity,
        "T": BASE_MS + int(seconds * 1000), "m": False,
    }


class Feed:
    """A directory of JSON-lines files and the job over it."""

    def __init__(self, spark, root, sink="parquet", **options):
        self.spark, self.root, self.sink, self.options = spark, root, sink, options
        (root / "in").mkdir()
        self.files = 0

    def put(self, *records):
        self.files += 1
        text = "\n".join(json.dumps(r) for r in records) + "\n\n"
        (self.root / "in" / f"part-{self.files}.json").write_text(text)

    def run(self):
        lines = line_stream(self.spark, str(self.root / "in"), max_files=1)
        rows = windowed_records(lines, DEFAULTS, **self.options)
        query = start_table_sink(
            rows, str(self.root / "out"), str(self.root / "check"), self.sink, available_now=True
        )
        query.awaitTermination()
        return query

    def rows(self):
        made = read_sink(self.spark, str(self.root / "out"))
        return sorted(
            (r["symbol"], int((r["window_start"].timestamp() - BASE_MS / 1000)), r["trade_count"])
            for r in made.collect()
        )


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_windows_appear_once_closed(feed):
    feed.put(record("A", 1, 10, 0), record("A", 2, 12, 30), {"s": None}, record("A", 3, 0, 5))
    feed.run()
    assert feed.rows() == []
    feed.put(record("A", 4, 11, 180))  # watermark at 60: the first window closes
    feed.run()
    assert feed.rows() == [("A", 0, 2)]


def test_restart_goes_on_and_late_rows_are_dropped(feed, spark):
    feed.put(record("A", 1, 10, 0), record("B", 2, 12, 70))
    feed.run()
    feed.put(record("A", 3, 10, 1000))
    feed.run()
    assert feed.rows() == [("A", 0, 1), ("B", 60, 1)]
    feed.put(record("A", 4, 10, 10), record("A", 5, 10, 2000))
    query = feed.run()
    progress = progress_table(spark, query).collect()
    assert sum(p["late_rows_dropped"] for p in progress) == 1
    assert sum(p["input_rows"] for p in progress) == 3  # the blank line is read, then skipped
    assert feed.rows() == [("A", 0, 1), ("A", 960, 1), ("B", 60, 1)]


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    feed = Feed(spark, tmp_path, sink="csv")
    given = [record("AB"[i % 2], i, 50 + i % 9, i * 7.5, "2") for i in range(120)]
    for start in range(0, 120, 40):
        feed.put(*given[start : start + 40])
    feed.run()
    lines = spark.createDataFrame([(json.dumps(g),) for g in given], "value string")
    batch = window_aggregates(clean_trades_stream(parse_trades(lines)))
    closed = batch.filter(batch.window_end <= at(119 * 7.5 - 120).replace(tzinfo=dt.timezone.utc))
    made = read_stream_aggregates(spark, str(tmp_path / "out"))
    assert made.count() > 0
    order = ["window_start", "symbol"]
    assert made.orderBy(*order).collect() == closed.orderBy(*order).collect()


def test_stray_files_in_the_output_do_not_count(feed, spark, tmp_path):
    feed.put(record("A", 1, 10, 0), record("A", 2, 12, 300))
    feed.run()
    expected = feed.rows()
    committed = next((tmp_path / "out").glob("part-*.parquet"))
    (tmp_path / "out" / "stray.parquet").write_bytes(committed.read_bytes())
    assert feed.rows() == expected == [("A", 0, 1)]


def test_repeats_can_be_dropped(spark, tmp_path):
    feed = Feed(spark, tmp_path, drop_repeats=True)
    feed.put(record("A", 1, 10, 0), record("A", 1, 10, 0), record("A", 2, 10, 1))
    feed.put(record("A", 9, 10, 600))
    feed.put(record("A", 10, 10, 700))
    feed.run()
    assert ("A", 0, 2) in feed.rows()


def test_messages_to_keyed_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.json").write_text(
        json.dumps({"type": "match", "product_id": "X-Y", "price": "1", "size": "2",
                    "time": "2024-03-01T00:00:00Z"}) + "\n" + json.dumps({"type": "error"}) + "\n"
    )
    lines = line_stream(spark, str(tmp_path / "in")).selectExpr(
        "value", "timestamp'2024-05-01' AS timestamp"
    )
    query = start_table_sink(
        keyed_message_records(lines), str(tmp_path / "out"), str(tmp_path / "check"),
        available_now=True,
    )
    query.awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert row["key"] == "XY" and json.loads(row["value"])["T"] == BASE_MS


def test_bounded_runs_and_progress_log(spark, tmp_path, capfd):
    feed = Feed(spark, tmp_path)
    feed.put(record("A", 1, 10, 0), record("A", 2, 10, 500))
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        lines = line_stream(spark, str(tmp_path / "in"))
        fast = DEFAULTS.with_options(trigger_seconds=1)
        query = start_console_sink(windowed_records(lines, fast), fast)
        assert run_bounded(query, seconds=60, max_rows=2) >= 2
        assert not query.isActive
        query = start_console_sink(windowed_records(lines, fast), fast)
        run_bounded(query, seconds=2)
        assert not query.isActive
    finally:
        spark.streams.removeListener(log)


def test_unknown_sink(spark, feed):
    with pytest.raises(ValueError):
        start_table_sink(spark.range(1), "x", "y", "xml")


def test_topic_source_needs_the_connector(spark):
    from pyspark.errors import AnalysisException

    from tapewright.sources.streams import topic_stream

    with pytest.raises(AnalysisException, match="kafka"):
        topic_stream(spark)


def test_subscription():
    assert subscription("btc-usd, eth-usd") == ["BTC-USD", "ETH-USD"]
