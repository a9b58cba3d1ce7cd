"""What live jobs count, keep by date, hold open, find late and keep of repeats."""

import datetime as dt
import json
import os

import pytest

from helpers import START, at
from tapewright.config import DEFAULTS
from tapewright.operators.clean import (
    CLEANING_COUNTS,
    clean_trades_stream,
    cleaning_report,
    dedupe_trades,
    dedupe_trades_stream,
)
from tapewright.operators.parse import parse_trades
from tapewright.operators.windows import window_aggregates
from tapewright.sources.files import DAY, read_days, read_sink, with_day
from tapewright.sources.streams import line_stream
from tapewright.streaming import monitor
from tapewright.streaming.jobs import windowed_records, with_event_time
from tapewright.streaming.monitor import cleaning_progress, progress_rows
from tapewright.streaming.sinks import start_table_sink
from tapewright.streaming.state import open_windows, read_late_split, start_late_split

BASE_MS = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def record(symbol, trade_id, price, seconds, quantity="1"):
    when = None if seconds is None else BASE_MS + int(seconds * 1000)
    return {"e": "trade", "s": symbol, "t": trade_id, "p": str(price), "q": quantity, "T": when, "m": False}


class Inbox:
    def __init__(self, spark, root):
        self.spark, self.root, self.given = spark, root, []
        (root / "in").mkdir()

    def put(self, *records):
        self.given += records
        path = self.root / "in" / f"{len(self.given):05d}.json"
        path.write_text("\n".join(map(json.dumps, records)) + "\n")
        os.utime(path, (1_700_000_000 + len(self.given),) * 2)  # files are taken in the order of their times

    def stream(self):
        return line_stream(self.spark, str(self.root / "in"), max_files=1)

    def start(self, rows, name="out", **options):
        query = start_table_sink(
            rows, str(self.root / name), str(self.root / f"{name}-check"), available_now=True, **options
        )
        query.awaitTermination()
        return query

    def batch(self):
        lines = self.spark.createDataFrame([(json.dumps(g),) for g in self.given], "value string")
        return parse_trades(lines)


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def test_batches_tell_what_cleaning_dropped(inbox, spark):
    inbox.put(record("A", 1, 10, 0), record(None, 2, 10, 1), record("A", 3, -1, 2), record("A", 4, "x", 3))
    inbox.put(record("", 5, 10, 4), record("A", 6, 10, None), record("A", 7, 10, 5, "0"), {"s": 1})
    inbox.put(record("A", 8, 10, 900))
    query = inbox.start(windowed_records(inbox.stream(), observe=True))
    rows = {r["batch_id"]: tuple(r)[1:] for r in cleaning_progress(spark, query).collect()}
    assert rows[0] == (4, 2, 1, 0, 0, 1) and rows[1] == (4, 1, 1, 1, 1, 1) and rows[2] == (1, 0, 0, 0, 0, 1)
    total = dict(zip(CLEANING_COUNTS, map(sum, zip(*rows.values()))))
    report = cleaning_report(inbox.batch()).first()
    assert all(total[c] == report[c] for c in ("before_rows", "null_rows", "invalid_rows", "blank_symbol_rows"))
    unobserved = inbox.start(windowed_records(inbox.stream()), "plain")
    assert cleaning_progress(spark, unobserved).count() == 0
    assert read_sink(spark, str(inbox.root / "out")).count() == read_sink(spark, str(inbox.root / "plain")).count() > 0


def test_ended_runs_are_forgotten(inbox, spark, monkeypatch):
    monkeypatch.setattr(monitor, "KEPT_RUNS", 1)
    inbox.put(record("A", 1, 10, 0))
    first = inbox.start(windowed_records(inbox.stream()), "a")
    assert sum(r[1] for r in progress_rows(first)) == 1
    second = inbox.start(windowed_records(inbox.stream()), "b")
    assert sum(r[1] for r in progress_rows(second)) == 1
    assert len(monitor._BATCHES.ended) == 1 and str(first.runId) not in monitor._BATCHES.rows


def files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_a_day_is_read_from_its_folder_alone(inbox, spark):
    days = 30
    for day in range(days):
        inbox.put(*(record("AB"[i % 2], day * 100 + i, 10 + i, day * 86_400 + i * 3_000) for i in range(28)))
    rows = with_day(windowed_records(inbox.stream()))
    inbox.start(rows, partition_by=[DAY])
    out = str(inbox.root / "out")
    every = read_days(spark, out)
    names = sorted(p.name for p in (inbox.root / "out").glob(f"{DAY}=*"))
    assert len(names) == days
    one = read_days(spark, out, "2024-03-05", "2024-03-06")
    folder = list((inbox.root / "out" / f"{DAY}=2024-03-05").glob("*.parquet"))
    assert files_read(one) == len(folder) < files_read(every)
    key = ["window_start", "symbol"]
    lower, upper = (dt.datetime(2024, 3, d, tzinfo=dt.timezone.utc) for d in (5, 6))
    wanted = every.where((every.window_start >= lower) & (every.window_start < upper))
    assert one.orderBy(*key).collect() == wanted.orderBy(*key).collect() and one.count() == 28
    part = read_days(spark, out, "2024-03-05T06:00:00", "2024-03-06T01:00:00")
    lower, upper = dt.datetime(2024, 3, 5, 6, tzinfo=dt.timezone.utc), dt.datetime(2024, 3, 6, 1, tzinfo=dt.timezone.utc)
    assert part.count() == every.where((every.window_start >= lower) & (every.window_start < upper)).count() > 0
    stray = next((inbox.root / "out" / f"{DAY}=2024-03-05").glob("*.parquet"))
    (stray.parent / "stray.parquet").write_bytes(stray.read_bytes())
    assert read_days(spark, out, "2024-03-05", "2024-03-06").count() == 28


def test_emitted_and_open_windows_are_all_windows(inbox, spark):
    for start in range(3):
        inbox.put(*(record("AB"[i % 2], start * 50 + i, 50 + i % 9, start * 400 + i * 7.5, "2") for i in range(50)))
    inbox.start(windowed_records(inbox.stream()))
    check = str(inbox.root / "out-check")
    still = open_windows(spark, check)
    made = read_sink(spark, str(inbox.root / "out"))
    batch = window_aggregates(clean_trades_stream(inbox.batch()))
    order = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[2]))
    got = [(*r[:-1], r[-1] or "") for r in order(made.unionByName(still))]
    assert got == order(batch) and still.count() > 0 and made.count() > 0
    assert order(open_windows(spark, check, batch=0)) != order(still)


def test_late_rows_are_kept_apart(inbox, spark):
    big = 2**60 + 1
    inbox.put(record("A", big, 10, 0), record("A", 2, 10, 1000))
    inbox.put(record("A", 3, 10.1, 10), record("B", big + 1, 10, 950), record("B", 5, 1e-3, 2000))
    inbox.put(record("A", None, 10, 1500), record("A", 7, 10, 1870), record("A", 8, 10, None))

    def start():
        timed = with_event_time(parse_trades(inbox.stream()))
        start_late_split(timed, str(inbox.root / "split"), str(inbox.root / "split-check"), available_now=True).awaitTermination()
        return read_late_split(spark, str(inbox.root / "split"), timed.schema)

    start()
    inbox.put(record("A", 9, 10, 1), record("A", 10, 10, 3000))
    rows = start()
    late = {r["trade_id"] for r in rows.where("late").collect()}
    assert late == {3, None, 9}
    plain = lambda df: sorted(map(repr, df.select("symbol", "trade_id", "price", "quantity", "trade_time").collect()))
    assert plain(rows) == plain(inbox.batch())


def test_first_trades_of_a_stream_are_those_of_the_batch(inbox, spark):
    settings = DEFAULTS.with_options(repeat_seconds=300)
    inbox.put(record("A", 1, 10, 50), record("A", 1, 11, 20), record("B", 2, 10, 0), record("A", 0, 1, 5), record("A", 0, 2, 6))
    inbox.put(record("A", 1, 12, 60), record("C", 2, 9, 0), record("A", 3, 10, 100), record("A", 3, 0, 99), record("B", 2, 10, 0))

    def start():
        timed = with_event_time(clean_trades_stream(parse_trades(inbox.stream())))
        inbox.start(dedupe_trades_stream(timed, settings, exempt_ids=[0]))
        return spark.read.parquet(str(inbox.root / "out"))

    assert {r["trade_id"] for r in start().collect()} == {0}  # the others' sessions are open
    inbox.put(record("A", 1, 13, 45), record("A", 4, 10, 200), record("Z", 99, 1, 9000))
    inbox.put(record("Z", 98, 1, 9001))
    rows = [r for r in start().collect() if r["symbol"] != "Z"]
    want = dedupe_trades(clean_trades_stream(inbox.batch()), exempt_ids=[0])
    key = lambda r: (r["trade_id"], r["price"])
    assert sorted(map(tuple, rows)) == sorted(tuple(r) for r in want.collect() if r["symbol"] != "Z")
    first = next(r for r in rows if r["trade_id"] == 1)
    assert key(first) == (1, 11.0) and first["trade_time"].timestamp() == at(20).replace(tzinfo=dt.timezone.utc).timestamp()
