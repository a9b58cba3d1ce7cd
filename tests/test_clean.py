import pytest

from helpers import trade, trades_df
from tapewright.operators.clean import (
    clean_trades,
    clean_trades_stream,
    cleaning_report,
    dedupe_trades,
    first_per_key,
    in_time_order,
    symbol_filter,
)
from tapewright.operators.parse import compact_json, parse_trades
from tapewright.schemas import require_columns
from tapewright.sources.generate import as_compact, synthetic_trades, with_bad_records

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def edges(spark):
    return trades_df(
        spark,
        [
            trade("A", 1, 1.0, 1.0, 5),
            trade("A", 2, 0.0),
            trade("A", 3, 1e9),
            trade("A", 4, NAN),
            trade("A", 5, INF),
            trade("A", 6, 1.0, -1.0),
            trade("A", 7, None),
            trade(None, 8, 1.0),
            trade("A", 9, 999999999.9, 0.5, None),
            trade("B", 1, 2.0, 1.0, 4),  # same id, earlier, other symbol
            trade("A", None, 1.0, 1.0, 7),
            trade("B", None, 1.0, 1.0, 6),
            trade("", 10, 1.0, 1.0, 8),
        ],
    ).drop("trade_value")


def test_batch_rules(edges):
    rows = {(r["symbol"], r["trade_id"]): r for r in clean_trades(edges).collect()}
    assert set(rows) == {("A", 9), ("B", 1), ("B", None), ("", 10)}
    assert rows["A", 9]["trade_value"] == 999999999.9 * 0.5
    assert rows["A", 9]["trade_time"] is None


def test_stream_rules_need_a_time_and_keep_repeats(edges):
    kept = [(r["symbol"], r["trade_id"]) for r in clean_trades_stream(edges).collect()]
    assert sorted(kept, key=repr) == sorted(
        [("A", 1), ("B", 1), ("A", None), ("B", None), ("", 10)], key=repr
    )


def test_report_counts_in_order(edges):
    row = cleaning_report(edges).first().asDict()
    assert row == {
        "before_rows": 13, "null_rows": 3, "invalid_rows": 4, "duplicate_rows": 2,
        "after_rows": 4, "blank_symbol_rows": 1,
    }
    assert row["after_rows"] == clean_trades(edges).count()


def test_keys_and_exempt_ids(edges):
    by_symbol = clean_trades(edges, keys=("symbol", "trade_id"))
    assert by_symbol.count() == 6
    assert clean_trades(edges, exempt_ids=(1,)).count() == 5


def test_survivor_does_not_depend_on_partitioning(edges):
    for parts in (1, 3, 7):
        rows = first_per_key(edges.repartition(parts)).filter("trade_id = 1").collect()
        assert [r["symbol"] for r in rows] == ["B"]


def test_one_id_for_most_rows(spark):
    rows = [trade("A", 7 if i % 3 else i + 100, 1.0 + i, 1.0, 1000 - i) for i in range(900)]
    kept = dedupe_trades(trades_df(spark, rows))
    assert kept.count() == 301
    assert kept.filter("trade_id = 7").first()["price"] == 900.0


def test_time_order_puts_missing_last(edges):
    times = [r["trade_time"] for r in in_time_order(clean_trades(edges)).collect()]
    assert times[-1] is None and times[:-1] == sorted(times[:-1])


def test_symbols(edges):
    assert symbol_filter(edges, "b, ").count() == 2
    assert symbol_filter(edges, ["A"]).count() == 9


def test_generated_data_with_faults(spark):
    """4,050 records in: 20 null, 20 invalid, 10 repeated, 4,000 out."""
    records = with_bad_records(as_compact(synthetic_trades(spark, start_ms=1_700_000_000_000)))
    lines = records.select(compact_json(records).alias("value"))
    trades = parse_trades(lines)
    assert cleaning_report(trades).first().asDict() == {
        "before_rows": 4050, "null_rows": 20, "invalid_rows": 20, "duplicate_rows": 10,
        "after_rows": 4000, "blank_symbol_rows": 0,
    }


def test_generated_ranges(spark):
    made = synthetic_trades(spark, 300, start_ms=0).orderBy("symbol", "trade_id").collect()
    for symbol, base in (("BTCUSD", 97000.0), ("ETHUSD", 3500.0)):
        rows = [r for r in made if r["symbol"] == symbol]
        assert len(rows) == 300
        assert all(abs(r["price"] / base - 1) <= 0.00501 for r in rows)
        assert all(0.0001 <= r["quantity"] <= 2.0 for r in rows)
        steps = [b["trade_ms"] - a["trade_ms"] for a, b in zip(rows, rows[1:])]
        assert all(100 <= s <= 5000 for s in steps)
        assert [b["trade_id"] - a["trade_id"] for a, b in zip(rows, rows[1:])] == [1] * 299


def test_generated_blocks_join_without_seams(spark):
    from pyspark.sql import functions as F

    from helpers import same_rows
    from tapewright.sources.generate import synthesize

    slots = spark.range(500).select(
        F.lit("x").alias("symbol"), F.lit(5.0).alias("base_price"), F.lit(0).alias("first_id"),
        F.col("id").alias("n"),
    )
    whole = synthesize(slots, 1, F.lit(0))
    assert same_rows(whole, synthesize(slots, 1, F.lit(0), rows_per_block=37))


def test_missing_columns_are_named_in_order(edges):
    with pytest.raises(ValueError, match=r"\['a', 'z'\]"):
        require_columns(edges, ["z", "symbol", "a"])
