import json

from pyspark.sql import functions as F

from tapewright.functions.values import split_symbols
from tapewright.operators.parse import (
    compact_json,
    keyed_records,
    normalize_messages,
    parse_messages,
    parse_trades,
)


def parsed(spark, *records):
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return parse_trades(spark.createDataFrame(lines, "value string")).collect()


def test_fields_that_differ_by_case_only(spark):
    for sensitive in ("true", "false"):
        spark.conf.set("spark.sql.caseSensitive", sensitive)
        try:
            record = {"e": "trade", "E": 5, "s": "X", "t": 7, "p": "1.5", "q": "2", "T": 1001, "m": True}
            (row,) = parsed(spark, record)
        finally:
            spark.conf.set("spark.sql.caseSensitive", "true")
        assert (row["symbol"], row["trade_id"], row["price"], row["quantity"]) == ("X", 7, 1.5, 2.0)
        assert row["trade_time"].timestamp() == 1.001


def test_bad_fields_only_null_themselves(spark):
    rows = parsed(
        spark,
        {"s": "X", "t": "x", "p": 7.25, "q": "", "T": "later"},
        {"s": "X", "t": "12", "p": "NaN", "q": "abc", "T": "1000"},
        "not json",
    )
    assert (rows[0]["trade_id"], rows[0]["price"], rows[0]["quantity"]) == (None, 7.25, None)
    assert rows[0]["trade_time"] is None
    assert rows[1]["trade_id"] == 12 and rows[1]["price"] != rows[1]["price"]
    assert rows[1]["trade_time"].timestamp() == 1.0
    assert all(v is None for v in rows[2])


def test_bytes_as_from_a_topic(spark):
    df = spark.createDataFrame([(bytearray(b'{"s":"X","p":"1"}'),)], "value binary")
    assert parse_trades(df).first()["symbol"] == "X"


def normalized(spark, *messages):
    lines = [(json.dumps(m),) for m in messages]
    df = spark.createDataFrame(lines, "value string").withColumn(
        "timestamp", F.lit("2024-05-01T00:00:00Z").cast("timestamp")
    )
    return normalize_messages(parse_messages(df, keep=("timestamp",)), F.col("timestamp"))


FULL = {
    "type": "ticker", "product_id": "BTC-USD", "time": "2024-03-01T00:00:00.123999Z",
    "price": "10.5", "last_size": "0.3", "size": "9", "trade_id": 77, "side": "sell",
}


def test_messages(spark):
    rows = normalized(
        spark,
        FULL,
        {**FULL, "type": "match", "last_size": "", "side": "buy"},
        {**FULL, "type": "last_match", "last_size": None, "side": None, "product_id": None},
        {**FULL, "time": None, "trade_id": None, "product_id": "A-B-C"},
        {**FULL, "type": "subscriptions"},
        {**FULL, "price": None},
        {**FULL, "last_size": None, "size": None},
    ).collect()
    assert [r["channel"] for r in rows] == ["ticker", "match", "last_match", "ticker"]
    assert [r["symbol"] for r in rows] == ["BTCUSD", "BTCUSD", "", "ABC"]
    assert [r["quantity"] for r in rows] == ["0.3", "9", "9", "0.3"]
    assert [r["sell_side"] for r in rows] == [True, False, False, True]
    assert [r["trade_id"] for r in rows] == [77, 77, 77, 0]
    assert rows[0]["event_ms"] == rows[0]["trade_ms"] == 1709251200123
    assert rows[3]["event_ms"] == 1714521600000


def test_keyed_record_reads_back(spark):
    records = normalized(spark, FULL)
    (row,) = keyed_records(records).collect()
    assert row["key"] == "BTCUSD"
    assert json.loads(row["value"]) == {
        "e": "trade", "E": 1709251200123, "s": "BTCUSD", "t": 77, "p": "10.5", "q": "0.3",
        "T": 1709251200123, "m": True, "source": "coinbase", "channel": "ticker",
    }
    again = parse_trades(records.select(compact_json(records).alias("value"))).first()
    assert (again["symbol"], again["price"]) == ("BTCUSD", 10.5)


def test_subscription_list():
    assert split_symbols(" btc-usd, ,ETH-USD,") == ["BTC-USD", "ETH-USD"]
