"""Raw text records to normalised trades, and exchange messages to compact records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.times import iso_millis
from tapewright.functions.values import lenient_double, lenient_long, product_symbol
from tapewright.schemas import (
    COMPACT_TRADE,
    COMPACT_TRADE_NAMES,
    EXCHANGE_MESSAGE,
    TRADE_FIELD_NAMES,
    TRADE_FIELDS,
)

# Kinds of exchange message that carry a trade, and the record tags.
TRADE_MESSAGE_TYPES = ("ticker", "match", "last_match")
RECORD_KIND = "trade"
RECORD_SOURCE = "coinbase"


def decoded_once(records: DataFrame, value: str, schema: T.StructType, *keep: str) -> DataFrame:
    """Fields of the JSON text in ``value``, then the ``keep`` columns.

    The fields pass through a generator: filters on them stay above it, so that the text is
    parsed once per record and not once per pushed-down condition.
    """
    record = F.from_json(F.col(value).cast("string"), schema)
    return records.select(F.inline(F.array(record)), *keep)


def parse_trades(records: DataFrame, value: str = "value") -> DataFrame:
    """Decode compact JSON records held in ``value`` (text or bytes); works on streams too.

    Malformed JSON gives a row of nulls, which the cleaning rules then reject.
    """
    fields = decoded_once(records, value, TRADE_FIELDS).toDF(*TRADE_FIELD_NAMES)
    return fields.select(
        "symbol",
        lenient_long(F.col("trade_id")).alias("trade_id"),
        lenient_double(F.col("price")).alias("price"),
        lenient_double(F.col("quantity")).alias("quantity"),
        F.timestamp_millis(lenient_long(F.col("trade_ms"))).alias("trade_time"),
    )


def parse_messages(records: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode raw exchange messages held in ``value``."""
    return decoded_once(records, value, EXCHANGE_MESSAGE, *keep)


def normalize_messages(messages: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Exchange messages to compact trade records; stateless, so it serves batch and stream.

    ``received_at`` (the broker's record timestamp) stands in for a missing event time, which
    keeps replays stable; without it the current timestamp is used.
    """
    size = F.coalesce(F.nullif(F.col("last_size"), F.lit("")), F.col("size"))
    received_ms = F.unix_millis(F.current_timestamp() if received_at is None else received_at)
    event_ms = F.coalesce(iso_millis(F.nullif(F.col("time"), F.lit(""))), received_ms)
    carries_trade = (
        F.col("type").isin(*TRADE_MESSAGE_TYPES) & F.col("price").isNotNull() & size.isNotNull()
    )
    return messages.filter(carries_trade).select(
        F.lit(RECORD_KIND).alias("kind"),
        event_ms.alias("event_ms"),
        product_symbol(F.col("product_id")).alias("symbol"),
        F.coalesce(lenient_long(F.col("trade_id")), F.lit(0)).alias("trade_id"),
        F.col("price"),
        size.alias("quantity"),
        event_ms.alias("trade_ms"),
        F.col("side").eqNullSafe("sell").alias("sell_side"),
        F.lit(RECORD_SOURCE).alias("source"),
        F.col("type").alias("channel"),
    )


def compact_json(records: DataFrame) -> Column:
    """JSON text of a compact record, with its wire names."""
    names = dict(zip(COMPACT_TRADE_NAMES, COMPACT_TRADE.fieldNames()))
    present = [F.col(c).alias(names[c]) for c in COMPACT_TRADE_NAMES if c in records.columns]
    return F.to_json(F.struct(*present))


def keyed_records(records: DataFrame) -> DataFrame:
    """Key/value form for a keyed topic: key is the symbol, value the JSON record."""
    return records.select(F.col("symbol").alias("key"), compact_json(records).alias("value"))
