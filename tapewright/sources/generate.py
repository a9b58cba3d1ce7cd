"""Synthetic trades and injected faults, as Spark jobs of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Defaults and bounds of the generated data.
BASE_PRICES = {"BTCUSD": 97_000.0, "ETHUSD": 3_500.0}
TRADES_PER_SYMBOL = 2_000
BAD_RECORDS = 50
PRICE_SWING = 0.005
QUANTITY_RANGE = (0.0001, 2.0)
STEP_MS_RANGE = (100, 5_000)
FIRST_ID_FLOOR, FIRST_ID_SPAN = 100_000_000, 100_000_000


def uniform_draw(seed: int, label: str, *keys: Column) -> Column:
    """Draw in [0, 1) that depends on the keys only, so that any task recomputes the same."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(label), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)


def between(draw: Column, low: float, high: float) -> Column:
    return F.lit(float(low)) + draw * float(high - low)


def synthesize(
    slots: DataFrame, seed: int, start_ms: Column, rows_per_block: int = 1_000_000
) -> DataFrame:
    """Fill numbered slots (``symbol``, ``base_price``, ``first_id``, ``n`` = 0, 1, ...) with trades.

    Event time is a running sum of random steps. It is summed inside blocks of consecutive slots
    and shifted by the total of the blocks before, so one long series is made by many tasks.
    """
    draw = lambda label: uniform_draw(seed, label, F.col("symbol"), F.col("n"))
    low_ms, high_ms = STEP_MS_RANGE
    stepped = slots.withColumns(
        {
            "block": F.floor(F.col("n") / rows_per_block),
            "step_ms": F.floor(between(draw("step"), low_ms, high_ms + 1)),
        }
    )
    in_block = Window.partitionBy("symbol", "block").orderBy("n")
    earlier = Window.partitionBy("symbol").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        stepped.groupBy("symbol", "block").agg(F.sum("step_ms").alias("total"))
        .select(
            "symbol", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("shift")
        )
    )
    timed = stepped.withColumn("elapsed", F.sum("step_ms").over(in_block)).join(
        shifts, ["symbol", "block"]
    )
    swing = between(draw("price"), -PRICE_SWING, PRICE_SWING)
    return timed.select(
        F.lit("trade").alias("kind"),
        F.upper("symbol").alias("symbol"),
        (F.col("first_id") + F.col("n") + 1).alias("trade_id"),
        F.round(F.col("base_price") * (F.lit(1.0) + swing), 2).alias("price"),
        F.round(between(draw("quantity"), *QUANTITY_RANGE), 6).alias("quantity"),
        (start_ms + F.col("shift") + F.col("elapsed")).alias("trade_ms"),
        (draw("side") < 0.5).alias("sell_side"),
    )


def synthetic_trades(
    spark: SparkSession,
    per_symbol: int = TRADES_PER_SYMBOL,
    base_prices: dict[str, float] | None = None,
    seed: int = 42,
    start_ms: int | None = None,
) -> DataFrame:
    """``per_symbol`` trades around each base price, starting one hour ago unless told otherwise."""
    bases = list((base_prices or BASE_PRICES).items())
    names = F.array(*[F.lit(name) for name, _ in bases])
    prices = F.array(*[F.lit(float(price)) for _, price in bases])
    which = F.floor(F.col("id") / per_symbol).cast("int")
    slots = spark.range(per_symbol * len(bases)).select(
        F.get(names, which).alias("symbol"),
        F.get(prices, which).alias("base_price"),
        (F.col("id") % per_symbol).alias("n"),
    )
    first = F.floor(uniform_draw(seed, "first-id", F.col("symbol")) * FIRST_ID_SPAN)
    slots = slots.withColumn("first_id", F.lit(FIRST_ID_FLOOR) + first)
    hour_ago = F.unix_millis(F.current_timestamp()) - 3_600_000
    return synthesize(slots, seed, hour_ago if start_ms is None else F.lit(start_ms))


def as_compact(trades: DataFrame) -> DataFrame:
    """Numbers to text, as the wire form carries prices and quantities."""
    return trades.withColumns(
        {"price": F.col("price").cast("string"), "quantity": F.col("quantity").cast("string")}
    )


def faulty_copies(records: DataFrame, kind: Column, first_id: Column) -> DataFrame:
    """A faulty copy of every compact record; ``kind`` 0..4 selects the fault.

    0 empty price, 1 negative quantity, 2 zero price, 3 the id of the first record, 4 no symbol.
    """
    at = lambda n: kind == n
    return records.withColumns(
        {
            "price": F.when(at(0), F.lit("")).when(at(2), F.lit("0")).otherwise(F.col("price")),
            "quantity": F.when(at(1), F.lit("-1")).otherwise(F.col("quantity")),
            "trade_id": F.when(at(3), first_id).otherwise(F.col("trade_id")),
            "symbol": F.when(at(4), F.lit(None)).otherwise(F.col("symbol")),
        }
    )


def with_bad_records(
    records: DataFrame, count: int = BAD_RECORDS, order: str = "trade_id"
) -> DataFrame:
    """The records plus faulty copies of the first ``count`` of them, cycling through the faults."""
    first = records.orderBy(order).limit(count)
    numbered = first.withColumn("__n", F.row_number().over(Window.orderBy(order)) - 1)
    first_id = records.agg(F.min("trade_id").alias("id")).select("id").scalar()
    copies = faulty_copies(numbered, F.col("__n") % 5, first_id).drop("__n")
    return records.unionByName(copies)
