"""Validity rules, first-per-key de-duplication and the cleaning report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.values import split_symbols

NULL_REASON = "null"
INVALID_REASON = "invalid"
#: Name of the observation that ``observed_cleaning`` makes, and its counts.
CLEANING = "cleaning"
CLEANING_COUNTS = (
    "before_rows", "null_rows", "invalid_rows", "timeless_rows", "blank_symbol_rows", "kept_rows",
)


def in_bounds(name: str, settings: Settings = DEFAULTS) -> Column:
    value = F.col(name)
    return (value > F.lit(0.0)) & (value < F.lit(settings.value_upper_bound))


def reject_reason(settings: Settings = DEFAULTS) -> Column:
    """``null`` / ``invalid`` for a trade that batch cleaning drops, else null."""
    unusable = F.col("symbol").isNull()
    for name in ("price", "quantity"):
        unusable = unusable | F.col(name).isNull() | F.isnan(name)
    valid = in_bounds("price", settings) & in_bounds("quantity", settings)
    return F.when(unusable, NULL_REASON).when(~valid, INVALID_REASON)


def with_trade_value(trades: DataFrame) -> DataFrame:
    return trades.withColumn("trade_value", F.col("price") * F.col("quantity"))


def clean_trades_stream(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Stream rules: symbol and time present, price and quantity inside the open bounds."""
    usable = (
        F.col("symbol").isNotNull()
        & F.col("trade_time").isNotNull()
        & in_bounds("price", settings)
        & in_bounds("quantity", settings)
    )
    return with_trade_value(trades.filter(usable))


def observed_cleaning(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``trades`` unchanged, counted on their way through: what the stream rules will drop, and why.

    The counts are an observation of the same pass, so a live query has them per batch for the
    price of a few counters; each row is counted once, as null, invalid, timeless or kept. Summed
    over batches the first three are those of ``cleaning_report`` on the same rows.
    """
    reason = reject_reason(settings)
    valid, timed = reason.isNull(), F.col("trade_time").isNotNull()
    counts = (
        F.count(F.lit(1)),
        F.count_if(reason == NULL_REASON),
        F.count_if(reason == INVALID_REASON),
        F.count_if(valid & ~timed),
        F.count_if(valid & (F.col("symbol") == "")),
        F.count_if(valid & timed),
    )
    return trades.observe(CLEANING, *[c.alias(n) for n, c in zip(CLEANING_COUNTS, counts)])


def valid_trades(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Batch rules: as the stream's, but a trade without a time is kept."""
    # The bounds reject nulls as well, and NaN, which compares as the largest value.
    usable = F.col("symbol").isNotNull()
    return with_trade_value(
        trades.filter(usable & in_bounds("price", settings) & in_bounds("quantity", settings))
    )


def first_per_key(
    trades: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    order: Sequence[str] = ("trade_time",),
) -> DataFrame:
    """Keep one row per key: the earliest by ``order`` (nulls last); null keys are one key.

    The minimum of a row struct is combined on the map side before the one shuffle, so a key
    shared by a large part of all rows reaches its reducer as one candidate per map task. All
    remaining columns take part in the comparison, so the survivor is the same however the
    input is split.
    """
    return _picked(trades.groupBy(*keys).agg(_first(trades, keys, order)), trades.columns, keys)


def _first(trades: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    others = [c for c in trades.columns if c not in keys]
    ranked = [F.col(c) for c in order] + [F.col(c) for c in others if c not in order]
    nulls_last = [F.col(c).isNull().alias(f"__{c}_missing") for c in order]
    return F.min(F.struct(*nulls_last, *ranked)).alias("__first")


def _picked(firsts: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return firsts.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in columns])


def _exempt(exempt_ids: Sequence[int]) -> Column:
    return F.coalesce(F.col("trade_id").isin(*exempt_ids), F.lit(False))


def dedupe_trades(
    trades: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    exempt_ids: Sequence[int] = (),
) -> DataFrame:
    """First trade per id. Ids in ``exempt_ids`` (say the feed's 0 for "no id") all stay."""
    if not exempt_ids:
        return first_per_key(trades, keys)
    exempt = _exempt(exempt_ids)
    return first_per_key(trades.filter(~exempt), keys).unionByName(trades.filter(exempt))


def dedupe_trades_stream(
    trades: DataFrame,
    settings: Settings = DEFAULTS,
    keys: Sequence[str] = ("trade_id",),
    exempt_ids: Sequence[int] = (),
) -> DataFrame:
    """As ``dedupe_trades`` on a stream with a watermark on ``trade_time``: the earliest trade per id.

    The trades of an id are one session as long as each comes within ``repeat_seconds`` of event
    time of another one; the state of an id is its earliest row alone. It is emitted, and its state
    goes, once the watermark has passed the session's end, so an id that comes again later than
    that is a new trade. Ids in ``exempt_ids`` pass at once. Append mode; rows without a time are
    left out, as the stream rules have it, and so are rows that are late.
    """
    exempt = _exempt(exempt_ids)
    session = F.session_window("trade_time", f"{settings.repeat_seconds} seconds")
    # Watermarked columns cannot be part of a result that is a plain copy: times go as microseconds.
    ranked = trades.filter(~exempt).withColumn("__micros", F.unix_micros("trade_time"))
    firsts = ranked.groupBy(session, *keys).agg(
        _first(ranked.select(*[F.col(c) for c in ranked.columns if c != "trade_time"]), keys, ("__micros",))
    )
    columns = [c for c in ranked.columns if c != "trade_time"]
    out = _picked(firsts, columns, keys).withColumn("trade_time", F.timestamp_micros("__micros"))
    out = out.select(*trades.columns)
    return out.unionByName(trades.filter(exempt)) if exempt_ids else out


def in_time_order(trades: DataFrame) -> DataFrame:
    return trades.orderBy(F.asc_nulls_last("trade_time"), F.asc_nulls_last("trade_id"))


def clean_trades(
    trades: DataFrame,
    settings: Settings = DEFAULTS,
    keys: Sequence[str] = ("trade_id",),
    exempt_ids: Sequence[int] = (),
) -> DataFrame:
    """Batch cleaning: drop nulls and out-of-range values, derive the value, de-duplicate."""
    return dedupe_trades(valid_trades(trades, settings), keys, exempt_ids)


def cleaning_report(trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: records before and after cleaning, and how many went for which reason.

    A single shuffle on the de-duplication key carries pre-aggregated counters only.
    """
    reason = reject_reason(settings)
    per_id = (
        trades.select("trade_id", "symbol", reason.alias("reason"))
        .groupBy("trade_id")
        .agg(
            F.count("*").alias("seen"),
            F.count_if(F.col("reason") == NULL_REASON).alias("nulls"),
            F.count_if(F.col("reason") == INVALID_REASON).alias("invalid"),
            F.count_if(F.col("reason").isNull()).alias("valid"),
            F.count_if(F.col("reason").isNull() & (F.col("symbol") == "")).alias("blank"),
        )
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_id.agg(
        total("seen").alias("before_rows"),
        total("nulls").alias("null_rows"),
        total("invalid").alias("invalid_rows"),
        total(F.greatest(F.col("valid") - 1, F.lit(0))).alias("duplicate_rows"),
        total(F.least(F.col("valid"), F.lit(1))).alias("after_rows"),
        total("blank").alias("blank_symbol_rows"),
    )


def symbol_filter(trades: DataFrame, symbols: str | Sequence[str]) -> DataFrame:
    """Rows of the subscribed symbols, given as a list or as comma-separated text of product ids."""
    if isinstance(symbols, str):
        names = [name.replace("-", "") for name in split_symbols(symbols)]
    else:
        names = list(symbols)
    return trades.filter(F.col("symbol").isin(*names))
