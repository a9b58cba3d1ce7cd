"""Fixed schemas of every input and output table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _LONG, _REAL = T.StringType(), T.LongType(), T.DoubleType()
_FLAG, _TIME = T.BooleanType(), T.TimestampType()

# Wire form of a trade. Numbers are read as text, so one bad field only nulls itself.
COMPACT_TRADE = _struct(
    e=_TEXT, E=_TEXT, s=_TEXT, t=_TEXT, p=_TEXT, q=_TEXT, T=_TEXT, m=_FLAG,
    source=_TEXT, channel=_TEXT,
)
# The same fields by position, under names that do not differ by case only.
COMPACT_TRADE_NAMES = [
    "kind", "event_ms", "symbol", "trade_id", "price", "quantity", "trade_ms", "sell_side",
    "source", "channel",
]

# What becomes a trade; the parser skips the other fields.
TRADE_FIELDS = T.StructType([COMPACT_TRADE[name] for name in ("s", "t", "p", "q", "T")])
TRADE_FIELD_NAMES = ["symbol", "trade_id", "price", "quantity", "trade_ms"]

EXCHANGE_MESSAGE = _struct(
    type=_TEXT, product_id=_TEXT, time=_TEXT, price=_TEXT, last_size=_TEXT, size=_TEXT,
    trade_id=_TEXT, side=_TEXT,
)

TRADE = _struct(
    symbol=_TEXT, trade_id=_LONG, price=_REAL, quantity=_REAL, trade_time=_TIME,
    trade_value=_REAL,
)

WINDOW_AGGREGATE = _struct(
    window_start=_TIME, window_end=_TIME, symbol=_TEXT, avg_price=_REAL, min_price=_REAL,
    max_price=_REAL, price_spread_pct=_REAL, volume=_REAL, notional_volume=_REAL,
    max_trade_value=_REAL, trade_count=_LONG, is_anomaly=_FLAG, anomaly_reason=_TEXT,
)

ZSCORED_TRADE = T.StructType(
    TRADE.fields + _struct(price_zscore=_REAL, trade_value_zscore=_REAL, is_anomaly=_FLAG).fields
)

FOREST_SCORED_TRADE = T.StructType(
    TRADE.fields
    + _struct(
        price_return=_REAL, rolling_trade_count=_REAL, rolling_trade_value_mean=_REAL,
        ml_anomaly_score=_REAL, is_ml_anomaly=_FLAG, ml_model=_TEXT,
    ).fields
)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ValueError listing, in sorted order, the required columns ``df`` lacks."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
