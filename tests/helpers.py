"""Hand-made trades and plain-Python checks."""

from __future__ import annotations

import datetime as dt

TRADE_DDL = (
    "symbol string, trade_id bigint, price double, quantity double, "
    "trade_time timestamp_ntz, trade_value double"
)
START = dt.datetime(2024, 3, 1)


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def trade(symbol, trade_id, price, quantity=1.0, seconds=0.0):
    when = None if seconds is None else at(seconds)
    price, quantity = (None if v is None else float(v) for v in (price, quantity))
    value = None if price is None or quantity is None else price * quantity
    return (symbol, trade_id, price, quantity, when, value)


def trades_df(spark, rows):
    return spark.createDataFrame(rows, TRADE_DDL)


def same_rows(left, right, places: int = 9):
    """Both results as sorted tuples, doubles rounded."""

    def plain(df):
        names = sorted(df.columns)
        return sorted(
            (
                tuple(round(v, places) if isinstance(v, float) else v for v in row)
                for row in df.select(*names).collect()
            ),
            key=repr,
        )

    return plain(left) == plain(right)
