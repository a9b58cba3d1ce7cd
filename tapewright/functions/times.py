"""Time conversions that never depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def is_wall_clock(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP to the TIMESTAMP_NTZ a clock in UTC shows."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def wall_clock_micros(wall: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ."""
    day = F.unix_date(wall.cast("date")).cast("bigint")
    second_of_day = F.hour(wall) * 3600 + F.minute(wall) * 60
    second = F.extract(F.lit("SECOND"), wall)
    return (day * 86_400 + second_of_day) * 1_000_000 + (second * 1_000_000).cast("bigint")


def utc_instant(wall: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC to TIMESTAMP, as watermarks need it."""
    return F.timestamp_micros(wall_clock_micros(wall))


def utc_micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch of a column of either timestamp type."""
    value = F.col(column)
    return wall_clock_micros(value) if is_wall_clock(df, column) else F.unix_micros(value)


def as_wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Turn every named TIMESTAMP column into UTC wall-clock time; NTZ columns stay as they are."""
    return df.withColumns(
        {c: utc_wall_clock(F.col(c)) for c in columns if not is_wall_clock(df, c)}
    )


def as_instant(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: utc_instant(F.col(c)) for c in columns if is_wall_clock(df, c)})


def utc_day(df: DataFrame, column: str) -> Column:
    """The date, in UTC, of a time of either type."""
    return F.date_from_unix_date(F.floor(utc_micros(df, column) / 86_400_000_000).cast("int"))


def hour_of_day(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    return F.hour(value if is_wall_clock(df, column) else utc_wall_clock(value))


def iso_text(df: DataFrame, column: str) -> Column:
    """ISO-8601 text with microseconds; null stays null."""
    wall = F.col(column) if is_wall_clock(df, column) else utc_wall_clock(F.col(column))
    text = wall.cast("string")
    seconds = F.translate(F.substring(text, 1, 19), " ", "T")
    return F.concat(seconds, F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def iso_millis(text: Column) -> Column:
    """Epoch milliseconds of ISO-8601 text; null for text that is no timestamp."""
    return F.unix_millis(F.try_to_timestamp(text))
