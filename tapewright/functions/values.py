"""Lenient casts and null handling that do not depend on the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def lenient_long(text: Column) -> Column:
    """Whole number from text; text in float notation is truncated, other text gives null."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null, never an error or infinity, for a zero denominator."""
    return F.try_divide(numerator, denominator)


def or_zero(value: Column) -> Column:
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def text_or(value: Column, fallback: str) -> Column:
    """``value`` unless it is null or empty text."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(fallback))


def truthy_text(value: Column) -> Column:
    """Boolean from its text form; null counts as false."""
    return F.coalesce(F.lower(value.cast("string")).isin("true", "1"), F.lit(False))


def split_symbols(text: str) -> list[str]:
    """Comma-separated subscription list to trimmed upper-case names, blanks dropped."""
    names = (part.strip() for part in text.split(","))
    return [name.upper() for name in names if name]


def product_symbol(product: Column) -> Column:
    """Exchange product id to symbol: dashes removed, null to empty text."""
    return F.replace(F.coalesce(product, F.lit("")), F.lit("-"), F.lit(""))
