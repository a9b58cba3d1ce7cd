"""Joins of a long table with a lookup that holds one row, or few rows, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.session import materialize

_SALT, _PARTS = "__join_salt", "__join_parts"


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    settings: Settings = DEFAULTS,
    how: str = "inner",
    written: bool = False,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` on ``keys`` without gathering a hot key in one task.

    Spark guesses the size of an aggregated side from its input, and would shuffle the long table
    just in case. So the lookup is written first (unless it is ``written`` already) and counted:
    up to ``lookup_rows`` it is broadcast and the long table stays where it is. A larger one is
    joined on (keys, salt): a key with over ``salt_rows`` rows is spread over as many tasks as it
    fills, and its lookup row is repeated for each; other keys have one salt.
    """
    table = lookup if written else materialize(lookup, "lookup")
    if table.count() <= settings.lookup_rows:
        return rows.join(F.broadcast(table), list(keys), how)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > settings.salt_rows)
    parts = F.ceil(F.col("__n") / settings.salt_rows).cast("int").alias(_PARTS)
    # One row per key with over ``salt_rows`` rows.
    hot = materialize(counts.select(*keys, parts), "hot-keys")
    few = hot.count() <= settings.lookup_rows
    split = lambda df: df.join(F.broadcast(hot) if few else hot, list(keys), "left")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1))
    salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce(_PARTS, F.lit(1))).cast("int")
    return (
        split(rows).withColumn(_SALT, salt).drop(_PARTS)
        .join(split(table).withColumn(_SALT, salts).drop(_PARTS), [*keys, _SALT], how)
        .drop(_SALT)
    )
