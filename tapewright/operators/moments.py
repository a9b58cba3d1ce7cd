"""Rolling count, mean and deviation over the last n rows, in about log2(n) lag steps.

A sliding ``ROWS`` frame folds all n rows again for every row. Here the moments of the last 1, 2,
4, ... rows are built by merging each row's moments with those the same distance back, and the
frame is put together from the powers of two in n. Merging moments (instead of subtracting running
sums) loses no digits, and a constant frame has a deviation of exactly zero. All steps share one
partitioning and order, so Spark adds neither a shuffle nor a sort for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PARTS = ("n", "mean", "dev")  # count, mean, sum of squared deviations from it


def _state(level: int | str, column: str) -> dict[str, str]:
    return {part: f"__{part}{level}_{column}" for part in PARTS}


def _single(column: str, out: dict[str, str]) -> list[Column]:
    """Moments of one row; a null value counts as no row."""
    return [
        F.expr(f"CASE WHEN `{column}` IS NULL THEN 0D ELSE 1D END").alias(out["n"]),
        F.expr(f"coalesce(`{column}`, 0D)").alias(out["mean"]),
        F.lit(0.0).alias(out["dev"]),
    ]


def _merged(near: dict[str, str], far: dict[str, str], out: dict[str, str]) -> list[Column]:
    """Moments of two disjoint sets of rows; a null ``far`` (before the series) is empty."""
    names = {f"{part}1": f"`{near[part]}`" for part in PARTS}
    names |= {f"{part}2": f"`{far[part]}`" for part in PARTS}
    names["share"] = "coalesce(try_divide({n2}, {n1} + {n2}), 0D)".format(**names)
    names["apart"] = "({mean2} - {mean1})".format(**names)
    texts = {
        "n": "{n1} + coalesce({n2}, 0D)",
        "mean": "{mean1} + coalesce({apart}, 0D) * {share}",
        "dev": "{dev1} + coalesce({dev2} + {apart} * {apart} * {n1} * {share}, 0D)",
    }
    return [F.expr(text.format(**names)).alias(out[part]) for part, text in texts.items()]


def _lagged(level: int, rows: int, column: str, out: dict[str, str], window) -> list[Column]:
    state = _state(level, column)
    return [F.lag(state[part], rows).over(window).alias(out[part]) for part in PARTS]


def with_rolling_moments(
    df: DataFrame, window, width: int, columns: Sequence[str], prefix: str = "__last_"
) -> DataFrame:
    """Add count, mean and sample deviation of each column's last ``width`` rows, itself included.

    The new columns are ``{prefix}{column}_n``, ``_mean`` and ``_std``; the deviation is null below
    two values.
    """
    powers = [k for k in range(width.bit_length()) if width >> k & 1]
    top, given = powers[-1], df.columns
    kept: list[str] = []
    out = df.select("*", *[e for c in columns for e in _single(c, _state(0, c))])
    for k in range(top):
        lags = [e for c in columns for e in _lagged(k, 2**k, c, _state("back", c), window)]
        if k in powers:
            kept += [name for c in columns for name in _state(k, c).values()]
        grown = [
            e
            for c in columns
            for e in _merged(_state(k, c), _state("back", c), _state(k + 1, c))
        ]
        out = out.select("*", *lags).select(*given, *kept, *grown)
    # The smaller powers cover the rows further back, one behind the other.
    distance, far = 2**top, []
    for k in reversed(powers[:-1]):
        far += [e for c in columns for e in _lagged(k, distance, c, _state(f"far{k}", c), window)]
        distance += 2**k
    out = out.select("*", *far) if far else out
    for k in reversed(powers[:-1]):
        others = [name for name in out.columns if name not in _names(top, columns)]
        joined = [
            e
            for c in columns
            for e in _merged(_state(top, c), _state(f"far{k}", c), _state(top, c))
        ]
        out = out.select(*others, *joined)
    results = []
    for c in columns:
        state = _state(top, c)
        std = f"sqrt(CASE WHEN `{state['n']}` > 1 THEN `{state['dev']}` / (`{state['n']}` - 1) END)"
        results += [
            F.col(state["n"]).alias(f"{prefix}{c}_n"),
            F.col(state["mean"]).alias(f"{prefix}{c}_mean"),
            F.expr(std).alias(f"{prefix}{c}_std"),
        ]
    return out.select(*given, *results)


def _names(level: int, columns: Sequence[str]) -> set[str]:
    return {name for c in columns for name in _state(level, c).values()}
