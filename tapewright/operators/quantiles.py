"""Quantiles per group without gathering a group in one task: exact ones, and from sketches."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.operators.joins import join_lookup
from tapewright.operators.slicing import axis_slice, sampled_borders
from tapewright.session import materialize

_PIECE, _ROWS, _START = "__piece", "__rows", "__start"


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    ranks: Sequence[float],
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row per group with its columns and ``quantiles``, an array aligned with ``ranks``.

    Quantiles interpolate linearly between neighbours. Spark's ``percentile`` keeps all distinct
    values of a group in one buffer, so it serves only while the largest group, which is counted
    first, stays below ``quantile_rows``. Larger groups are ranked piece by piece, with the same
    result. Null values are ignored, and so are rows without a group.
    """
    present = df.select(*group, F.col(value).alias("value")).dropna()
    counts = present.groupBy(*group).agg(F.count("*").alias(_ROWS))
    measured = counts.agg(F.max(_ROWS).alias("largest"), F.sum(_ROWS).alias("rows")).first()
    if (measured["largest"] or 0) <= settings.quantile_rows:
        wanted = F.array(*[F.lit(float(r)) for r in ranks])
        return present.groupBy(*group).agg(F.percentile("value", wanted).alias("quantiles"))
    return _piecewise_quantiles(present, group, ranks, measured["rows"], settings)


def _piecewise_quantiles(
    present: DataFrame, group: Sequence[str], ranks: Sequence[float], rows: int, settings: Settings
) -> DataFrame:
    """Cut the value axis into pieces, find the pieces that hold the wanted ranks, search there.

    Equal values are collapsed to one counted row by partial aggregation, so a value shared by
    most rows is as cheap as any other; what is sorted is one piece's distinct values.
    """
    pieces = max(2, math.ceil(rows / settings.quantile_rows))
    sampled = sampled_borders(present, "value", rows, pieces, settings.slice_sample_rows)
    cut = axis_slice(present, "value", sorted(set(sampled)), _PIECE)

    in_order = Window.partitionBy(*group).orderBy(_PIECE)
    starts = (
        cut.groupBy(*group, _PIECE)
        .agg(F.count("*").alias(_ROWS))
        .withColumn(_START, F.sum(_ROWS).over(in_order) - F.col(_ROWS))
        .withColumn("__total", F.sum(_ROWS).over(Window.partitionBy(*group)))
    )
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("slot"),
                ((F.col("__total") - 1) * F.lit(float(rank))).alias("at"),
            )
            for i, rank in enumerate(ranks)
        ]
    )
    # Two order statistics per rank, each wanted from exactly one piece.
    wanted = (
        starts.select(*group, _PIECE, _START, _ROWS, F.explode(targets).alias("target"))
        .select(
            *group, _PIECE, _START, _ROWS, "target.slot", "target.at",
            F.explode(
                F.array_distinct(F.array(F.floor("target.at"), F.ceil("target.at")))
            ).alias("index"),
        )
        .filter(
            (F.col("index") >= F.col(_START)) & (F.col("index") < F.col(_START) + F.col(_ROWS))
        )
    )
    wanted = materialize(wanted, "quantile-ranks")
    searched = wanted.select(*group, _PIECE).distinct()
    inside = Window.partitionBy(*group, _PIECE).orderBy("value")
    ranked = (
        join_lookup(cut, searched, [*group, _PIECE], settings, "left_semi", written=True)
        .groupBy(*group, _PIECE, "value")
        .agg(F.count("*").alias("__same"))
        .withColumn("__until", F.sum("__same").over(inside))
    )
    offset = F.col("index") - F.col(_START)
    hit = (offset >= F.col("__until") - F.col("__same")) & (offset < F.col("__until"))
    found = ranked.join(wanted, [*group, _PIECE]).filter(hit)
    fraction = F.col("at") - F.floor("at")
    weight = F.when(F.col("index") == F.floor("at"), 1 - fraction).otherwise(fraction)
    per_rank = found.groupBy(*group, "slot").agg(F.sum(F.col("value") * weight).alias("value"))
    return per_rank.groupBy(*group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("slot", "value"))), lambda pair: pair["value"]
        ).alias("quantiles")
    )


# --- sketches ----------------------------------------------------------------------------------

# Rank error of a KLL sketch of size k, at 99 % confidence, is ERROR / k ** POWER; and
# the sizes that it can have.
ERROR, POWER = 2.296, 0.9021
SIZES = (8, 65_535)


def sketch_size(rank_error: float) -> int:
    """The least size of a sketch whose quantiles are off by ``rank_error`` of all ranks at most."""
    size = math.ceil((ERROR / rank_error) ** (1 / POWER))
    if size > SIZES[1]:
        raise ValueError(f"No sketch has a rank error of {rank_error}; the least is {ERROR / SIZES[1] ** POWER:.1e}")
    return max(size, SIZES[0])


def quantile_sketches(df: DataFrame, group: Sequence[str], value: str, rank_error: float) -> DataFrame:
    """One row per group with a ``sketch`` of its values: a few kilobytes, whatever the group's size.

    Sketches are filled where rows lie and merged, so one small row per task and group is shuffled.
    They can be kept and merged later (``merged_sketches``), say one per day.
    """
    present = df.select(*group, F.col(value).cast("double").alias("value")).dropna()
    return present.groupBy(*group).agg(F.kll_sketch_agg_double("value", F.lit(sketch_size(rank_error))).alias("sketch"))


def merged_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """One sketch per group from several: that of all their values."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, group: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """As ``exact_quantiles``, from sketches; the values are ones that occur."""
    wanted = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))) for r in ranks]
    return sketches.select(*group, F.array(*wanted).alias("quantiles"))
