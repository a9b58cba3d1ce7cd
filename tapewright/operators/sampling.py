"""Every-n-th thinning of long series for charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.operators.slicing import POSITION, Slices, plan_slices, with_position


def thin_series(
    trades: DataFrame, points: int, settings: Settings = DEFAULTS, slices: Slices | None = None
) -> DataFrame:
    """Keep every (n div ``points``)-th trade of each symbol with more than ``points`` trades.

    A long series keeps at least ``points`` and fewer than twice as many rows; short ones stay.
    """
    slices = plan_slices(trades, settings) if slices is None else slices
    placed = with_position(trades, slices, total="__rows")
    step = F.greatest(F.lit(1), F.expr(f"`__rows` div {points}"))
    return placed.filter((F.col(POSITION) - 1) % step == 0).select(*trades.columns)
