"""Ordered per-symbol computations that stay parallel when a few symbols hold most rows.

``Window.partitionBy("symbol")`` puts a whole symbol into one task. Symbols with more rows than
``rows_per_slice`` are therefore cut into contiguous slices of their time order, and windows run
per (symbol, slice). What a slice cannot know about its predecessors is added exactly:

* bounded frames (rolling means, lag): the first rows of each slice are computed again on the
  slice ends alone, a few hundred rows per slice (``over_slices``);
* running positions: each slice starts at the summed sizes of the slices before it
  (``with_position``).

Slice borders come from quantiles of a sample; they only balance the work. A slice id depends on
nothing but the row and the borders, so a lost task recomputes the same slices. There are as many
slices as rows fill, without a limit: tasks search a row's slice in a sorted array (8 bytes per
``rows_per_slice`` rows, 4 MB for two trillion rows), and hot symbols are a table to join with.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.times import utc_micros
from tapewright.operators.joins import join_lookup

SLICE = "__slice"
POSITION = "__position"
TIE = "__tie"
_TIME_AXIS, _ID_AXIS = "__time_axis", "__id_axis"
_TIME_SLICE, _ID_SLICE = "__time_slice", "__id_slice"
_HOT, _HOT_TIME, _SYMBOL_KEY = "__hot", "__hot_time", "__symbol_key"
_SAMPLE_TASK_ROWS = 1_000_000
_LAST = 9.0e18  # axis value of a missing time or id: they sort last


def axis_slice(df: DataFrame, axis: str, borders: list[float], out: str) -> DataFrame:
    """Add ``out``: how many of the sorted, distinct ``borders`` are <= the ``axis`` value."""
    splits = [float("-inf"), *borders, float("inf")]
    if not borders:
        return df.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=axis, outputCol=out).transform(df)


def sampled_borders(df: DataFrame, axis: str, rows: int, pieces: int, per_piece: int) -> list[float]:
    """About ``pieces`` - 1 quantiles of ``axis`` from a sample of ``per_piece`` rows per piece.

    The sample is sorted by range, so that no task ranks more than about a million of its rows.
    """
    if pieces < 2:
        return []
    fraction = min(1.0, pieces * per_piece / max(rows, 1))
    sample = df.select(axis) if fraction >= 1.0 else df.select(axis).sample(fraction, seed=17)
    step = max(1, min(per_piece, rows // pieces))
    tasks = -(-min(rows, pieces * per_piece) // _SAMPLE_TASK_ROWS)
    in_order = sample.repartitionByRange(max(1, tasks), axis).sortWithinPartitions(axis)
    # The lower 33 bits of this id count the rows of a task.
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = in_order.withColumn("__rank", nth)
    borders = ranked.filter(F.col("__rank") % step == 0).select(axis).toPandas()[axis]
    return sorted(borders)


def _symbol_key() -> Column:
    """Text that differs for different symbols; a missing symbol is a symbol like any other."""
    return F.coalesce(F.concat(F.lit("="), F.col("symbol")), F.lit(""))


def mark_hot(trades: DataFrame, symbols: tuple[str | None, ...], settings: Settings = DEFAULTS) -> DataFrame:
    """Add whether a trade's symbol is one of ``symbols``, at most one per ``rows_per_slice`` rows."""
    keys = [("" if s is None else "=" + s, True) for s in symbols]
    table = trades.sparkSession.createDataFrame(keys, f"{_SYMBOL_KEY} string, {_HOT} boolean")
    marked = join_lookup(
        trades.withColumn(_SYMBOL_KEY, _symbol_key()), table, [_SYMBOL_KEY], settings, "left", written=True
    )
    return marked.withColumn(_HOT, F.coalesce(F.col(_HOT), F.lit(False))).drop(_SYMBOL_KEY)


def hot_intervals(times: list[float]) -> list[float]:
    """Borders, sorted: from an odd number of them on, an axis value is one of the ``times``."""
    ends: list[float] = []
    for t in sorted(times):
        if ends and ends[-1] == t:
            ends.pop()
        else:
            ends.append(t)
        if t < _LAST:
            ends.append(next_micro(t))
    return ends


@dataclass(frozen=True)
class Slices:
    """Borders for one table: which symbols are cut, and where."""

    hot_symbols: tuple[str | None, ...]
    time_borders: tuple[float, ...]
    id_borders: tuple[float, ...]
    hot_times: tuple[float, ...]

    def assign(self, trades: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
        """Add the slice number and ``__hot``; slices follow the (time, id) order inside each symbol."""
        if not self.hot_symbols:
            return trades.withColumns({SLICE: F.lit(0).cast("bigint"), _HOT: F.lit(False)})
        cut = axis_slice(_with_axes(mark_hot(trades, self.hot_symbols, settings)), _TIME_AXIS, list(self.time_borders), _TIME_SLICE)
        cut = axis_slice(cut, _ID_AXIS, list(self.id_borders), _ID_SLICE)
        cut = axis_slice(cut, _TIME_AXIS, hot_intervals(list(self.hot_times)), _HOT_TIME)
        width = len(self.id_borders) + 1
        number = F.col(_TIME_SLICE) * width + F.when(F.col(_HOT_TIME) % 2 == 1, F.col(_ID_SLICE)).otherwise(0.0)
        sliced = cut.withColumn(SLICE, F.when(F.col(_HOT), number).otherwise(0.0).cast("bigint"))
        return sliced.drop(_TIME_AXIS, _ID_AXIS, _TIME_SLICE, _ID_SLICE, _HOT_TIME)


def _with_axes(trades: DataFrame) -> DataFrame:
    micros = utc_micros(trades, "trade_time").cast("double")
    return trades.withColumns(
        {
            _TIME_AXIS: F.coalesce(micros, F.lit(_LAST)),
            _ID_AXIS: F.coalesce(F.col("trade_id").cast("double"), F.lit(_LAST)),
        }
    )


def plan_slices(trades: DataFrame, settings: Settings = DEFAULTS) -> Slices:
    """Measure the table and decide the cuts.

    Reads two or three key columns. A symbol is cut if it has more than ``rows_per_slice`` rows.
    What reaches the driver is at most one symbol, and about one border per axis, for so many rows.
    """
    counts = trades.groupBy("symbol").agg(F.count("*").alias("rows"))
    hot = counts.filter(F.col("rows") > settings.rows_per_slice).collect()
    if not hot:
        return Slices((), (), (), ())
    symbols = tuple(sorted((row["symbol"] for row in hot), key=lambda s: (s is not None, s or "")))
    rows = sum(row["rows"] for row in hot)
    pieces = -(-rows // settings.rows_per_slice)
    keys = mark_hot(trades.select("symbol", "trade_time", "trade_id"), symbols, settings)
    keys = _with_axes(keys.filter(F.col(_HOT)))
    sampled = sampled_borders(keys, _TIME_AXIS, rows, pieces, settings.slice_sample_rows)
    # A time that fills a whole slice repeats among the quantiles: cut it by id instead.
    hot_times = sorted({a for a, b in zip(sampled, sampled[1:]) if a == b})
    borders = sorted({*sampled, *(next_micro(t) for t in hot_times)})
    id_borders: list[float] = []
    if hot_times:
        crowded = axis_slice(keys, _TIME_AXIS, hot_intervals(hot_times), _HOT_TIME)
        crowded = crowded.filter(F.col(_HOT_TIME) % 2 == 1)
        id_borders = sampled_borders(crowded, _ID_AXIS, rows, pieces, settings.slice_sample_rows)
    return Slices(symbols, tuple(borders), tuple(sorted(set(id_borders))), tuple(hot_times))


def next_micro(axis_value: float) -> float:
    """The next value on the time axis, whose unit is one microsecond."""
    return axis_value + 1.0 if axis_value < _LAST else axis_value


def series_window(*extra: str, tie: str | None = None):
    """Time order of a symbol, missing times and ids last, ties broken by id, then by ``tie``."""
    last = [F.col(tie)] if tie else []
    return Window.partitionBy("symbol", *extra).orderBy(
        F.asc_nulls_last("trade_time"), F.asc_nulls_last("trade_id"), *last
    )


def with_tie(trades: DataFrame) -> DataFrame:
    """Add a hash of all columns, so that every reader of a cut series sees one and the same order."""
    return trades.withColumn(TIE, F.xxhash64(*trades.columns))


def over_slices(
    trades: DataFrame,
    slices: Slices,
    reach: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
) -> DataFrame:
    """Add window columns whose frames look back at most ``reach`` rows.

    ``add`` appends columns to a table, given a window ordered in time. The table is shuffled
    once, on (symbol, slice); results equal those of one window per symbol.
    """
    if not slices.hot_symbols:
        return add(trades, series_window())
    window = series_window(SLICE, tie=TIE)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = slices.assign(with_tie(trades)).withColumns(
        {POSITION: F.row_number().over(window), "__size": F.count("*").over(whole)}
    )
    is_head = F.col(_HOT) & (F.col(POSITION) <= reach)
    inside = add(numbered, window).filter(~is_head)
    # Rows next to a border, per symbol in order: for a slice's first rows, the rows just before
    # them are here without gaps, also across slices shorter than the reach.
    borders = numbered.filter(
        F.col(_HOT)
        & ((F.col(POSITION) <= reach) | (F.col(POSITION) > F.col("__size") - reach))
    )
    along = Window.partitionBy("symbol").orderBy(SLICE, POSITION)
    heads = add(borders, along).filter(F.col(POSITION) <= reach)
    helpers = (SLICE, POSITION, TIE, _HOT, "__size")
    return inside.drop(*helpers).unionByName(heads.drop(*helpers))


def with_position(trades: DataFrame, slices: Slices, total: str | None = None) -> DataFrame:
    """Add the 1-based position of each trade in its symbol's time order.

    With ``total``, also add the symbol's row count under that name.
    """
    wanted = [*trades.columns, POSITION] + ([total] if total else [])
    if not slices.hot_symbols:
        whole = Window.partitionBy("symbol")
        placed = trades.withColumn(POSITION, F.row_number().over(series_window()))
        return placed.withColumn(total, F.count("*").over(whole)) if total else placed
    sized = slices.assign(with_tie(trades))
    sizes = sized.groupBy("symbol", SLICE).agg(F.count("*").alias("__size"))
    before = Window.partitionBy("symbol").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("symbol").alias("__of_symbol"),
        F.col(SLICE).alias("__of_slice"),
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
        F.sum("__size").over(Window.partitionBy("symbol")).alias(total or "__total"),
    )
    inside = sized.withColumn("__rank", F.row_number().over(series_window(SLICE, tie=TIE)))
    own = F.col("symbol").eqNullSafe(F.col("__of_symbol")) & (F.col(SLICE) == F.col("__of_slice"))
    placed = inside.join(offsets, own).withColumn(
        POSITION, F.col("__rank") + F.col("__before")
    )
    return placed.select(*wanted)
