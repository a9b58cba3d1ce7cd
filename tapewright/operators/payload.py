"""The dashboard document: one JSON row for small tables, sorted fragments for any.

``stream_parts`` and ``batch_parts`` tell what the document holds; ``stream_payload`` and
``batch_payload`` give it as one row, ``fragments.write_document`` as a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.functions.times import iso_text, utc_micros
from tapewright.operators import reports
from tapewright.operators.fragments import Part


def in_time(df: DataFrame, column: str) -> Column:
    """Ascending sort key of a time; missing times come last."""
    return F.coalesce(utc_micros(df, column), F.lit(2**62))


def listed(df: DataFrame, keys: list[Column], time: str | None = None) -> Column:
    """All rows of ``df``, ordered by ``keys``, as an array of structs in a scalar subquery.

    The ``time`` column is written as ISO text.
    """
    item = [
        iso_text(df, c).alias(c) if c == time else F.col(c) for c in df.columns
    ]
    ranked = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], F.struct(*item).alias("item"))
    packed = df.agg(F.array_sort(F.collect_list(ranked)).alias("ranked"))
    return packed.select(F.transform("ranked", lambda entry: entry["item"])).scalar()


def document(summary: DataFrame, parts: dict[str, Column], pretty: bool) -> DataFrame:
    """One row, one column ``payload``, from the one-row summary and the list parts."""
    timed = summary.withColumns(
        {c: iso_text(summary, c) for c in ("time_start", "time_end")}
    )
    whole = F.struct(
        F.struct(*timed.columns).alias("summary"),
        *[part.alias(name) for name, part in parts.items()],
    )
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    return timed.select(F.to_json(whole, options).alias("payload"))


def summary_row(summary: DataFrame) -> dict:
    """The one-row ``summary`` as the document shows it."""
    timed = summary.withColumns({c: iso_text(summary, c) for c in ("time_start", "time_end")})
    return timed.first().asDict()


def forest_part(forest_scored: DataFrame, settings: Settings) -> Part:
    rows = reports.iforest_history(forest_scored, settings)
    return Part(rows, [-F.col("ml_anomaly_score"), in_time(rows, "detected_at"), F.col("symbol")], "detected_at")


def zscore_part(zscored: DataFrame, settings: Settings) -> Part:
    rows = reports.zscore_anomaly_history(zscored, settings)
    return Part(rows, [-reports.zscore_size(), in_time(rows, "detected_at"), F.col("symbol")], "detected_at")


def stream_parts(
    windows: DataFrame, forest_scored: DataFrame, settings: Settings = DEFAULTS
) -> tuple[DataFrame, dict[str, Part]]:
    """Summary and lists over window rows, with the price of every window."""
    series = reports.stream_price_series(windows, settings=settings)
    newest = reports.stream_anomaly_history(windows, settings)
    parts = {
        "price_series": Part(series, [in_time(series, "time"), F.col("symbol")], "time"),
        "aggregates": Part(reports.stream_symbol_aggregates(windows), [F.col("symbol")]),
        "anomalies": Part(newest, [-in_time(newest, "detected_at"), F.col("symbol")], "detected_at"),
        "ml_anomalies": forest_part(forest_scored, settings),
    }
    return reports.stream_summary(windows, forest_scored), parts


def batch_parts(
    trades: DataFrame, zscored: DataFrame, forest_scored: DataFrame, settings: Settings = DEFAULTS
) -> tuple[DataFrame, dict[str, Part]]:
    series = reports.price_series_sampled(trades, settings.payload_series_points, settings)
    parts = {
        "price_series": Part(series, [F.col("symbol"), in_time(series, "time")], "time"),
        "aggregates": Part(reports.batch_symbol_aggregates(trades), [F.col("symbol")]),
        "anomalies": zscore_part(zscored, settings),
        "ml_anomalies": forest_part(forest_scored, settings),
    }
    return reports.batch_summary(trades, zscored, forest_scored), parts


def one_row(summary: DataFrame, parts: dict[str, Part], pretty: bool = True) -> DataFrame:
    return document(summary, {n: listed(p.rows, p.keys, p.time) for n, p in parts.items()}, pretty)


def stream_payload(
    windows: DataFrame, forest_scored: DataFrame, settings: Settings = DEFAULTS,
    pretty: bool = True,
) -> DataFrame:
    """Document over window rows as one row; all of it passes through one task."""
    return one_row(*stream_parts(windows, forest_scored, settings), pretty)


def batch_payload(
    trades: DataFrame, zscored: DataFrame, forest_scored: DataFrame,
    settings: Settings = DEFAULTS, pretty: bool = True,
) -> DataFrame:
    return one_row(*batch_parts(trades, zscored, forest_scored, settings), pretty)
