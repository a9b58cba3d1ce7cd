"""The batch jobs, alone and chained."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.config import DEFAULTS, Settings
from tapewright.operators import reports
from tapewright.operators.clean import clean_trades, cleaning_report, in_time_order, symbol_filter
from tapewright.operators.forest import iforest_scores
from tapewright.operators.parse import compact_json
from tapewright.operators.fragments import Part, write_document
from tapewright.operators.payload import batch_parts, one_row, stream_parts, summary_row
from tapewright.operators.rolling import rolling_zscore
from tapewright.session import scratch_path
from tapewright.schemas import FOREST_SCORED_TRADE, TRADE, WINDOW_AGGREGATE, ZSCORED_TRADE
from tapewright.sources.files import (
    read_optional,
    read_raw_trades,
    read_stream_aggregates,
    read_table,
    required_input,
    latest_input,
)
from tapewright.sources.generate import as_compact, synthetic_trades, with_bad_records
from tapewright.sources.storage import write_snapshot
from tapewright.streaming.sinks import write_lines, write_table

# Names of the produced tables, and the patterns that find them again.
STAMP = "%Y%m%d_%H%M%S"
RAW_PREFIX, RAW_PATTERN = "trades_", "trades_*.json"
CLEANED_PREFIX, CLEANED_PATTERN = "cleaned_trades_", "cleaned_trades_*"
ZSCORES_NAME = "latest_trade_anomaly_scores"
FOREST_NAME = "latest_ml_anomaly_scores"
PAYLOAD_NAME = "dashboard_data"
DEFAULT_SYMBOLS = "BTCUSD,ETHUSD"


@dataclass(frozen=True)
class Layout:
    """Where the jobs find and leave their tables; any path Spark can reach."""

    raw: str = "data/raw"
    cleaned: str = "data/cleaned"
    scores: str = "data/anomalies"
    windows: str = "data/stream/aggregates_csv"
    charts: str = "output"
    dashboard: str = "dashboard/data"

    @property
    def zscores(self) -> str:
        return f"{self.scores}/{ZSCORES_NAME}"

    @property
    def forest(self) -> str:
        return f"{self.scores}/{FOREST_NAME}"


def stamped(prefix: str, suffix: str = "") -> str:
    return f"{prefix}{dt.datetime.now().strftime(STAMP)}{suffix}"


def _suffix(form: str) -> str:
    return ".csv" if form == "csv" else ""


def generate_job(spark: SparkSession, layout: Layout = Layout(), per_symbol: int = 2000) -> str:
    """Write generated compact records, faulty copies included, as JSON lines."""
    records = with_bad_records(as_compact(synthetic_trades(spark, per_symbol)))
    path = f"{layout.raw}/{stamped(RAW_PREFIX, '.json')}"
    return write_lines(records.select(compact_json(records).alias("value")), path)


def clean_job(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    raw: str | None = None, form: str = "parquet",
) -> str:
    """Clean the given or newest raw input into a new time-ordered table; returns its path."""
    source = raw or required_input(spark, layout.raw, RAW_PATTERN)
    trades = clean_trades(read_raw_trades(spark, source), settings)
    path = f"{layout.cleaned}/{stamped(CLEANED_PREFIX, _suffix(form))}"
    return write_table(in_time_order(trades), path, form, mode="errorifexists")


def report_job(spark: SparkSession, raw: str, settings: Settings = DEFAULTS) -> DataFrame:
    return cleaning_report(read_raw_trades(spark, raw), settings)


def _cleaned(spark: SparkSession, layout: Layout, cleaned: str | None) -> DataFrame:
    path = cleaned or required_input(spark, layout.cleaned, CLEANED_PATTERN)
    return read_table(spark, path, TRADE)


def zscore_job(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    cleaned: str | None = None, form: str = "parquet",
) -> str:
    scored = rolling_zscore(_cleaned(spark, layout, cleaned), settings)
    return write_snapshot(scored.select(*ZSCORED_TRADE.fieldNames()), layout.zscores, form)


def forest_job(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    cleaned: str | None = None, form: str = "parquet",
) -> str:
    scored = iforest_scores(_cleaned(spark, layout, cleaned), settings)
    return write_snapshot(scored.select(*FOREST_SCORED_TRADE.fieldNames()), layout.forest, form)


def offline_pipeline(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    raw: str | None = None, form: str = "parquet",
) -> dict[str, str]:
    """Clean, then both scorings over the one cleaned table; the first failure ends the run."""
    cleaned = clean_job(spark, layout, settings, raw, form)
    return {
        "cleaned": cleaned,
        "zscores": zscore_job(spark, layout, settings, cleaned, form),
        "forest": forest_job(spark, layout, settings, cleaned, form),
    }


def _write_all(datasets: dict[str, DataFrame], directory: str, form: str) -> dict[str, str]:
    return {
        name: write_table(df, f"{directory}/{name}", form) for name, df in datasets.items()
    }


def batch_report(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    cleaned: str | None = None, form: str = "parquet",
) -> dict[str, str]:
    """Summary and chart datasets of the cleaned trades."""
    trades = _cleaned(spark, layout, cleaned)
    summary = reports.trade_summary(trades, settings)
    boxes = reports.price_box_stats(trades, settings)
    series = reports.price_series_sampled(trades, settings.chart_series_points, settings)
    datasets = {
        "summary": summary.withColumn("symbols", F.array_join("symbols", ",")),
        "price_over_time": series,
        "price_bounds": reports.series_bounds(series),
        "volume_by_symbol": reports.volume_by_symbol(trades),
        "trade_count_by_hour": reports.trade_count_by_hour(trades),
        "trade_value_distribution": reports.trade_value_histogram(trades, settings),
        "price_distribution_by_symbol": boxes,
        "price_outliers": reports.price_outliers(trades, boxes),
        "trade_count_by_symbol": reports.trade_count_by_symbol(trades),
    }
    return _write_all(datasets, layout.charts, form)


def stream_report(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    symbols: str = DEFAULT_SYMBOLS, form: str = "parquet",
) -> dict[str, str]:
    """Chart datasets of the committed window rows of the given symbols."""
    windows = symbol_filter(read_stream_aggregates(spark, layout.windows), symbols)
    series = reports.stream_price_series(windows, settings.chart_series_points, settings)
    datasets = {
        "stream_trade_count_by_hour": reports.stream_count_by_hour(windows),
        "stream_avg_price_over_time": series,
        "stream_volume_over_time": reports.stream_volume_over_time(windows),
        "stream_anomaly_windows": reports.stream_anomaly_counts(windows),
    }
    return _write_all(datasets, layout.charts, form)


def payload_parts(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS
) -> tuple[DataFrame, dict[str, Part]]:
    """What the document holds: from window rows if there are any, else from the batch tables."""
    forest = read_optional(spark, layout.forest, FOREST_SCORED_TRADE)
    try:
        windows = read_stream_aggregates(spark, layout.windows)
    except FileNotFoundError:
        windows = spark.createDataFrame([], WINDOW_AGGREGATE)
    if not windows.isEmpty():
        return stream_parts(windows, forest, settings)
    newest = latest_input(spark, layout.cleaned, CLEANED_PATTERN)
    trades = read_optional(spark, newest, TRADE)
    zscores = read_optional(spark, layout.zscores, ZSCORED_TRADE)
    return batch_parts(trades, zscores, forest, settings)


def payload_document(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS,
    pretty: bool = True,
) -> DataFrame:
    """The document as one row."""
    return one_row(*payload_parts(spark, layout, settings), pretty)


def payload_job(
    spark: SparkSession, layout: Layout = Layout(), settings: Settings = DEFAULTS
) -> str:
    """Write the document as the one file that a page fetches; it is replaced once it is whole."""
    summary, parts = payload_parts(spark, layout, settings)
    path = f"{layout.dashboard}/{PAYLOAD_NAME}.json"
    write_document(spark, summary_row(summary), parts, scratch_path(spark, "document"), path)
    return path
