"""Queries over documents and forest scores whose answers are exact, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewright.functions.times import as_instant, as_wall_clock
from tapewright.operators import forest, payload, rolling
from tapewright.operators.fragments import Part, read_fragments, write_fragments
from tapewright.plans.catalogue import HOURLY, Query, hourly, joined_symbols, rounded, stream_session, valid
from tapewright.plans.oracle import ORACLE, VALID
from tapewright.schemas import FOREST_SCORED_TRADE
from tapewright.session import materialize, scratch_path
from tapewright.sources.streams import table_stream
from tapewright.streaming.scoring import read_live_scores, start_live_scores

DOCUMENTS: dict[str, Query] = {}
DOCUMENTS_SQL: dict[str, str] = {}
#: What each list's items have for symbol, time, price, quantity, value and reason.
_SHAPES = {
    "price_series": ("symbol", "time", "price", "quantity", "trade_value", None),
    "aggregates": ("symbol", None, "avg_price", "volume", "max_trade_value", None),
    "anomalies": ("symbol", "detected_at", "price", "quantity", "trade_value", "reason"),
}
#: Times at which one delivery of live trades ends and the next one begins.
DELIVERIES = ("1970-01-01", "2024-01-10", "2024-01-20", "9000-01-01")
_SUMMARY = ("symbols", "time_start", "avg_trade_value", "total_records", "anomaly_count", "source")


def query(function: Query) -> Query:
    DOCUMENTS[function.__name__] = function
    return function


def _even(rows: DataFrame, name: str, shape) -> DataFrame:
    kinds = ("string", "string", "double", "double", "double", "string")
    names = ("symbol", "time", "price", "quantity", "trade_value", "reason")
    picked = [(F.lit(None) if c is None else F.col(c)).cast(k).alias(n) for c, k, n in zip(shape, kinds, names)]
    return rows.select(F.lit(name).alias("part"), *picked)


def document_rows(summary: DataFrame, parts: dict[str, Part]) -> DataFrame:
    """The document's summary and lists as rows, the lists read back from their written fragments."""
    spark = summary.sparkSession
    directory = scratch_path(spark, "document")
    shown = spark.createDataFrame([payload.summary_row(summary)], ", ".join(
        f"{f.name} {'string' if f.name in ('time_start', 'time_end') else f.dataType.simpleString()}" for f in summary.schema
    ))
    out = _even(joined_symbols(shown), "summary", _SUMMARY)
    for name, shape in _SHAPES.items():
        write_fragments(parts[name], name, directory)
        items = read_fragments(spark, directory, name, parts[name].item_type())
        out = out.unionByName(_even(items, name, shape))
    return rounded(out)


def _rows_sql(**texts: str) -> str:
    """The same rows from the SQL of the single reports."""
    parts = []
    for name, text in texts.items():
        symbol, time, price, quantity, value, reason = _SUMMARY if name == "summary" else _SHAPES[name]
        when = f"strftime({time}, '%Y-%m-%dT%H:%M:%S.%f')" if time else "NULL::VARCHAR"
        numbers = ", ".join(
            f"round({c}::DOUBLE, 6) + 0.0 AS {n}" for c, n in ((price, "price"), (quantity, "quantity"), (value, "trade_value"))
        )
        parts.append(
            f"SELECT '{name}' AS part, {symbol} AS symbol, {when} AS time, {numbers}, {reason or 'NULL::VARCHAR'} AS reason FROM ({text})"
        )
    return "\nUNION ALL\n".join(parts)


@query
def dashboard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch document item by item; its forest list has no exact answer and is left out."""
    trades = valid(spark, sf_dir)
    zscores = materialize(rolling.rolling_zscore(trades), "document-zscores")
    unscored = spark.createDataFrame([], FOREST_SCORED_TRADE)
    return document_rows(*payload.batch_parts(trades, zscores, unscored))


DOCUMENTS_SQL["dashboard_rows"] = _rows_sql(
    summary=ORACLE["batch_summary"], price_series=ORACLE["price_series_sampled"],
    aggregates=ORACLE["batch_symbol_aggregates"], anomalies=ORACLE["zscore_anomaly_history"],
)


@query
def stream_dashboard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document over window rows item by item."""
    rows = materialize(hourly(spark, sf_dir), "document-windows")
    return document_rows(*payload.stream_parts(rows, spark.createDataFrame([], FOREST_SCORED_TRADE), HOURLY))


DOCUMENTS_SQL["stream_dashboard_rows"] = _rows_sql(
    summary=ORACLE["stream_summary"], price_series=ORACLE["stream_price_series"],
    aggregates=ORACLE["stream_symbol_aggregates"], anomalies=ORACLE["stream_anomaly_history"],
)


# --- forest ------------------------------------------------------------------------------------


def _with_rare_symbols(trades: DataFrame) -> DataFrame:
    """Every two-hundredth trade under a symbol of its own kind, so that some symbols are small."""
    rare = F.concat(F.lit("rare-"), "symbol")
    return trades.withColumn("symbol", F.when(F.col("trade_id") % 200 == 0, rare).otherwise(F.col("symbol")))


@query
def iforest_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has an exact answer in the forest's output: how many are scored and flagged per symbol."""
    scored = forest.iforest_scores(_with_rare_symbols(valid(spark, sf_dir)))
    return scored.groupBy("symbol").agg(
        F.count("*").alias("trades"),
        F.count("ml_model").alias("scored"),
        F.count_if("is_ml_anomaly").alias("flagged"),
        F.count_if(F.col("ml_anomaly_score") == 0).alias("unscored"),
        F.bool_and(F.col("is_ml_anomaly") == (F.col("ml_anomaly_score") > 0)).alias("flags_follow_scores"),
    )


DOCUMENTS_SQL["iforest_flag_counts"] = f"""WITH {VALID},
n AS (
  SELECT CASE WHEN trade_id % 200 = 0 THEN 'rare-' || symbol ELSE symbol END AS symbol, count(*) AS trades
  FROM t GROUP BY ALL
)
SELECT symbol, trades, CASE WHEN trades >= 20 THEN trades ELSE 0 END AS scored,
       CASE WHEN trades >= 20 THEN trades - 1 - CAST(floor((trades - 1) * 0.98) AS BIGINT) ELSE 0 END AS flagged,
       CASE WHEN trades >= 20 THEN CASE WHEN (trades - 1) % 50 = 0 THEN 1 ELSE 0 END ELSE trades END AS unscored,
       true AS flags_follow_scores
FROM n"""


@query
def live_forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades scored live by a kept forest, and whether a batch run gives them the same score."""
    given = valid(spark, sf_dir)
    model_path, inbox, out = (scratch_path(spark, n) for n in ("forest-model", "live-inbox", "live-scores"))
    model, batch = forest.fit_and_score(given)
    forest.save_model(model, model_path)
    session = stream_session(spark)
    instants = as_instant(given, "trade_time")
    for first, last in zip(DELIVERIES, DELIVERIES[1:]):  # as they would arrive; the job starts anew for each
        between = (F.col("trade_time") >= F.lit(first).cast("timestamp_ntz")) & (F.col("trade_time") < F.lit(last).cast("timestamp_ntz"))
        as_instant(given.where(between), "trade_time").write.mode("append").parquet(inbox)
        stream = table_stream(session, inbox, instants.schema)
        start_live_scores(stream, model_path, out, f"{out}-checkpoint", available_now=True).awaitTermination()
    live = as_wall_clock(read_live_scores(spark, out), "trade_time").select("symbol", "trade_id", "trade_time", "ml_anomaly_score", "is_ml_anomaly")
    batch = batch.select("trade_id", F.col("ml_anomaly_score").alias("score"), F.col("is_ml_anomaly").alias("flag"))
    same = (F.abs(F.col("score") - F.col("ml_anomaly_score")) < 1e-9) & (F.col("flag") == F.col("is_ml_anomaly"))
    return live.join(batch, "trade_id", "left").select("symbol", "trade_id", "trade_time", F.coalesce(same, F.lit(False)).alias("as_in_batch"))


DOCUMENTS_SQL["live_forest_scores"] = f"WITH {VALID} SELECT symbol, trade_id, trade_time, true AS as_in_batch FROM t"
