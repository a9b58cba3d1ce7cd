import json
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at, trade, trades_df
from tapewright.config import DEFAULTS
from tapewright.operators import reports
from tapewright.operators.payload import batch_payload, stream_payload
from tapewright.operators.rolling import rolling_zscore
from tapewright.operators.windows import window_aggregates
from tapewright.schemas import FOREST_SCORED_TRADE, TRADE, WINDOW_AGGREGATE, ZSCORED_TRADE


@pytest.fixture(scope="module")
def trades(spark):
    rows = [trade("A", i, 10.0 + i % 7, 1.0 + i % 3, i * 400) for i in range(60)]
    rows += [trade("B", 100 + i, 5.0 * i, 2.0, i * 500) for i in range(1, 30)]
    rows.append(trade("A", 999, 90.0, 1.0, None))
    return trades_df(spark, rows).cache()


def forest_rows(spark, rows=()):
    names = FOREST_SCORED_TRADE.fieldNames()
    made = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(made, FOREST_SCORED_TRADE)


def column(df, name):
    return [r[name] for r in df.collect() if r[name] is not None]


def test_counts(trades):
    counts = {r["symbol"]: r["trade_count"] for r in reports.trade_count_by_symbol(trades).collect()}
    assert counts == {"A": 61, "B": 29}
    hours = {r["hour"]: r["trade_count"] for r in reports.trade_count_by_hour(trades).collect()}
    assert sum(hours.values()) == 89 and None not in hours and hours[0] == 9 + 7


def test_histogram_equals_numpy(trades):
    rows = reports.trade_value_histogram(trades).orderBy("bin").collect()
    counts, edges = np.histogram(column(trades, "trade_value"), bins=50)
    assert [r["trade_count"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1])
    assert [r["bin_end"] for r in rows] == pytest.approx(edges[1:])


def test_histogram_of_one_value(spark):
    same = trades_df(spark, [trade("A", i, 4.0, 2.0) for i in range(5)])
    rows = reports.trade_value_histogram(same).orderBy("bin").collect()
    counts, edges = np.histogram([8.0] * 5, bins=50)
    assert [r["trade_count"] for r in rows] == counts.tolist()
    assert rows[0]["bin_start"] == edges[0] == 7.5


def test_box_stats(trades):
    stats = reports.price_box_stats(trades)
    row = stats.filter("symbol = 'A'").first()
    prices = column(trades.filter("symbol = 'A'"), "price")
    q1, q2, q3 = np.percentile(prices, [25, 50, 75])
    inside = [p for p in prices if q1 - 1.5 * (q3 - q1) <= p <= q3 + 1.5 * (q3 - q1)]
    assert (row["q1"], row["median"], row["q3"]) == (q1, q2, q3)
    assert (row["whisker_low"], row["whisker_high"]) == (min(inside), max(inside))
    assert row["outlier_count"] == 1
    assert column(reports.price_outliers(trades, stats), "trade_id") == [999]


def test_summary(trades):
    row = reports.trade_summary(trades).first()
    assert row["symbols"] == ["A", "B"] and row["total_records"] == 90
    assert row["median_price"] == statistics.median(column(trades, "price"))
    assert row["time_start"] == at(0)


def test_chart_bounds(trades):
    rows = {r["symbol"]: r for r in reports.series_bounds(trades).collect()}
    assert (rows["A"]["low"], rows["A"]["high"]) == (2.0, 98.0)
    flat = reports.series_bounds(trades.filter("trade_id = 999")).first()
    assert (flat["low"], flat["high"]) == (89.0, 91.0)


def test_histories_and_limits(spark):
    rows = [
        ("A", i, 1.0, 1.0, at(i), 1.0, float(i), -float(i) / 2, True) for i in range(3, 80)
    ] + [("A", 500, 1.0, 1.0, at(0), 1.0, 99.0, 0.0, False)]
    scored = spark.createDataFrame(rows, ZSCORED_TRADE)
    top = reports.top_zscore_anomalies(scored).collect()
    assert [r["price_zscore"] for r in top] == [float(i) for i in range(79, 69, -1)]
    history = reports.zscore_anomaly_history(scored).collect()
    assert len(history) == 50
    assert history[0]["reason"] == "price_zscore, trade_value_zscore"
    loose = DEFAULTS.with_options(z_threshold=1000.0)
    assert reports.zscore_anomaly_history(scored, loose).first()["reason"] == "score_threshold"


def windows_of(trades):
    loose = DEFAULTS.with_options(window_seconds=3600, large_trade_value=60.0)
    return window_aggregates(trades.filter("trade_time is not null"), loose)


def test_empty_reason_from_a_table_falls_back(trades):
    blank = windows_of(trades).withColumn("anomaly_reason", F.lit(None).cast("string"))
    reasons = {r["reason"] for r in reports.stream_anomaly_history(blank).collect()}
    assert reasons == {"stream_rule"}


def test_batch_document(spark, trades):
    flagged = {
        "symbol": "A", "trade_id": 1, "price": 2.0, "quantity": 3.0, "trade_time": at(5),
        "trade_value": 6.0, "ml_anomaly_score": 0.25, "is_ml_anomaly": True, "ml_model": None,
    }
    small = DEFAULTS.with_options(payload_series_points=10)
    document = batch_payload(trades, rolling_zscore(trades), forest_rows(spark, [flagged]), small)
    assert document.count() == 1
    made = json.loads(document.first()["payload"])
    assert list(made) == ["summary", "price_series", "aggregates", "anomalies", "ml_anomalies"]
    assert made["summary"]["source"] == "cleaned_batch"
    assert made["summary"]["symbols"] == ["A", "B"]
    assert made["summary"]["time_start"] == "2024-03-01T00:00:00.000000"
    assert made["summary"]["ml_anomaly_count"] == 1
    assert [a["symbol"] for a in made["aggregates"]] == ["A", "B"]
    series = [p for p in made["price_series"] if p["symbol"] == "B"]
    assert 10 <= len(series) < 20
    assert [p["time"] for p in series] == sorted(p["time"] for p in series)
    assert made["ml_anomalies"] == [
        {
            "detected_at": "2024-03-01T00:00:05.000000", "symbol": "A", "price": 2.0,
            "quantity": 3.0, "trade_value": 6.0, "ml_anomaly_score": 0.25,
            "model": "IsolationForest", "reason": "isolation_forest",
        }
    ]


def test_empty_document(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    document = batch_payload(
        empty(TRADE), empty(ZSCORED_TRADE), empty(FOREST_SCORED_TRADE)
    )
    made = json.loads(document.first()["payload"])
    assert made["summary"] == {
        "source": "empty", "total_records": 0, "symbols": [], "time_start": None,
        "time_end": None, "avg_trade_value": 0.0, "anomaly_count": 0, "ml_anomaly_count": 0,
    }
    assert all(made[k] == [] for k in ("price_series", "aggregates", "anomalies", "ml_anomalies"))


def test_stream_document(spark, trades):
    windows = windows_of(trades)
    made = json.loads(stream_payload(windows, forest_rows(spark)).first()["payload"])
    assert made["summary"]["source"] == "spark_stream"
    assert made["summary"]["total_records"] == 89
    assert made["summary"]["anomaly_count"] == len(made["anomalies"])
    times = [a["detected_at"] for a in made["anomalies"]]
    assert times == sorted(times, reverse=True)
    assert all(a["price_zscore"] == 0.0 for a in made["anomalies"])
    assert len(made["price_series"]) == windows.count()


def test_empty_stream_summary(spark):
    row = reports.stream_summary(spark.createDataFrame([], WINDOW_AGGREGATE)).first()
    assert (row["total_records"], row["avg_trade_value"], row["symbols"]) == (0, 0.0, [])
