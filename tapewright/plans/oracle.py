"""DuckDB SQL with the same results as the queries of the catalogue."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT event_type AS symbol, event_id AS trade_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity, ts AS trade_time
  FROM events
)"""

VALID = RAW + """,
t AS (
  SELECT *, price * quantity AS trade_value FROM raw
  WHERE symbol IS NOT NULL AND price > 0 AND price < 1e9 AND quantity > 0 AND quantity < 1e9
)"""

WIRE = """
wire AS (
  SELECT event_type AS symbol, event_id AS trade_id, CAST(value AS VARCHAR) AS price,
         CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR) AS quantity,
         date_trunc('millisecond', ts) AS trade_time
  FROM events
),
faulty AS (
  SELECT CASE WHEN trade_id % 5 = 4 THEN NULL ELSE symbol END AS symbol,
         CASE WHEN trade_id % 5 = 3 THEN (SELECT min(trade_id) FROM wire) ELSE trade_id END
           AS trade_id,
         CASE trade_id % 5 WHEN 0 THEN '' WHEN 2 THEN '0' ELSE price END AS price,
         CASE WHEN trade_id % 5 = 1 THEN '-1' ELSE quantity END AS quantity,
         trade_time
  FROM wire
),
dirty AS (
  SELECT symbol, trade_id, try_cast(price AS DOUBLE) AS price,
         try_cast(quantity AS DOUBLE) AS quantity, trade_time
  FROM (SELECT * FROM wire UNION ALL SELECT * FROM faulty)
)"""

IN_BOUNDS = "price > 0 AND price < 1e9 AND quantity > 0 AND quantity < 1e9"

FIRST_PER_ID = """
row_number() OVER (PARTITION BY trade_id ORDER BY trade_time NULLS LAST, symbol NULLS FIRST,
                   price NULLS FIRST, quantity NULLS FIRST) = 1"""

MESSAGES = """
gaps AS (
  SELECT event_id, ['ticker', 'match', 'last_match', 'heartbeat'][(event_id % 4) + 1] AS kind,
         CASE WHEN event_id % 11 <> 0 THEN upper(event_type) || 'USD' ELSE '' END AS symbol,
         CASE WHEN event_id % 13 <> 0 THEN epoch_us(ts) // 1000 ELSE 1706745600000 END AS event_ms,
         CASE WHEN event_id % 7 <> 0 THEN CAST(value AS VARCHAR) END AS price,
         CASE WHEN event_id % 3 <> 0 THEN json_extract_string(props, '$.k')
              WHEN event_id % 5 <> 0 THEN json_extract_string(props, '$.k') END AS quantity,
         CASE WHEN event_id % 17 <> 0 THEN event_id ELSE 0 END AS trade_id,
         event_id % 2 = 0 AS sell_side
  FROM events
),
compact AS (
  SELECT 'trade' AS kind, event_ms, symbol, trade_id, price, quantity, event_ms AS trade_ms,
         sell_side, 'coinbase' AS source, kind AS channel
  FROM gaps
  WHERE kind <> 'heartbeat' AND price IS NOT NULL AND quantity IS NOT NULL
)"""

HOURLY = VALID + """,
g AS (
  SELECT time_bucket(INTERVAL 1 HOUR, trade_time) AS window_start, symbol,
         avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
         sum(quantity) AS volume, sum(trade_value) AS notional_volume,
         max(trade_value) AS max_trade_value, count(*) AS trade_count
  FROM t WHERE trade_time IS NOT NULL GROUP BY ALL
),
s AS (
  SELECT *, CASE WHEN avg_price > 0 THEN (max_price - min_price) / avg_price * 100 ELSE 0.0 END
    AS price_spread_pct FROM g
),
w AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, symbol, avg_price, min_price,
         max_price, price_spread_pct, volume, notional_volume, max_trade_value, trade_count,
         (price_spread_pct >= 245 OR max_trade_value >= 10000 OR trade_count >= 6) AS is_anomaly,
         concat_ws(',', CASE WHEN price_spread_pct >= 245 THEN 'price_spread' END,
                        CASE WHEN max_trade_value >= 10000 THEN 'large_trade' END,
                        CASE WHEN trade_count >= 6 THEN 'traffic_spike' END) AS anomaly_reason
  FROM s
)"""


def r(column: str, places: int = 6, alias: str | None = None) -> str:
    return f"round({column}, {places}) + 0.0 AS {alias or column}"


WINDOW_COLUMNS = f"""window_start, window_end, symbol, {r('avg_price')}, {r('min_price')},
  {r('max_price')}, {r('price_spread_pct')}, {r('volume')}, {r('notional_volume')},
  {r('max_trade_value')}, trade_count, is_anomaly, anomaly_reason"""

_Z = """round_free AS (
  SELECT *,
    CASE WHEN count(price) OVER f >= 20
      THEN (price - avg(price) OVER f) / nullif(stddev_samp(price) OVER f, 0) END AS pz,
    CASE WHEN count(trade_value) OVER f >= 20
      THEN (trade_value - avg(trade_value) OVER f) / nullif(stddev_samp(trade_value) OVER f, 0)
      END AS vz
  FROM t
  WINDOW f AS (PARTITION BY symbol ORDER BY trade_time NULLS LAST, trade_id NULLS LAST
               ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
),
z AS (
  SELECT symbol, trade_id, price, quantity, trade_time, trade_value,
         coalesce(pz, 0.0) AS price_zscore, coalesce(vz, 0.0) AS trade_value_zscore,
         abs(coalesce(pz, 0.0)) >= 3 OR abs(coalesce(vz, 0.0)) >= 3 AS is_anomaly
  FROM round_free
)"""
ZSCORED = VALID + ",\n" + _Z

FEATURED = VALID + """,
m AS (
  SELECT *, coalesce(price / nullif(lag(price) OVER o, 0) - 1, 0.0) AS price_return,
         CAST(count(trade_id) OVER f AS DOUBLE) AS rolling_trade_count,
         avg(trade_value) OVER f AS rolling_trade_value_mean
  FROM t
  WINDOW o AS (PARTITION BY symbol ORDER BY trade_time NULLS LAST, trade_id NULLS LAST),
         f AS (PARTITION BY symbol ORDER BY trade_time NULLS LAST, trade_id NULLS LAST
               ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)
)"""

FEATURES = (
    "price", "quantity", "trade_value", "price_return", "rolling_trade_count",
    "rolling_trade_value_mean",
)

TRADE_COLUMNS = f"symbol, trade_id, {r('price')}, {r('quantity')}, trade_time, {r('trade_value')}"


def _scaled(name: str) -> str:
    std = f"stddev_pop({name}) OVER (PARTITION BY symbol)"
    mean = f"avg({name}) OVER (PARTITION BY symbol)"
    return f"round(({name} - {mean}) / CASE WHEN {std} = 0 THEN 1 ELSE {std} END, 6) + 0.0 AS {name}"


def _draw(label: str) -> str:
    text = f"concat_ws('|', '42', '{label}', symbol, CAST(n AS VARCHAR))"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


ORACLE: dict[str, str] = {
    "parse_trades": f"""WITH {WIRE}
SELECT symbol, trade_id, try_cast(price AS DOUBLE) AS price,
       try_cast(quantity AS DOUBLE) AS quantity, trade_time FROM wire""",
    "dirty_trades": f"WITH {WIRE} SELECT * FROM dirty",
    "clean_trades": f"""WITH {WIRE}
SELECT symbol, trade_id, price, quantity, trade_time, price * quantity AS trade_value
FROM dirty WHERE symbol IS NOT NULL AND {IN_BOUNDS} QUALIFY {FIRST_PER_ID}""",
    "clean_trades_stream": f"""WITH {WIRE}
SELECT symbol, trade_id, price, quantity, trade_time, price * quantity AS trade_value
FROM dirty WHERE symbol IS NOT NULL AND trade_time IS NOT NULL AND {IN_BOUNDS}""",
    "dedupe_trades": f"WITH {WIRE} SELECT * FROM dirty QUALIFY {FIRST_PER_ID}",
    "cleaning_report": f"""WITH {WIRE},
tagged AS (
  SELECT *, CASE WHEN symbol IS NULL OR price IS NULL OR quantity IS NULL THEN 'null'
                 WHEN NOT ({IN_BOUNDS}) THEN 'invalid' ELSE 'ok' END AS verdict FROM dirty
)
SELECT count(*) AS before_rows, count(*) FILTER (WHERE verdict = 'null') AS null_rows,
       count(*) FILTER (WHERE verdict = 'invalid') AS invalid_rows,
       count(*) FILTER (WHERE verdict = 'ok')
         - count(DISTINCT trade_id) FILTER (WHERE verdict = 'ok') AS duplicate_rows,
       count(DISTINCT trade_id) FILTER (WHERE verdict = 'ok') AS after_rows,
       count(*) FILTER (WHERE verdict = 'ok' AND symbol = '') AS blank_symbol_rows
FROM tagged""",
    "symbol_filter": f"WITH {RAW} SELECT * FROM raw WHERE symbol IN ('click', 'view')",
    "sample_head": f"WITH {VALID} SELECT * FROM t ORDER BY trade_time NULLS LAST, trade_id LIMIT 10",
    "synthetic_trades": f"""WITH {VALID},
slots AS (
  SELECT symbol, trade_id AS n, round(avg(price) OVER (PARTITION BY symbol), 2) AS base_price
  FROM t
),
drawn AS (
  SELECT *, {_draw('price')} AS dp, {_draw('quantity')} AS dq, {_draw('side')} AS ds,
         CAST(floor(100 + {_draw('step')} * 4901) AS BIGINT) AS step_ms
  FROM slots
)
SELECT upper(symbol) AS symbol, 100000000 + n + 1 AS trade_id,
       round(round(base_price * (1.0 + (-0.005 + dp * (0.005 - -0.005))), 2), 6) + 0.0 AS price,
       round(0.0001 + dq * (2.0 - 0.0001), 6) + 0.0 AS quantity,
       CAST(1704067200000 + sum(step_ms) OVER (PARTITION BY symbol ORDER BY n) AS BIGINT)
         AS trade_ms,
       ds < 0.5 AS sell_side
FROM drawn""",
    "normalize_messages": f"WITH {MESSAGES} SELECT * FROM compact",
    "keyed_trade_records": f"""WITH {MESSAGES}
SELECT symbol AS key,
       '{{"e":"trade","E":' || event_ms || ',"s":"' || symbol || '","t":' || trade_id
       || ',"p":"' || price || '","q":"' || quantity || '","T":' || trade_ms
       || ',"m":' || CASE WHEN sell_side THEN 'true' ELSE 'false' END
       || ',"source":"coinbase","channel":"' || channel || '"}}' AS value
FROM compact""",
    "window_agg": f"WITH {HOURLY} SELECT {WINDOW_COLUMNS} FROM w",
    "window_anomalies": f"WITH {HOURLY} SELECT {WINDOW_COLUMNS} FROM w WHERE is_anomaly",
    "rolling_zscore": f"""WITH {ZSCORED}
SELECT {TRADE_COLUMNS}, {r('price_zscore')}, {r('trade_value_zscore')}, is_anomaly FROM z""",
    "top_zscore_anomalies": f"""WITH {ZSCORED}
SELECT trade_time, symbol, {r('price')}, {r('quantity')}, {r('trade_value')},
       {r('price_zscore')}, {r('trade_value_zscore')}
FROM z WHERE is_anomaly
ORDER BY greatest(abs(z.price_zscore), abs(z.trade_value_zscore)) DESC, trade_id LIMIT 10""",
    "zscore_anomaly_history": f"""WITH {ZSCORED}
SELECT trade_time AS detected_at, symbol, {r('price')}, {r('quantity')}, {r('trade_value')},
       {r('price_zscore')}, {r('trade_value_zscore')},
       coalesce(nullif(concat_ws(', ',
         CASE WHEN abs(z.price_zscore) >= 3 THEN 'price_zscore' END,
         CASE WHEN abs(z.trade_value_zscore) >= 3 THEN 'trade_value_zscore' END), ''),
         'score_threshold') AS reason
FROM z WHERE is_anomaly
ORDER BY greatest(abs(z.price_zscore), abs(z.trade_value_zscore)) DESC, trade_id LIMIT 50""",
    "ml_features": f"""WITH {FEATURED}
SELECT {TRADE_COLUMNS}, {r('price_return')}, {r('rolling_trade_count')},
       {r('rolling_trade_value_mean')} FROM m""",
    "scaled_features": f"""WITH {FEATURED}
SELECT symbol, trade_id, trade_time, {', '.join(_scaled(c) for c in FEATURES)} FROM m""",
    "volume_by_symbol": f"""WITH {VALID}
SELECT symbol, round(sum(quantity), 6) + 0.0 AS volume FROM t GROUP BY symbol""",
    "trade_count_by_symbol": f"""WITH {VALID}
SELECT symbol, count(*) AS trade_count FROM t GROUP BY symbol""",
    "trade_count_by_hour": f"""WITH {VALID}
SELECT CAST(hour(trade_time) AS BIGINT) AS hour, count(*) AS trade_count FROM t
WHERE trade_time IS NOT NULL GROUP BY 1""",
    "trade_value_histogram": f"""WITH {VALID},
x AS (SELECT min(trade_value) AS lo, max(trade_value) AS hi FROM t),
e AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
             CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM x),
c AS (SELECT CAST(least(50, floor((trade_value - lo) / ((hi - lo) / 50)) + 1) AS BIGINT) AS bin,
             count(*) AS n FROM t, e GROUP BY 1)
SELECT b.bin, round(lo + (b.bin - 1) * ((hi - lo) / 50), 6) + 0.0 AS bin_start,
       round(lo + b.bin * ((hi - lo) / 50), 6) + 0.0 AS bin_end,
       coalesce(c.n, 0) AS trade_count
FROM (SELECT unnest(generate_series(1, 50)) AS bin) b CROSS JOIN e LEFT JOIN c ON c.bin = b.bin""",
    "price_box_stats": f"""WITH {VALID},
q AS (SELECT symbol, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
             quantile_cont(price, 0.75) AS q3 FROM t GROUP BY symbol),
f AS (SELECT t.symbol, price, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo,
             q3 + 1.5 * (q3 - q1) AS hi FROM t JOIN q ON t.symbol = q.symbol)
SELECT symbol, {r('q1')}, {r('median')}, {r('q3')},
       round(least(min(price) FILTER (WHERE price >= lo), q1), 6) + 0.0 AS whisker_low,
       round(greatest(max(price) FILTER (WHERE price <= hi), q3), 6) + 0.0 AS whisker_high,
       count(*) FILTER (WHERE price < lo OR price > hi) AS outlier_count
FROM f GROUP BY symbol, f.q1, f.median, f.q3""",
    "trade_summary": f"""WITH {VALID}
SELECT count(*) AS total_records, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols,
       min(trade_time) AS time_start, max(trade_time) AS time_end,
       round(avg(price), 6) + 0.0 AS mean_price, round(avg(quantity), 6) + 0.0 AS mean_quantity,
       round(avg(trade_value), 6) + 0.0 AS mean_trade_value,
       round(median(price), 6) + 0.0 AS median_price
FROM t""",
    "batch_summary": f"""WITH {ZSCORED}
SELECT 'cleaned_batch' AS source, count(*) AS total_records,
       string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols,
       min(trade_time) AS time_start, max(trade_time) AS time_end,
       round(avg(trade_value), 6) + 0.0 AS avg_trade_value,
       count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       CAST(0 AS BIGINT) AS ml_anomaly_count
FROM z""",
    "batch_symbol_aggregates": f"""WITH {VALID}
SELECT symbol, round(avg(price), 6) + 0.0 AS avg_price, round(sum(quantity), 6) + 0.0 AS volume,
       count(*) AS trade_count, round(max(trade_value), 6) + 0.0 AS max_trade_value
FROM t GROUP BY symbol""",
    "price_series_sampled": f"""WITH {VALID},
n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_time NULLS LAST, trade_id) AS rn,
             count(*) OVER (PARTITION BY symbol) AS total FROM t)
SELECT symbol, trade_time AS time, {r('price')}, {r('quantity')}, {r('trade_value')}
FROM n WHERE (rn - 1) % greatest(1, total // 600) = 0""",
    "series_bounds": f"""WITH {VALID},
b AS (SELECT symbol, min(price) AS min_price, max(price) AS max_price FROM t GROUP BY symbol)
SELECT symbol, {r('min_price')}, {r('max_price')},
       round(min_price - greatest((max_price - min_price) * 0.1, 1.0), 6) + 0.0 AS low,
       round(max_price + greatest((max_price - min_price) * 0.1, 1.0), 6) + 0.0 AS high
FROM b""",
    "supplier_aggregates": """WITH i AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
         CAST(l_extendedprice AS DOUBLE) / nullif(CAST(l_quantity AS DOUBLE), 0) AS price,
         CAST(l_quantity AS DOUBLE) AS quantity
  FROM lineitem
)
SELECT symbol, round(avg(price), 4) + 0.0 AS avg_price, round(sum(quantity), 4) + 0.0 AS volume,
       count(*) AS trade_count, round(max(price * quantity), 4) + 0.0 AS max_trade_value
FROM i WHERE symbol IS NOT NULL AND price > 0 AND price < 1e9 AND quantity > 0 AND quantity < 1e9
GROUP BY symbol""",
    "stream_count_by_hour": f"""WITH {HOURLY}
SELECT CAST(hour(window_start) AS BIGINT) AS hour, CAST(sum(trade_count) AS BIGINT) AS trade_count
FROM w GROUP BY 1""",
    "stream_volume_over_time": f"""WITH {HOURLY}
SELECT window_start, round(sum(volume), 6) + 0.0 AS volume FROM w GROUP BY 1""",
    "stream_anomaly_counts": f"""WITH {HOURLY}
SELECT window_start, count(*) FILTER (WHERE is_anomaly) AS anomaly_windows FROM w GROUP BY 1""",
    "stream_summary": f"""WITH {HOURLY}
SELECT 'spark_stream' AS source, CAST(sum(trade_count) AS BIGINT) AS total_records,
       string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols,
       min(window_start) AS time_start, max(window_end) AS time_end,
       round(sum(notional_volume) / sum(trade_count), 6) + 0.0 AS avg_trade_value,
       count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
       CAST(0 AS BIGINT) AS ml_anomaly_count
FROM w""",
    "stream_symbol_aggregates": f"""WITH {HOURLY}
SELECT symbol, round(sum(avg_price * trade_count) / sum(trade_count), 6) + 0.0 AS avg_price,
       round(sum(volume), 6) + 0.0 AS volume, CAST(sum(trade_count) AS BIGINT) AS trade_count,
       round(max(max_trade_value), 6) + 0.0 AS max_trade_value
FROM w GROUP BY symbol""",
    "stream_anomaly_history": f"""WITH {HOURLY}
SELECT window_start AS detected_at, symbol, {r('avg_price', alias='price')},
       {r('volume', alias='quantity')}, {r('notional_volume', alias='trade_value')},
       0.0::DOUBLE AS price_zscore, 0.0::DOUBLE AS trade_value_zscore,
       coalesce(nullif(anomaly_reason, ''), 'stream_rule') AS reason
FROM w WHERE is_anomaly ORDER BY window_start DESC, symbol LIMIT 50""",
    "stream_price_series": f"""WITH {HOURLY}
SELECT symbol, window_start AS time, {r('avg_price', alias='price')},
       {r('volume', alias='quantity')}, {r('notional_volume', alias='trade_value')} FROM w""",
    "stream_price_series_sampled": f"""WITH {HOURLY},
n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start) AS rn,
             count(*) OVER (PARTITION BY symbol) AS total FROM w)
SELECT symbol, window_start AS time, {r('avg_price', alias='price')},
       {r('volume', alias='quantity')}, {r('notional_volume', alias='trade_value')}
FROM n WHERE (rn - 1) % greatest(1, total // 100) = 0""",
    "stream_window_agg": f"""WITH {HOURLY}
SELECT {WINDOW_COLUMNS} FROM w
WHERE window_end <= (SELECT max(trade_time) FROM t) - INTERVAL 120 SECOND""",
    "late_data_report": f"""WITH {HOURLY},
d AS (
  SELECT 1 AS run, * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
  UNION ALL SELECT 2, * FROM events WHERE NOT ts < TIMESTAMP '2024-01-16 00:00:00'
  UNION ALL SELECT 3, * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
),
counted AS (SELECT run, count(*) AS input_rows FROM d GROUP BY run),
seen AS (
  SELECT CAST(r AS INTEGER) AS run, max(trade_time) - INTERVAL 120 SECOND AS mark
  FROM t, (SELECT unnest([1, 2, 3]) AS r)
  WHERE r > 1 OR trade_time < TIMESTAMP '2024-01-16 00:00:00' GROUP BY r
)
SELECT CAST(counted.run AS INTEGER) AS run, input_rows, counted.run = 3 AS dropped_late,
       strftime(date_trunc('millisecond', mark), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS watermark,
       (SELECT CAST(sum(trade_count) AS BIGINT) FROM w
        WHERE window_end <= (SELECT max(mark) FROM seen)) AS trades_emitted
FROM counted JOIN seen ON counted.run = seen.run""",
}
ORACLE["stream_agg_scan"] = ORACLE["stream_window_agg"]
ORACLE["stream_keyed_records"] = ORACLE["keyed_trade_records"]
