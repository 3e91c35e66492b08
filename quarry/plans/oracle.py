"""DuckDB SQL equal in meaning to each registered query (views = driver tables)."""

_TICKS = """
SELECT user_id AS stock_ticker, ts AS timestamp, event_id, value AS close,
       CAST(round(value * 100) AS BIGINT) AS volume
FROM events
"""

_CHANGES = f"""
SELECT stock_ticker, timestamp, event_id, close, prev_close,
       CASE WHEN prev_close = 0 THEN NULL
            ELSE abs((close - prev_close) / prev_close * 100) END AS pct_change
FROM (SELECT *, lag(close) OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id) AS prev_close
      FROM ({_TICKS}) b) t
WHERE prev_close IS NOT NULL
"""

_SCD = """
WITH target AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS city, c_custkey + 1 AS record_id,
         TIMESTAMP '2020-01-01 00:00:00' AS effective_start_date,
         TIMESTAMP '9999-12-31 00:00:00' AS effective_end_date
  FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, c_custkey + 1000000,
         TIMESTAMP '2019-01-01 00:00:00', TIMESTAMP '2020-01-01 00:00:00'
  FROM customer WHERE c_custkey % 7 = 0),
source AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         CASE WHEN c_custkey % 5 = 2 THEN 'MOVED' ELSE c_mktsegment END AS city
  FROM customer WHERE c_custkey % 10 <> 1),
active AS (SELECT * FROM target WHERE effective_end_date = TIMESTAMP '9999-12-31 00:00:00'),
hist AS (SELECT * FROM target WHERE effective_end_date <> TIMESTAMP '9999-12-31 00:00:00'),
j AS (
  SELECT a.*, s.customer_id AS s_id, s.name AS s_name, s.city AS s_city,
         CASE WHEN a.customer_id IS NULL THEN 'insert'
              WHEN s.customer_id IS NULL THEN 'delete'
              WHEN a.name IS NOT DISTINCT FROM s.name AND a.city IS NOT DISTINCT FROM s.city THEN 'keep'
              ELSE 'change' END AS kind
  FROM active a FULL OUTER JOIN source s ON a.customer_id = s.customer_id),
old AS (
  SELECT customer_id, name, city, record_id, effective_start_date,
         CASE WHEN kind IN ('change', 'delete') THEN TIMESTAMP '2024-01-01 00:00:00'
              ELSE effective_end_date END AS effective_end_date
  FROM j WHERE kind <> 'insert'),
fresh AS (
  SELECT s_id AS customer_id, s_name AS name, s_city AS city,
         (SELECT coalesce(max(record_id), 0) FROM target)
           + row_number() OVER (ORDER BY CASE WHEN kind = 'change' THEN 0 ELSE 1 END, s_id) AS record_id,
         TIMESTAMP '2024-01-01 00:00:00' AS effective_start_date,
         TIMESTAMP '9999-12-31 00:00:00' AS effective_end_date
  FROM j WHERE kind IN ('change', 'insert')),
merged AS (SELECT * FROM hist UNION ALL SELECT * FROM old UNION ALL SELECT * FROM fresh)
SELECT customer_id, name, city, CAST(record_id AS BIGINT) AS record_id,
       strftime(effective_start_date, '%Y-%m-%d %H:%M:%S') AS effective_start_date,
       strftime(effective_end_date, '%Y-%m-%d %H:%M:%S') AS effective_end_date
FROM merged
"""

_ANOMALY_FLAGS = f"""
WITH h AS (
  SELECT *, lag(close) OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id) AS prev_minute_close,
         avg(volume) OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id
                           ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_10min_volume
  FROM ({_TICKS}) b),
m AS (
  SELECT *,
    CASE WHEN prev_minute_close IS NULL THEN 0.0
         WHEN prev_minute_close = 0 THEN NULL
         ELSE (close - prev_minute_close) / prev_minute_close * 100 END AS price_change_pct,
    CASE WHEN avg_10min_volume IS NOT NULL AND avg_10min_volume > 0
         THEN (volume - avg_10min_volume) / avg_10min_volume * 100 ELSE 0.0 END AS volume_change_pct
  FROM h)
SELECT *, coalesce(prev_minute_close IS NOT NULL AND abs(price_change_pct) > 0.5, false) AS p,
          coalesce(avg_10min_volume IS NOT NULL AND volume_change_pct > 2.0, false) AS v
FROM m
"""

_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _lines(expr: str) -> str:
    return (
        f"(len(regexp_extract_all({expr}, '{_BREAK}')) + "
        f"CASE WHEN length({expr}) > 0 AND NOT regexp_matches({expr}, '({_BREAK})\\z') THEN 1 ELSE 0 END)"
    )


ORACLE = {
    "line_counts": f"SELECT doc_id, CAST({_lines('text')} AS BIGINT) AS n_lines FROM documents",
    "line_counts_files": f"SELECT doc_id, CAST({_lines("(text || chr(10))")} AS BIGINT) AS n_lines FROM documents",
    "line_counts_scan": f"SELECT doc_id, CAST({_lines("(text || chr(10))")} AS BIGINT) AS n_lines FROM documents",
    "sliding_counts": """
WITH w AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS b FROM events),
s AS (SELECT b AS window_start FROM w UNION ALL SELECT b - INTERVAL 5 MINUTE FROM w)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, count(*) AS count
FROM s GROUP BY window_start
""",
    "scd2_merge": _SCD,
    "scd2_merge_sql": _SCD,
    "scd2_second_run": _SCD,
    "clean_bars": """
SELECT CAST(user_id AS VARCHAR) AS stock_ticker, CAST(event_id AS VARCHAR) AS event_id, ts AS timestamp,
       value AS open, value AS high, value AS low, value AS close,
       CAST(round(value * 100) AS BIGINT) AS volume
FROM events WHERE event_type <> 'error'
""",
    "clean_bar_rejects": """
SELECT CAST(user_id AS VARCHAR) AS stock_ticker, CAST(event_id AS VARCHAR) AS event_id, 'n/a' AS close
FROM events WHERE event_type = 'error'
""",
    "parse_messages": """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id AS VARCHAR) AS stock_ticker, ts AS timestamp,
       value AS open, value AS high, value AS low, value AS close,
       CAST(round(value * 100) AS BIGINT) AS volume
FROM events
""",
    "parse_props": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""",
    "alert_messages": f"""
SELECT CAST(stock_ticker AS VARCHAR) AS key, CAST(stock_ticker AS VARCHAR) AS stock_ticker,
       strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, volume,
       avg_10min_volume AS avg_volume, volume_change_pct,
       'Traded Volume more than 2% of its average' AS warning
FROM ({_ANOMALY_FLAGS}) f WHERE v
""",
    "time_bucket_counts": """
SELECT CASE WHEN h >= 0 AND h < 6 THEN '0-6'
            WHEN h >= 6 AND h < 12 THEN '6-12'
            WHEN h >= 12 AND h < 18 THEN '12-18'
            WHEN h IS NOT NULL THEN '18-24' END AS time_range,
       count(*) AS count
FROM (SELECT hour(ts) AS h FROM events) GROUP BY 1
""",
    "pct_change": _CHANGES,
    "threshold_summary": f"""
WITH c AS (SELECT pct_change AS x FROM ({_CHANGES}) s),
p AS (SELECT quantile_cont(x, 0.95) AS q1, quantile_cont(x, 0.99) AS q2, quantile_cont(x, 0.995) AS q3,
             quantile_cont(x, 0.9995) AS q4, quantile_cont(x, 0.99995) AS q5 FROM c),
u AS (SELECT '95th' AS percentile, q1 AS v FROM p UNION ALL SELECT '99th', q2 FROM p
      UNION ALL SELECT '99.5th', q3 FROM p UNION ALL SELECT '99.95th', q4 FROM p
      UNION ALL SELECT '99.995th', q5 FROM p)
SELECT percentile, round(v, 6) AS value,
       (SELECT count(*) FROM c WHERE c.x > u.v) AS n_exceeding
FROM u
""",
    "moving_avg_10": f"""
SELECT stock_ticker, timestamp, event_id, volume,
       avg(volume) OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id
                         ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_10_volume
FROM ({_TICKS}) b
""",
    "detect_anomalies": f"""
WITH h AS (
  SELECT *, lag(close) OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id) AS prev_minute_close,
         avg(volume) OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id
                           ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS avg_10min_volume
  FROM ({_TICKS}) b),
m AS (
  SELECT *,
    CASE WHEN prev_minute_close IS NULL THEN 0.0
         WHEN prev_minute_close = 0 THEN NULL
         ELSE (close - prev_minute_close) / prev_minute_close * 100 END AS price_change_pct,
    CASE WHEN avg_10min_volume IS NOT NULL AND avg_10min_volume > 0
         THEN (volume - avg_10min_volume) / avg_10min_volume * 100 ELSE 0.0 END AS volume_change_pct
  FROM h),
f AS (
  SELECT *, coalesce(prev_minute_close IS NOT NULL AND abs(price_change_pct) > 0.5, false) AS p,
            coalesce(avg_10min_volume IS NOT NULL AND volume_change_pct > 2.0, false) AS v
  FROM m)
SELECT stock_ticker, timestamp, close, volume, prev_minute_close, avg_10min_volume,
       price_change_pct, volume_change_pct,
       CASE WHEN p AND v THEN 'Price+Volume' WHEN p THEN 'Price' WHEN v THEN 'Volume' ELSE 'None' END
         AS anomaly_type
FROM f WHERE p OR v
""",
    "dense_ids": """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders
""",
    "key_set_union": """
SELECT c_custkey AS custkey FROM customer UNION SELECT o_custkey FROM orders
""",
}


_NEAREST = """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS cls, i, avg(CAST(x AS DOUBLE)) AS m FROM e GROUP BY label, i),
d AS (SELECT e.vec_id, c.cls, sum((CAST(e.x AS DOUBLE) - c.m) * (CAST(e.x AS DOUBLE) - c.m)) AS dist
      FROM e JOIN c ON e.i = c.i GROUP BY e.vec_id, c.cls)
SELECT d.vec_id, any_value(b.label) AS label, CAST(arg_min(d.cls, d.dist) AS VARCHAR) AS pred_class
FROM d JOIN embeddings b ON b.vec_id = d.vec_id GROUP BY d.vec_id
"""
ORACLE["classify"] = _NEAREST
ORACLE["weighted_precision"] = f"""
WITH p AS (SELECT CAST(label AS VARCHAR) AS label, pred_class AS prediction FROM ({_NEAREST}) q),
a AS (SELECT label AS c, count(*) AS n_actual FROM p GROUP BY 1),
r AS (SELECT prediction AS c, count(*) AS n_pred, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS tp
      FROM p GROUP BY 1)
SELECT round(sum(coalesce(r.tp / r.n_pred, 0.0) * a.n_actual) / sum(a.n_actual), 9) AS weighted_precision
FROM a LEFT JOIN r ON a.c = r.c
"""

ORACLE["line_count_event_rejects"] = """
SELECT 'malformed' AS reason, count(DISTINCT lang) AS n FROM documents
UNION ALL
SELECT 'missing', count(DISTINCT source) FROM documents
"""
ORACLE["sliding_counts_10s"] = """
WITH w AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) AS b FROM events),
s AS (SELECT b AS window_start FROM w UNION ALL SELECT b - INTERVAL 5 SECOND FROM w)
SELECT window_start, window_start + INTERVAL 10 SECOND AS window_end, count(*) AS count
FROM s GROUP BY window_start
"""
ORACLE["moving_avg_range"] = f"""
SELECT stock_ticker, timestamp, event_id, volume,
       avg(volume) OVER (PARTITION BY stock_ticker ORDER BY timestamp
                         RANGE BETWEEN INTERVAL 600 SECOND PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
         AS avg_10min_volume
FROM ({_TICKS}) b
"""
ORACLE["customer_messages"] = """
SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(c_custkey AS VARCHAR) AS customer_id,
       c_name AS name, c_mktsegment AS city
FROM customer
"""

# Queries that must give the same rows as another one: streams equal their batch form,
# file-based forms equal the table form, the end-to-end job equals the operator.
ORACLE["sliding_counts_stream"] = ORACLE["sliding_counts"]
ORACLE["detect_anomalies_stream"] = ORACLE["detect_anomalies"]
ORACLE["detect_anomalies_stream_table"] = ORACLE["detect_anomalies"]
ORACLE["threshold_summary_approx"] = f"""
SELECT percentile, (SELECT count(pct_change) FROM ({_CHANGES}) c) > 0 AS within_bound
FROM (VALUES ('95th'), ('99th'), ('99.5th'), ('99.95th'), ('99.995th')) v(percentile)
"""
ORACLE["line_counts_stream"] = ORACLE["line_counts_files"]
ORACLE["line_counts_from_events"] = ORACLE["line_counts_files"]
ORACLE["load_bars"] = ORACLE["clean_bars"]
ORACLE["click_counter_tsv"] = ORACLE["time_bucket_counts"]
ORACLE["classify_stream"] = _NEAREST

ORACLE["path_parts"] = f"""
WITH p AS (SELECT '/data/' || source || '/' || coalesce(lang, 'none') || '/doc.' || doc_id || '.txt' AS path,
                  coalesce(lang, 'none') AS label, 'doc.' || doc_id AS stem, CAST({_lines('text')} AS BIGINT) AS n FROM documents)
SELECT path, label, stem, 'Number of lines in ' || path || ': ' || n AS report FROM p
"""
ORACLE["libsvm_scan"] = """
SELECT CAST(label AS INTEGER) AS label, count(*) AS n, max(len(embedding))::INT AS dims,
       round(sum(CAST(embedding[1] AS DOUBLE)), 4) AS first_sum
FROM embeddings GROUP BY 1
"""
ORACLE["publish_order"] = f"""
SELECT stock_ticker, event_id, row_number() OVER (PARTITION BY stock_ticker ORDER BY timestamp, event_id)::INT AS place
FROM ({_TICKS}) b
"""
# A tree of depth 0 predicts the most frequent label of the other folds, the first by name of equals; its weighted
# precision on a fold is the square of that label's share of the fold.
ORACLE["tune_tree_majority"] = """
WITH e AS (SELECT CAST(label AS DOUBLE)::VARCHAR AS label, ('0x' || substr(md5(vec_id::VARCHAR), 1, 6))::INT % 3 AS fold FROM embeddings),
t AS (SELECT f.fold, label, count(*) AS n FROM e, (SELECT DISTINCT fold FROM e) f WHERE e.fold <> f.fold GROUP BY ALL),
m AS (SELECT fold, label FROM t QUALIFY row_number() OVER (PARTITION BY fold ORDER BY n DESC, label) = 1),
s AS (SELECT e.fold, pow(avg(CASE WHEN e.label = m.label THEN 1.0 ELSE 0.0 END), 2) AS p FROM e JOIN m ON e.fold = m.fold GROUP BY e.fold),
w AS (SELECT pow(max(n) / sum(n), 2) AS p FROM (SELECT label, count(*) AS n FROM e GROUP BY label))
SELECT 0 AS max_depth, b AS max_bins, round((SELECT avg(p) FROM s), 9) AS avg_metric, 40 AS grid_size, 0 AS best_depth,
       round((SELECT p FROM w), 9) AS train_score
FROM (SELECT unnest([2, 4, 8, 16, 32]) AS b)
"""

ORACLE["late_rows"] = """
WITH e AS (SELECT event_id, ts, floor(date_diff('day', DATE '2024-01-01', ts::DATE) / 5) + (event_type = 'error')::INT AS g FROM events),
m AS (SELECT g, max(ts) AS latest FROM e GROUP BY g),
w AS (SELECT g, max(latest) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3 DAY AS mark FROM m),
l AS (SELECT event_id, ts < mark AS late FROM e JOIN w USING (g))
SELECT event_id, 'late' AS reason, (SELECT count(*) FROM l WHERE NOT coalesce(late, false)) AS n_on_time FROM l WHERE late
"""
