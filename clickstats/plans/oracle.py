"""The same queries in DuckDB SQL, over the raw driver tables.

These compute from ``events`` columns directly (no line rendering, no
parsing), so they check the whole chain: rendering, parsing, windows,
ranking. Windows are expanded by brute force, one row per window a row lies
in; rankings use ``row_number``; late rows a window-function watermark.
"""

from __future__ import annotations

NL = "chr(10)"

# Each event with its item and second-resolution time.
_EV = """
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) // 1000000 AS ts_sec, ts
  FROM events
"""

_BEHAVIOR = f"""
  SELECT user_id, k AS item_id, CAST(k % 10 AS INTEGER) AS category_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
         ts_sec, ts_sec * 1000 AS event_ms
  FROM ({_EV}) e
"""

_LOG = f"""
  SELECT '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip, CAST(user_id AS VARCHAR) AS user_id,
         ts_sec * 1000 AS event_ms,
         CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
         '/item/' || CAST(k AS VARCHAR) AS url, ts_sec, event_id, ts
  FROM ({_EV}) e
"""

_PV = f"SELECT item_id, ts_sec FROM ({_BEHAVIOR}) b WHERE behavior = 'pv'"
_GET = f"SELECT url, ts_sec FROM ({_LOG}) l WHERE method = 'GET'"


def _sliding(src: str, key: str, slide_s: int, n: int, count_col: str = '"count"') -> str:
    """Counts per (key, window_end) of 'n' windows sliding by 'slide_s' seconds."""
    return f"""
  SELECT {key}, (ts_sec // {slide_s} + 1 + r) * {slide_s * 1000} AS window_end, COUNT(*) AS {count_col}
  FROM ({src}) s, range({n}) t(r)
  GROUP BY ALL
"""


def _top(counts: str, key: str, count_col: str = '"count"', n: int = 5) -> str:
    return f"""
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY {count_col} DESC, {key}) AS INTEGER)
           AS "rank"
    FROM ({counts}) c
  ) WHERE "rank" <= {n}
"""


def _java_ts(ms: str) -> str:
    """Epoch ms as java.sql.Timestamp prints it (UTC)."""
    frac = (f"CASE WHEN {ms} % 1000 = 0 THEN '0' "
            f"ELSE rtrim(lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0'), '0') END")
    return f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%d %H:%M:%S') || '.' || {frac}"


_BEHAVIOR_REJECTS = f"""
  SELECT CASE kind
           WHEN 0 THEN u || ',' || ks || ',' || cs || ',' || beh
           WHEN 1 THEN u || 'x,' || ks || ',' || cs || ',' || beh || ',' || tss
           WHEN 2 THEN u || ', ' || ks || ' ,' || cs || ',' || beh || ',' || tss
           ELSE 'bad' END AS value,
         CASE kind
           WHEN 0 THEN 'timestamp missing'
           WHEN 1 THEN 'user_id not an integer'
           WHEN 2 THEN 'item_id not an integer'
           ELSE 'user_id not an integer' END AS reason
  FROM (
    SELECT CAST(user_id AS VARCHAR) AS u, CAST(k AS VARCHAR) AS ks, CAST(k % 10 AS VARCHAR) AS cs,
           CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS beh,
           CAST(ts_sec AS VARCHAR) AS tss, (event_id // 97) % 4 AS kind
    FROM ({_EV}) e WHERE event_id % 97 = 0
  ) b
"""

_LOG_REJECTS = f"""
  SELECT CASE kind
           WHEN 0 THEN head || '31/02/' || CAST(year(ts) AS VARCHAR) || ':00:00:00' || tail
           WHEN 1 THEN head || t || 'Z' || tail
           WHEN 2 THEN head || t
           ELSE 'bad' END AS value,
         CASE kind WHEN 2 THEN 'method missing' WHEN 3 THEN 'time missing' ELSE 'time not a date' END AS reason
  FROM (
    SELECT ip || ' ' || user_id || ' - ' AS head, strftime(ts, '%d/%m/%Y:%H:%M:%S') AS t,
           ' +0000 ' || method || ' ' || url AS tail, ts, (event_id // 97) % 4 AS kind
    FROM ({_LOG}) l WHERE event_id % 97 = 0
  ) b
"""

# Arrival batches and the watermark each batch is judged by (1 s disorder).
_ARRIVED = f"""
  WITH arr AS (
    SELECT *, (ts_sec + CASE WHEN event_id % 10 = 0 THEN ((event_id // 10) % 7) * 10 ELSE 0 END * 60) // 600
              AS batch_id
    FROM ({_LOG}) l
  ), bmax AS (
    SELECT batch_id, MAX(ts_sec) * 1000 AS mx FROM arr GROUP BY batch_id
  ), wm AS (
    SELECT batch_id,
           MAX(mx) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000 AS wm
    FROM bmax
  )
  SELECT arr.*, wm.wm, ts_sec // 5 AS pane FROM arr JOIN wm USING (batch_id) WHERE method = 'GET'
"""
# 10 min windows sliding by 5 s (120 per row), 1 min allowed lateness.
_FULLY_LATE = "(wm IS NOT NULL AND (pane + 120) * 5000 - 1 + 60000 <= wm)"
_LOG_OUT = "ip, user_id, event_ms, method, url, batch_id"

_ACCEPTED = f"""
  SELECT url, (pane + 1 + r) * 5000 AS window_end, COUNT(*) AS url_count
  FROM ({_ARRIVED}) a, range(120) t(r)
  WHERE wm IS NULL OR (pane + 1 + r) * 5000 - 1 + 60000 > wm
  GROUP BY ALL
"""

_ROLLUP = """COUNT(*) AS windows, CAST(SUM("count") AS BIGINT) AS total, MAX("count") AS peak,
         MIN(window_end) AS first_end, MAX(window_end) AS last_end,
         CAST(SUM(window_end // 1000 * "count") AS BIGINT) AS end_checksum"""

# 1 h windows that start at the multiples of 7 s.
_UNEVEN = f"""
  SELECT item_id, (ts_sec // 7 - r) * 7000 + 3600000 AS window_end, COUNT(*) AS "count"
  FROM ({_PV}) s, range(515) t(r) WHERE (ts_sec // 7 - r) * 7 + 3600 > ts_sec
  GROUP BY ALL
"""

# The report texts of the original jobs.
_REPORT = f"""
  SELECT window_end,
         '===========================' || {NL} || '窗口结束时间：' || {_java_ts('window_end')} || {NL}
         || string_agg('top:' || CAST("rank" AS VARCHAR) || 'itemId:' || CAST(item_id AS VARCHAR)
                       || '商品热度:' || CAST("count" AS VARCHAR) || {NL}, '' ORDER BY "rank")
         || '===========================' || {NL} AS report
  FROM ({_top(_sliding(_PV, "item_id", 300, 12), "item_id")}) t
  GROUP BY window_end
"""

_COMPACT_REPORT = f"""
  SELECT window_end,
         '窗口结束时间:' || {_java_ts('window_end')}
         || string_agg('top_' || CAST("rank" AS VARCHAR) || 'itemId:' || CAST(item_id AS VARCHAR)
                       || 'count:' || CAST("count" AS VARCHAR), '' ORDER BY "rank")
         || '=========================' || {NL} AS report
  FROM ({_top(_sliding(_PV, "item_id", 1800, 2), "item_id")}) t
  GROUP BY window_end
"""

# The report texts of the original jobs.
_URL_REPORT = f"""
  SELECT window_end,
         '=============================' || {NL} || '窗口关闭时间：' || {_java_ts('window_end')} || {NL}
         || string_agg('topN' || CAST("rank" AS VARCHAR) || 'url:' || url
                       || '页面热度：' || CAST(url_count AS VARCHAR) || {NL}, '' ORDER BY "rank")
         || '=============================' || {NL} AS report
  FROM ({_top(_sliding(_GET, "url", 5, 120, "url_count"), "url", "url_count")}) t
  GROUP BY window_end
"""

ORACLE: dict[str, str] = {
    "ingest_behavior": _BEHAVIOR,
    "ingest_behavior_rejects": _BEHAVIOR_REJECTS,
    "ingest_access_log": f"SELECT ip, user_id, event_ms, method, url FROM ({_LOG}) l",
    "ingest_access_log_rejects": _LOG_REJECTS,
    "filter_pv": f"SELECT * FROM ({_BEHAVIOR}) b WHERE behavior = 'pv'",
    "filter_get": f"SELECT ip, user_id, event_ms, method, url FROM ({_LOG}) l WHERE method = 'GET'",
    "item_counts_1h_5m": _sliding(_PV, "item_id", 300, 12),
    "item_counts_1h_3s": f"""
  SELECT item_id, {_ROLLUP} FROM ({_sliding(_PV, "item_id", 3, 1200)}) c GROUP BY item_id
""",
    "url_counts_10m_5s": _sliding(_GET, "url", 5, 120, "url_count"),
    "page_views_hourly": f"""
  SELECT 'pv' AS pv, (ts_sec // 3600 + 1) * 3600000 AS window_end, COUNT(*) AS "count"
  FROM ({_PV}) p GROUP BY ALL
""",
    "page_views_salted": f"""
  SELECT window_end, "count", 'pv:' || CAST("count" AS VARCHAR) AS pv FROM (
    SELECT (ts_sec // 3600 + 1) * 3600000 AS window_end, COUNT(*) AS "count" FROM ({_PV}) p GROUP BY ALL) c
""",
    "hot_items_top5": _top(_sliding(_PV, "item_id", 300, 12), "item_id"),
    "hot_items_kafka": f"""
  SELECT item_id, COUNT(*) AS top_windows, MIN("rank") AS best_rank, MAX("count") AS peak,
         MIN(window_end) AS first_end, MAX(window_end) AS last_end,
         CAST(SUM(window_end // 1000 * "count") AS BIGINT) AS end_checksum,
         CAST(SUM(window_end // 1000 * "rank") AS BIGINT) AS rank_checksum
  FROM ({_top(_sliding(_PV, "item_id", 3, 1200), "item_id")}) t GROUP BY item_id
""",
    "hot_urls_top5": _top(_sliding(_GET, "url", 5, 120, "url_count"), "url", "url_count"),
    "hot_items_report": _REPORT,
    "hot_urls_report": _URL_REPORT,
    "late_rows": f"SELECT {_LOG_OUT} FROM ({_ARRIVED}) a WHERE {_FULLY_LATE}",
    "on_time_rows": f"SELECT {_LOG_OUT} FROM ({_ARRIVED}) a WHERE NOT {_FULLY_LATE}",
    "hot_urls_updated": _top(_ACCEPTED, "url", "url_count"),
    "ingest_behavior_clean": f"""
  SELECT user_id, item_id, category_id, behavior, ts_sec, event_ms FROM (
    SELECT user_id, k AS item_id, CAST(k % 10 AS INTEGER) AS category_id,
           CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, ts_sec, ts_sec * 1000 AS event_ms
    FROM ({_EV}) e WHERE event_id % 97 <> 0) b
""",
    "ingest_access_log_clean": f"SELECT ip, user_id, event_ms, method, url FROM ({_LOG}) l WHERE event_id % 97 <> 0",
    "item_counts_1h_7s": f"SELECT item_id, {_ROLLUP} FROM ({_UNEVEN}) c GROUP BY item_id",
    "hot_items_kafka_report": _COMPACT_REPORT,
    "open_windows_after_expiry": f"""
  SELECT url, window_end, url_count FROM ({_ACCEPTED}) a
  WHERE window_end - 1 + 86400000 > (SELECT MAX(ts_sec) * 1000 - 1000 FROM ({_EV}) e)
""",
}
