"""DuckDB SQL for each registered query, written independently of the Spark plans: windows are
built by brute-force expansion of event minutes rather than by the bucket/halo/range-frame plan.

Conventions: epoch minutes ``epoch_us(ts) // 60000000``; window bounds as naive TIMESTAMP; every
integer sum cast to BIGINT; every column aliased to the Spark name.
"""

from __future__ import annotations

# Expansion of requests into (article, window start minute, slot) for n slots of w minutes,
# sliding by `slide` minutes.
def _slot_cells(slot_min: int, slots: int, slide_min: int) -> str:
    span = slot_min * slots
    return f"""
    req AS (SELECT event_type AS article, epoch_us(ts) // 60000000 AS m FROM events WHERE ts IS NOT NULL),
    cells AS (
      SELECT article, (m // {slide_min} - j) * {slide_min} AS s,
             ((m - (m // {slide_min} - j) * {slide_min}) // {slot_min}) AS k
      FROM req, range(0, {span // slide_min}) t(j)
    ),
    ser AS (
      SELECT article, s,
             {", ".join(f"CAST(SUM(CASE WHEN k = {i} THEN 1 END) AS BIGINT) AS s{i}" for i in range(slots))}
      FROM cells GROUP BY article, s
    )"""


def _trend_sql(slot_min: int, slots: int, slide_min: int, trending: bool, extra: str = "") -> str:
    cols = ", ".join(f"s{i}" for i in range(slots))
    complete = " AND ".join(f"s{i} IS NOT NULL" for i in range(slots))
    nondec = " AND ".join(f"s{i} <= s{i + 1}" for i in range(slots - 1))
    cond = complete + (f" AND {nondec}" if trending else "")
    return f"""WITH {_slot_cells(slot_min, slots, slide_min)}
    SELECT article,
           TIMESTAMP '1970-01-01' + to_minutes(s) AS window_start,
           TIMESTAMP '1970-01-01' + to_minutes(s + {slot_min * slots}) AS window_end,
           {cols}{extra}
    FROM ser WHERE {cond}"""


_SLIDING = """WITH req AS (SELECT event_type AS article, epoch_us(ts) // 60000000 AS m FROM events
                      WHERE ts IS NOT NULL),
  c AS (SELECT article, m - j AS s, COUNT(*) AS views FROM req, range(0, 10) t(j) GROUP BY 1, 2)
SELECT article, TIMESTAMP '1970-01-01' + to_minutes(s) AS window_start,
       TIMESTAMP '1970-01-01' + to_minutes(s + 10) AS window_end,
       CAST(views AS BIGINT) AS views
FROM c"""

_PHASE = f"""WITH sc AS ({_SLIDING})
SELECT article, window_start, window_end, views,
       CAST(minute(window_start) % 10 AS INTEGER) AS phase,
       'pageviews-' || CAST(minute(window_start) % 10 AS VARCHAR) AS topic,
       article AS key,
       article || chr(9) || strftime(window_start, '%H:%M:%S') || chr(9) || CAST(views AS VARCHAR) AS value
FROM sc"""

_HOURLY = """SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
       event_type AS article, CAST(COUNT(*) AS BIGINT) AS views
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""

# An address has four parts between dots, each a whole number from 0 to 255 (a plus sign, leading zeros and
# -0 allowed): judged part by part, on the number itself.
def _octet_ok(i: int) -> str:
    part = f"split_part(ip, '.', {i})"
    digits = f"ltrim({part}, '+-')"
    return (f"{digits} <> '' AND translate({digits}, '0123456789', '') = '' "
            f"AND length({part}) - length({digits}) <= 1 AND TRY_CAST({part} AS HUGEINT) BETWEEN 0 AND 255")


_IP_OK = "len(string_split(ip, '.')) = 4 AND " + " AND ".join(f"({_octet_ok(i)})" for i in (1, 2, 3, 4))

_REQ_LINES = """req_lines AS (
  SELECT CASE WHEN sec = 3 THEN event_type || chr(9) || ip || chr(9) || 'x' || ep
              WHEN sec = 4 THEN event_type || chr(9) || ip
              ELSE event_type || chr(9) || ip || chr(9) || ep END AS line
  FROM (
    SELECT event_type, sec, ep,
           CASE WHEN sec = 0 THEN ''
                WHEN sec = 1 THEN ip0 || '.'
                WHEN sec = 2 THEN '00' || ip0
                ELSE ip0 END AS ip
    FROM (
      SELECT event_type, CAST(second(ts) AS INTEGER) AS sec,
             CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS ep,
             concat_ws('.', user_id, regexp_extract(props, '"k": ([0-9]+)', 1),
                       CAST(floor(value) AS BIGINT), CAST(second(ts) AS INTEGER)) AS ip0
      FROM events)))"""

_REQ_PARSED = f"""WITH {_REQ_LINES},
parsed AS (
  SELECT line, f[1] AS article, f[2] AS ip, f[3] AS tsf, len(string_split(rtrim(line, chr(9)), chr(9))) AS n
  FROM (SELECT line, string_split(line, chr(9)) AS f FROM req_lines)),
judged AS (
  SELECT *, CASE WHEN n < 3 THEN 'fields'
                 WHEN ip IS NULL OR NOT ({_IP_OK}) THEN 'ip'
                 WHEN NOT regexp_full_match(tsf, '[+-]?[0-9]+') OR TRY_CAST(tsf AS BIGINT) IS NULL
                      OR TRY_CAST(tsf AS BIGINT) < -62135596800
                      OR TRY_CAST(tsf AS BIGINT) > 253402300799 THEN 'timestamp' END AS reason
  FROM parsed)"""

_LOG_LINES = """log_lines AS (
  SELECT CASE WHEN sec = 6 THEN concat_ws(' ', project, title, views)
              WHEN sec = 7 THEN concat_ws(' ', project, '', title, views, bytes)
              ELSE concat_ws(' ', project, title, views, bytes) END AS line, hr
  FROM (
    SELECT CAST(second(ts) AS INTEGER) AS sec, CAST(hour(ts) AS INTEGER) AS hr,
           CASE WHEN user_id % 2 = 0 THEN 'en' ELSE 'de' END AS project,
           upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS title,
           CASE WHEN second(ts) = 5 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS views,
           CAST(user_id AS VARCHAR) AS bytes
    FROM events))"""

_LOG_PARSED = f"""WITH {_LOG_LINES},
parsed AS (
  SELECT line, hr, f[1] AS project, lower(f[2]) AS article,
         CASE WHEN regexp_full_match(f[3], '[+-]?[0-9]+') THEN TRY_CAST(f[3] AS BIGINT) END AS views,
         CASE WHEN regexp_full_match(f[4], '[+-]?[0-9]+') THEN TRY_CAST(f[4] AS BIGINT) END AS bytes,
         len(f) AS n
  FROM (SELECT line, hr, string_split(line, ' ') AS f FROM log_lines)),
judged AS (
  SELECT *, CASE WHEN n <> 4 THEN 'arity' WHEN views IS NULL THEN 'views' END AS reason FROM parsed)"""

_DAY = """feed AS (SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
                 event_type AS article, COUNT(*) AS views
          FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3),
lat AS (SELECT max(date) AS d FROM feed),
cur AS (SELECT hour, article, views AS c FROM feed WHERE date = (SELECT d FROM lat)),
hist AS (SELECT hour, article, SUM(views) AS sum_views, COUNT(*) AS n, SUM(views) // COUNT(*) AS a
         FROM feed WHERE date < (SELECT d FROM lat) GROUP BY 1, 2)"""

_PAIRS = {
    "drop": "SELECT cur.hour, cur.article, c, a FROM cur JOIN hist ON cur.hour = hist.hour AND cur.article = hist.article",
    "zero": """SELECT coalesce(cur.hour, hist.hour) AS hour, coalesce(cur.article, hist.article) AS article,
                      coalesce(c, 0) AS c, coalesce(a, 0) AS a
               FROM cur FULL OUTER JOIN hist ON cur.hour = hist.hour AND cur.article = hist.article""",
}


def _run_sql(missing: str, upto: int = 23) -> str:
    keep = "WHERE k = hour + 1" if missing == "drop" else ""
    return f"""WITH {_DAY},
pairs AS ({_PAIRS[missing]}),
terms AS (SELECT hour, article, abs(c - a) AS l, c + a AS r,
                 CASE WHEN c + a = 0 THEN 0.0 ELSE abs(c - a) / (c + a) END AS cb FROM pairs),
run0 AS (SELECT hh.h AS hour, t.article, SUM(l) AS lhs, SUM(r) AS rhs, SUM(cb) AS cb, COUNT(*) AS k
         FROM terms t JOIN range(0, {upto + 1}) hh(h) ON t.hour <= hh.h GROUP BY 1, 2),
run AS (SELECT (SELECT d FROM lat) AS date, CAST(hour AS INTEGER) AS hour, article,
               CAST(lhs AS BIGINT) AS lhs, CAST(rhs AS BIGINT) AS rhs, cb,
               CASE WHEN rhs = 0 THEN 0.0 ELSE lhs / rhs END AS ratio
        FROM run0 {keep})"""


def _hist_sql(all_days: bool) -> str:
    cond = "" if all_days else "WHERE date < (SELECT d FROM lat)"
    return f"""WITH {_DAY}
SELECT hour, article, CAST(SUM(views) AS BIGINT) AS sum_views, CAST(COUNT(*) AS BIGINT) AS n,
       CAST(SUM(views) // COUNT(*) AS BIGINT) AS avg_views
FROM feed {cond} GROUP BY 1, 2"""


_LATEST = f"""SELECT * FROM ({_trend_sql(10, 6, 1, True)}) ORDER BY window_end DESC, article LIMIT 10"""

_SERVING = f"""WITH lt AS ({_LATEST})
SELECT article, window_start, window_end,
       concat_ws(':', s0, s1, s2, s3, s4, s5) AS series,
       array_to_string(list_transform(range(0, 6),
           lambda i: strftime(window_start + to_minutes(i * 10), '%H:%M:%S')), ',') AS labels,
       'https://en.wikipedia.org/wiki/' || article AS url,
       'https://en.wikipedia.org/wiki/' || right(article, 15) AS link_text,
       article || chr(9) || strftime(window_start, '%H:%M:%S') || chr(9)
           || concat_ws(':', s0, s1, s2, s3, s4, s5) AS text_row
FROM lt"""

ORACLE_SQL: dict[str, str] = {
    "trending_hour": _trend_sql(10, 6, 1, True),
    "trending_day": _trend_sql(240, 6, 60, True),
    "hour_series": _trend_sql(
        10, 6, 1, False,
        extra=", CAST(s0 + s1 + s2 + s3 + s4 + s5 AS BIGINT) AS total_views, "
              "concat_ws(':', s0, s1, s2, s3, s4, s5) AS series"),
    "sliding_counts": _SLIDING,
    "phase_routed_counts": _PHASE,
    "hourly_totals": _HOURLY,
    "parse_requests": _REQ_PARSED + """
SELECT article, ip, TIMESTAMP '1970-01-01' + to_seconds(CAST(tsf AS BIGINT)) AS ts
FROM judged WHERE reason IS NULL""",
    "parse_requests_rejects": _REQ_PARSED + """
SELECT line, reason FROM judged WHERE reason IS NOT NULL""",
    "parse_hourly_logs": _LOG_PARSED + """
SELECT hr AS hour, project, article, views, bytes FROM judged WHERE reason IS NULL""",
    "parse_hourly_logs_rejects": _LOG_PARSED + """
SELECT line, reason FROM judged WHERE reason IS NOT NULL""",
    "parse_window_counts": f"""WITH pr AS ({_PHASE})
SELECT article, strftime(window_start, '%H:%M:%S') AS clock, views FROM pr""",
    "catalogue": """SELECT lower(string_split(p_name, ' ')[2]) AS article FROM part
WHERE lower(string_split(p_name, ' ')[2]) IS NOT NULL""",
    "history_from_logs": _LOG_PARSED + """
SELECT hr AS hour, article, CAST(SUM(views) AS BIGINT) AS sum_views, CAST(COUNT(*) AS BIGINT) AS n,
       CAST(SUM(views) // COUNT(*) AS BIGINT) AS avg_views
FROM judged WHERE reason IS NULL GROUP BY 1, 2""",
    "historical_average": _hist_sql(False),
    "update_history": _hist_sql(True),
    "anomaly_backfill_drop": _run_sql("drop") + """
SELECT date, hour, article, lhs, rhs, round(ratio, 6) AS distance FROM run""",
    "anomaly_backfill_zero": _run_sql("zero") + """
SELECT date, hour, article, lhs, rhs, round(ratio, 6) AS distance FROM run""",
    "anomaly_canberra": _run_sql("zero") + """
SELECT date, hour, article, round(cb, 6) AS distance FROM run""",
    "anomaly_hour0": _run_sql("drop", 0) + """
SELECT date, hour, article, lhs, rhs, round(ratio, 6) AS distance FROM run WHERE hour = 0""",
    "anomaly_step": _run_sql("drop") + """
SELECT date, hour, article, lhs, rhs, round(ratio, 6) AS distance FROM run WHERE hour = 23""",
    "anomaly_step_zero": _run_sql("zero") + """
SELECT date, hour, article, lhs, rhs, round(ratio, 6) AS distance FROM run WHERE hour = 23""",
    "top_anomalies": _run_sql("zero") + """
SELECT date, hour, CAST(rk AS INTEGER) AS rank, article, round(ratio, 6) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY ratio DESC, article) AS rk FROM run)
WHERE rk <= 3""",
    "latest_trending": _LATEST,
    "serving_rows": _SERVING,
    # a stream emits a window once the watermark (latest event time - 10 minutes) passes its end
    "trending_stream": f"""SELECT * FROM ({_trend_sql(10, 6, 1, True)})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "phase_counts_stream": f"""SELECT * FROM ({_PHASE})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "parse_trending_text": f"""SELECT article, strftime(window_start, '%H:%M:%S') AS clock,
       concat_ws(':', s0, s1, s2, s3, s4, s5) AS series FROM ({_trend_sql(10, 6, 1, True)})""",
    # two stages: minutes are emitted once the first watermark passes their end; the second
    # watermark trails the latest emitted minute start by the same delay
    "trending_stream_precount": f"""WITH u AS (SELECT max(ts) - INTERVAL 10 MINUTE AS u FROM events),
mins AS (SELECT date_trunc('minute', ts) AS m FROM events),
d AS (SELECT max(m) - INTERVAL 10 MINUTE AS d FROM mins, u WHERE m + INTERVAL 1 MINUTE <= u.u)
SELECT t.* FROM ({_trend_sql(10, 6, 1, True)}) t, d WHERE t.window_end <= d.d""",
    "promote_day": f"""SELECT * FROM ({_HOURLY}) WHERE date = (SELECT max(CAST(ts AS DATE)) FROM events)""",
    "hourly_totals_stream": f"""SELECT * FROM ({_HOURLY})
WHERE CAST(date AS TIMESTAMP) + to_hours(hour + 1) <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
}

# The whole stream job reads rendered lines: its requests are those that parse.
_GOOD = _trend_sql(10, 6, 1, True).replace("event_type AS article", "article").replace("FROM events", "FROM good")
ORACLE_SQL["trending_stream_job"] = f"""WITH good AS ({ORACLE_SQL["parse_requests"]})
SELECT * FROM ({_GOOD}) WHERE window_end <= (SELECT max(ts) FROM good) - INTERVAL 10 MINUTE"""
# The records' watermark is the end of the last slot that the first stage emitted, less a microsecond.
ORACLE_SQL["series_from_phases"] = f"""SELECT * FROM ({_trend_sql(10, 6, 1, True)})
WHERE window_end < (SELECT max(window_end) FROM ({ORACLE_SQL["phase_counts_stream"]}))"""
ORACLE_SQL["trending_ledger"] = ORACLE_SQL["trending_stream"]
ORACLE_SQL["latest_trending_store"] = _LATEST
# The stored jobs end where the closed forms do; the many-key queries read users as articles.
ORACLE_SQL["fold_day_job"] = ORACLE_SQL["update_history"]
ORACLE_SQL["anomaly_hours_job"] = ORACLE_SQL["top_anomalies"]
ORACLE_SQL["anomaly_repair"] = ORACLE_SQL["anomaly_backfill_zero"]
ORACLE_SQL["anomaly_hours_bucketed"] = ORACLE_SQL["top_anomalies"]
ORACLE_SQL["fold_day_deltas"] = ORACLE_SQL["update_history"]
ORACLE_SQL["extend_history_job"] = ORACLE_SQL["history_from_logs"]
ORACLE_SQL["build_history_job"] = ORACLE_SQL["history_from_logs"]
for _name in ("sliding_counts", "hourly_totals", "anomaly_backfill_zero", "top_anomalies"):
    ORACLE_SQL[f"{_name}_users"] = ORACLE_SQL[_name].replace("event_type", "CAST(user_id AS VARCHAR)")
