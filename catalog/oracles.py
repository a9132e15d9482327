"""The registered queries written independently as SQL for DuckDB.

Each statement starts from the test tables through the named subqueries below.
Sums run over decimals, and rounding is written out, as both engines then give
equal bits.
"""

from __future__ import annotations

import re

COLUMNS = (
    "event_id, customer_id, content_id, event_timestamp, region, device_type,"
    " event_type, watch_minutes, completion_rate, subscription_type, ingest_date"
)


def total(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(24,6))) AS DOUBLE)"


def mean(column: str) -> str:
    return f"({total(column)} / nullif(count({column}), 0))"


def rounded(value: str, places: int) -> str:
    factor = f"CAST({10**places} AS DOUBLE)"
    return f"(floor({value} * {factor} + CAST(0.5 AS DOUBLE)) / {factor})"


def hours(places: int) -> str:
    return rounded(f"({total('watch_minutes')} / CAST(60 AS DOUBLE))", places)


def count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


RATE = mean("completion_rate")
COMPLETED = count_if("completion_rate >= CAST(0.95 AS DOUBLE)")

# Named subqueries; each may use the ones before it.
PARTS: dict[str, str] = {}

PARTS["ev"] = """
SELECT event_id AS e,
  'EVT-' || lpad(CAST(event_id AS VARCHAR),
    greatest(9, length(CAST(event_id AS VARCHAR)))::INTEGER, '0') AS event_id,
  'CUST-' || lpad(CAST(user_id AS VARCHAR),
    greatest(5, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS customer_id,
  'CONT-' || lpad(regexp_extract(props, '[0-9]+', 0),
    greatest(5, length(regexp_extract(props, '[0-9]+', 0)))::INTEGER, '0') AS content_id,
  CAST(ts AS TIMESTAMP) AS event_timestamp,
  CASE WHEN user_id % 10 < 4 THEN 'UK' WHEN user_id % 10 < 7 THEN 'US'
       WHEN user_id % 10 < 9 THEN 'DE' ELSE 'JP' END AS region,
  CASE WHEN event_id % 20 < 6 THEN 'web' WHEN event_id % 20 < 12 THEN 'mobile'
       WHEN event_id % 20 < 16 THEN 'tv' WHEN event_id % 20 < 19 THEN 'console'
       ELSE 'tablet' END AS device_type,
  CASE event_type WHEN 'click' THEN 'play' WHEN 'view' THEN 'launch-view'
       WHEN 'signup' THEN 'pause' WHEN 'purchase' THEN 'complete'
       ELSE 'skip' END AS event_type,
  abs(value) AS watch_minutes,
  CASE WHEN event_type = 'purchase' THEN CAST(95 + event_id % 6 AS DOUBLE)
       ELSE CAST(event_id * 7 % 95 AS DOUBLE) END / CAST(100 AS DOUBLE)
    AS completion_rate,
  CASE WHEN user_id % 10 < 4 THEN 'free' WHEN user_id % 10 < 7 THEN 'basic'
       WHEN user_id % 10 < 9 THEN 'premium' ELSE 'family' END AS subscription_type,
  CAST(ts AS DATE) AS ingest_date,
  CAST(ts AS DATE) AS event_date
FROM events"""

PARTS["meta"] = """
SELECT 'CONT-' || lpad(CAST(p_partkey AS VARCHAR),
    greatest(5, length(CAST(p_partkey AS VARCHAR)))::INTEGER, '0') AS content_id,
  p_name AS title, p_type AS genre, p_brand AS studio,
  CAST(DATE '2018-01-01' + CAST(p_partkey * 37 % 2200 AS INTEGER) AS VARCHAR)
    AS release_date,
  CASE p_size % 5 WHEN 0 THEN 'movie' WHEN 1 THEN 'series'
    WHEN 2 THEN 'documentary' WHEN 3 THEN 'special' ELSE 'short' END AS content_type
FROM part WHERE p_partkey % 23 <> 22"""

PARTS["launch0"] = """
SELECT p_partkey AS p, i, region,
  DATE '2018-01-01' + CAST(p_partkey * 37 % 2200 AS INTEGER)
    + CAST((4 * p_partkey + i) * 11 % 31 AS INTEGER) AS planned,
  CASE WHEN (11 * p_partkey + 5 * i) % 50 = 7 THEN 'cancelled'
       WHEN (7 * p_partkey + 3 * i) % 20 < 3 THEN 'delayed'
       ELSE 'on_time' END AS launch_status
FROM part, (VALUES (0, 'UK'), (1, 'US'), (2, 'DE'), (3, 'JP')) AS r(i, region)"""

PARTS["launches"] = """
SELECT 'CONT-' || lpad(CAST(p AS VARCHAR),
    greatest(5, length(CAST(p AS VARCHAR)))::INTEGER, '0') AS content_id, region,
  CAST(planned AS VARCHAR) AS planned_launch_date,
  CAST(CASE launch_status WHEN 'on_time' THEN planned
    WHEN 'delayed' THEN planned + CAST(1 + (4 * p + i) * 13 % 60 AS INTEGER) END
    AS VARCHAR) AS actual_launch_date,
  launch_status
FROM launch0"""

PARTS["raw"] = f"""
SELECT CASE WHEN e % 700 = 0 THEN NULL ELSE event_id END AS event_id,
  customer_id, content_id,
  CASE WHEN e % 700 = 100 THEN NULL ELSE event_timestamp END AS event_timestamp,
  CASE WHEN e % 700 = 400 OR e % 2100 = 601 THEN 'XX'
       WHEN e % 700 = 450 THEN NULL ELSE region END AS region,
  CASE WHEN e % 700 = 500 THEN 'fridge' ELSE device_type END AS device_type,
  CASE WHEN e % 700 = 600 OR e % 2100 = 601 THEN 'unknown_event_type'
       ELSE event_type END AS event_type,
  CASE WHEN e % 700 = 300 THEN CAST(-1 AS DOUBLE)
       WHEN e % 700 = 350 THEN CAST(99999 AS DOUBLE)
       ELSE watch_minutes END AS watch_minutes,
  CASE WHEN e % 700 = 200 THEN CAST(1.5 AS DOUBLE)
       WHEN e % 700 = 550 THEN NULL ELSE completion_rate END AS completion_rate,
  CASE WHEN e % 700 = 650 THEN 'ultra-premium' ELSE subscription_type END
    AS subscription_type,
  ingest_date
FROM ev
UNION ALL
SELECT event_id, customer_id, content_id,
  event_timestamp + INTERVAL 250 MILLISECONDS, region, device_type, event_type,
  watch_minutes, completion_rate, subscription_type, ingest_date
FROM ev WHERE e % 400 = 1
UNION ALL
SELECT {COLUMNS} FROM ev WHERE e % 2000 = 3
UNION ALL
SELECT 'LATE-' || event_id, customer_id, content_id,
  event_timestamp - to_days(CAST(3 + e % 5 AS INTEGER)), region, device_type,
  event_type, watch_minutes, completion_rate, subscription_type, ingest_date
FROM ev WHERE e % 238 = 5"""


def _enum_part(column: str, label: str, *values: str) -> str:
    domain = ", ".join(f"'{v}'" for v in values)
    return (
        f"CASE WHEN {column} IS NULL THEN 'NULL_{label}' WHEN {column} NOT IN"
        f" ({domain}) THEN 'INVALID_{label}=' || {column} END"
    )


PARTS["checked"] = f"""
SELECT *, CAST(event_timestamp AS DATE) AS event_date,
  CASE WHEN event_id IS NULL THEN 'NULL_EVENT_ID'
    WHEN event_timestamp IS NULL THEN 'INVALID_TIMESTAMP'
    WHEN completion_rate IS NULL THEN 'NULL_COMPLETION_RATE'
    WHEN completion_rate < 0 OR completion_rate > 1
      THEN 'COMPLETION_RATE_OUT_OF_RANGE'
    WHEN watch_minutes IS NULL THEN 'NULL_WATCH_MINUTES'
    WHEN watch_minutes < 0 OR watch_minutes > 1000
      THEN 'WATCH_MINUTES_OUT_OF_RANGE'
    ELSE nullif(concat_ws('; ',
      {_enum_part('region', 'REGION', 'UK', 'US', 'DE', 'JP')},
      {_enum_part('device_type', 'DEVICE', 'web', 'mobile', 'tv', 'console', 'tablet')},
      {_enum_part('event_type', 'EVENT_TYPE', 'play', 'pause', 'complete',
                  'launch-view', 'skip', 'rewind')},
      {_enum_part('subscription_type', 'SUBSCRIPTION', 'free', 'basic', 'premium',
                  'family')}), '')
  END AS rejection_reason
FROM raw"""

PARTS["ranked"] = """
SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
  event_timestamp DESC NULLS LAST, customer_id DESC NULLS LAST,
  content_id DESC NULLS LAST, region DESC NULLS LAST, device_type DESC NULLS LAST,
  event_type DESC NULLS LAST, watch_minutes DESC NULLS LAST,
  completion_rate DESC NULLS LAST, subscription_type DESC NULLS LAST,
  ingest_date DESC NULLS LAST) AS place
FROM checked WHERE rejection_reason IS NULL"""

PARTS["titled"] = """
SELECT ev.*, m.title, m.genre, m.studio, m.release_date, m.content_type
FROM ev LEFT JOIN meta m USING (content_id)"""

PARTS["dd"] = """
SELECT CAST(row_number() OVER (ORDER BY substr(md5(device_type), 1, 3), device_type)
  AS INTEGER) AS device_key, device_type
FROM (SELECT DISTINCT device_type FROM ev)"""

PARTS["dr"] = """
SELECT * FROM (VALUES (1, 'UK', 'United Kingdom'), (2, 'US', 'United States'),
  (3, 'DE', 'Germany'), (4, 'JP', 'Japan')) AS r(region_key, region_code, region_name)"""

PARTS["dc"] = """
SELECT CAST(row_number() OVER (ORDER BY substr(md5(content_id), 1, 3), content_id)
  AS INTEGER) AS content_key, content_id, title, genre, studio,
  CAST(release_date AS DATE) AS release_date, content_type,
  TIMESTAMP '2024-02-01' AS updated_at
FROM meta"""

PARTS["cal"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date,
  CAST(extract(day FROM d) AS INTEGER) AS day,
  CAST(extract(week FROM d) AS INTEGER) AS week,
  CAST(extract(month FROM d) AS INTEGER) AS month,
  CAST(extract(year FROM d) AS INTEGER) AS year,
  CAST(extract(dow FROM d) + 1 AS INTEGER) AS day_of_week
FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '2020-01-01',
  DATE '2030-12-31', INTERVAL 1 DAY) AS s(g))"""


def _fact(source: str, kind: str) -> str:
    """The fact over the rows of a subquery, with an inner or a left lookup."""
    key = (lambda c: f"coalesce({c}, 0)") if kind == "LEFT" else (lambda c: c)
    return f"""
SELECT {key('dc.content_key')} AS content_key, {key('dr.region_key')} AS region_key,
  {key('dd.device_key')} AS device_key,
  CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key,
  CAST(count(*) AS INTEGER) AS views,
  {total('coalesce(watch_minutes, 0)')} AS watch_minutes,
  {rounded(f"({total('coalesce(watch_minutes, 0)')} / CAST(60 AS DOUBLE))", 2)}
    AS watch_hours,
  CAST({COMPLETED} AS INTEGER) AS completed_views,
  {rounded(f"({total('coalesce(completion_rate, 0)')} / count(*))", 4)}
    AS avg_completion_rate
FROM {source} s
{kind} JOIN dc ON s.content_id = dc.content_id
{kind} JOIN dr ON s.region = dr.region_code
{kind} JOIN dd ON s.device_type = dd.device_type
GROUP BY 1, 2, 3, 4"""


PARTS["fv"] = _fact("ev", "INNER")
PARTS["fv_all"] = _fact("ev", "LEFT")


def _with_parts(sql: str) -> str:
    """Put the named subqueries that the statement needs in front of it."""
    needed: set[str] = set()

    def mark(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(
                rf"\b(?:FROM|JOIN)\s+{name}\b", text
            ):
                needed.add(name)
                mark(PARTS[name])

    mark(sql)
    listed = ",\n".join(f"{n} AS ({PARTS[n]})" for n in PARTS if n in needed)
    return f"WITH {listed}\n{sql}" if listed else sql


WEEK = "event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07'"
FORTNIGHT = "event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-24'"


def _daily(source: str, where: str = "true") -> str:
    return f"""
SELECT content_id, region, device_type, event_date, count(*) AS views,
  {total('watch_minutes')} AS total_watch_minutes, {hours(2)} AS total_watch_hours,
  {COMPLETED} AS completed_views, {rounded(RATE, 4)} AS avg_completion_rate
FROM {source} WHERE {where} GROUP BY ALL"""


def _kpis(where: str) -> str:
    return f"""
SELECT count(*) AS total_views, {hours(0)} AS total_watch_hours,
  {rounded(RATE, 2)} AS avg_completion, count(DISTINCT content_id) AS unique_content
FROM ev WHERE {where} AND {FORTNIGHT}"""


_SQL: dict[str, str] = {
    "viewing_events": f"SELECT {COLUMNS} FROM ev",
    "content_metadata": "SELECT * FROM meta",
    "content_launch": "SELECT * FROM launches",
    "validate_valid": f"SELECT {COLUMNS} FROM checked WHERE rejection_reason IS NULL",
    "validate_rejected": f"SELECT {COLUMNS}, rejection_reason FROM checked"
    " WHERE rejection_reason IS NOT NULL",
    "rejection_breakdown": "SELECT rejection_reason, count(*) AS rejected_rows"
    " FROM checked WHERE rejection_reason IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1",
    "dead_letter": """
SELECT ingest_date, rejection_reason, count(*) AS rejected_rows FROM (
  SELECT ingest_date, rejection_reason FROM checked WHERE rejection_reason IS NOT NULL
  UNION ALL SELECT ingest_date, 'DUPLICATE_EVENT_ID' FROM ranked WHERE place > 1)
GROUP BY 1, 2""",
    "dedup_unique": f"SELECT {COLUMNS} FROM ranked WHERE place = 1",
    "dedup_duplicates": f"SELECT {COLUMNS}, 'DUPLICATE_EVENT_ID' AS rejection_reason"
    " FROM ranked WHERE place > 1",
    "normalize_events": """
SELECT event_id, event_timestamp, event_date,
  CAST(extract(year FROM event_timestamp) AS INTEGER) AS year,
  CAST(extract(month FROM event_timestamp) AS INTEGER) AS month,
  CAST(extract(day FROM event_timestamp) AS INTEGER) AS day FROM ev""",
    "enrich_metadata": "SELECT event_id, content_id, title, genre, studio,"
    " release_date, content_type FROM titled",
    "unmatched_content": """
SELECT content_id, count(*) AS events FROM ev
WHERE content_id NOT IN (SELECT content_id FROM meta) GROUP BY 1""",
    "enrich_launch": """
SELECT event_id, ev.content_id, ev.region, planned_launch_date, actual_launch_date,
  launch_status
FROM ev LEFT JOIN launches l ON ev.content_id = l.content_id AND ev.region = l.region""",
    "derived_fields": f"""
SELECT event_id,
  CAST(CAST(actual_launch_date AS DATE) - CAST(planned_launch_date AS DATE) AS INTEGER)
    AS launch_delay_days,
  {rounded("(watch_minutes / CAST(60 AS DOUBLE))", 2)} AS watch_hours,
  coalesce(completion_rate >= CAST(0.95 AS DOUBLE), false) AS is_completed
FROM ev LEFT JOIN launches l ON ev.content_id = l.content_id AND ev.region = l.region""",
    "daily_aggregate": _daily("ev"),
    "salted_daily_sums": f"""
SELECT content_id, event_date, count(*) AS rows,
  {total('watch_minutes')} AS watch_minutes FROM ev GROUP BY 1, 2""",
    "end_to_end_daily": _daily("ranked", "place = 1"),
    "top_content_uk": f"""
SELECT content_id, title, {hours(2)} AS watch_hours, count(*) AS view_count,
  {rounded(RATE, 2)} AS avg_completion
FROM titled WHERE region = 'UK' AND {WEEK} GROUP BY 1, 2
ORDER BY watch_hours DESC, content_id LIMIT 20""",
    "watch_hours_uk": f"""
SELECT region, content_id, {hours(2)} AS watch_hours
FROM ev WHERE region = 'UK' AND {WEEK} GROUP BY 1, 2
ORDER BY watch_hours DESC, region, content_id LIMIT 20""",
    "daily_trend_by_region": f"""
SELECT event_date, region, count(*) AS daily_views, {hours(1)} AS watch_hours
FROM ev WHERE {WEEK} GROUP BY 1, 2 ORDER BY 1, 2""",
    "completion_by_device": f"""
SELECT device_type, count(*) AS total_events, {rounded(RATE, 2)} AS avg_completion_rate,
  {COMPLETED} AS completed_views
FROM ev WHERE {WEEK} GROUP BY 1 ORDER BY total_events DESC""",
    "region_breakdown": f"""
SELECT region, count(DISTINCT content_id) AS unique_content, count(*) AS total_events,
  {hours(1)} AS total_watch_hours
FROM ev WHERE {WEEK} GROUP BY 1 ORDER BY total_watch_hours DESC""",
    "kpi_cards": _kpis("region IN ('UK', 'US', 'DE', 'JP')"),
    "kpi_cards_no_region": _kpis("false"),
    "trend_by_date": f"""
SELECT event_date, count(*) AS views, {hours(1)} AS watch_hours
FROM ev WHERE region IN ('UK', 'DE') AND {FORTNIGHT} GROUP BY 1 ORDER BY 1""",
    "weekly_trend": f"""
SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, count(*) AS views,
  {hours(1)} AS watch_hours
FROM ev WHERE region IN ('UK', 'DE') AND {FORTNIGHT} GROUP BY 1 ORDER BY 1""",
    "device_completion_chart": f"""
SELECT device_type, {rounded(RATE, 2)} AS avg_completion, count(*) AS events
FROM ev WHERE region IN ('US', 'JP') AND {FORTNIGHT} GROUP BY 1 ORDER BY events DESC""",
    "top_titles": f"""
SELECT coalesce(title, content_id) AS title, watch_hours, views FROM (
  SELECT title, content_id, {hours(1)} AS watch_hours, count(*) AS views
  FROM titled WHERE region IN ('UK', 'US') AND {FORTNIGHT} GROUP BY 1, 2
  ORDER BY watch_hours DESC, content_id LIMIT 10)""",
    "launch_success": f"""
SELECT region, count(*) AS total_launches,
  {count_if("launch_status = 'on_time'")} AS on_time,
  {count_if("launch_status = 'delayed'")} AS delayed,
  {count_if("launch_status = 'cancelled'")} AS cancelled,
  CAST({count_if("launch_status = 'on_time'")} AS DOUBLE) / CAST(count(*) AS DOUBLE)
    * CAST(100 AS DOUBLE) AS success_rate
FROM launches GROUP BY 1 ORDER BY 1""",
    "dim_date": """
SELECT cal.*, (SELECT count(*) FROM ev WHERE event_date = calendar_date) AS events
FROM cal""",
    "dim_region": """
SELECT dr.*, events, customers FROM dr LEFT JOIN (
  SELECT region, count(*) AS events, count(DISTINCT customer_id) AS customers
  FROM ev GROUP BY 1) u ON region_code = u.region""",
    "dim_device": "SELECT * FROM dd",
    "dim_content": "SELECT * FROM dc",
    "dim_content_reload": """
SELECT CAST(CASE WHEN old THEN row_number() OVER (PARTITION BY old ORDER BY b, content_id)
    ELSE n_old + row_number() OVER (PARTITION BY old ORDER BY b, content_id) END
    AS INTEGER) AS content_key,
  content_id, new_title AS title, genre, studio, CAST(release_date AS DATE)
    AS release_date, content_type,
  CASE WHEN old AND new_title = title THEN TIMESTAMP '2024-02-01'
    ELSE TIMESTAMP '2024-02-02' END AS updated_at
FROM (SELECT *, substr(md5(content_id), 1, 3) AS b,
    CAST(substr(content_id, 6) AS INTEGER) % 3 <> 0 AS old,
    title || CASE WHEN CAST(substr(content_id, 6) AS INTEGER) % 5 = 0
      THEN ' (new)' ELSE '' END AS new_title,
    (SELECT count(*) FROM meta
      WHERE CAST(substr(content_id, 6) AS INTEGER) % 3 <> 0) AS n_old
  FROM meta)""",
    "scd2_content": """
SELECT * EXCLUDE (n, a, b, changed) FROM (
  SELECT m.*, DATE '2024-01-01' AS valid_from,
    CASE WHEN NOT b OR changed THEN DATE '2024-02-01' END AS valid_to,
    b AND NOT changed AS is_current
  FROM (SELECT *, n % 13 <> 5 AS a, n % 11 <> 4 AS b,
      n % 7 = 0 AS changed FROM (
    SELECT *, CAST(substr(content_id, 6) AS INTEGER) AS n FROM meta)) m WHERE a
  UNION ALL
  SELECT m.* REPLACE (CASE WHEN n % 7 = 0 THEN 'REISSUE' ELSE genre END AS genre),
    DATE '2024-02-01', CAST(NULL AS DATE), true
  FROM (SELECT *, n % 13 <> 5 AS a, n % 11 <> 4 AS b,
      n % 7 = 0 AS changed FROM (
    SELECT *, CAST(substr(content_id, 6) AS INTEGER) AS n FROM meta)) m
  WHERE b AND (NOT a OR changed))""",
    "fact_viewing": "SELECT * FROM fv",
    "fact_content_launch": """
SELECT content_key, region_key,
  CAST(strftime(CAST(planned_launch_date AS DATE), '%Y%m%d') AS INTEGER)
    AS planned_date_key,
  CAST(strftime(CAST(actual_launch_date AS DATE), '%Y%m%d') AS INTEGER)
    AS actual_date_key,
  CAST(CAST(actual_launch_date AS DATE) - CAST(planned_launch_date AS DATE) AS INTEGER)
    AS delay_days,
  launch_status AS status
FROM launches l JOIN dc ON l.content_id = dc.content_id
JOIN dr ON l.region = dr.region_code""",
    "orphan_launches": "SELECT l.* FROM launches l"
    " WHERE l.content_id NOT IN (SELECT content_id FROM meta)",
    "warehouse_top": """
SELECT region_name, title, watch_hours, views, completed_views
FROM fv JOIN dc USING (content_key) JOIN dr USING (region_key)
WHERE watch_hours > 0
ORDER BY watch_hours DESC, content_key, region_key, device_key, date_key LIMIT 10""",
    "star_read": """
SELECT title, region_name, device_type, date_key, views, watch_hours, completed_views
FROM fv JOIN dc USING (content_key) JOIN dr USING (region_key)
JOIN dd USING (device_key)""",
    "views_by_calendar": f"""
SELECT year, week, day_of_week, CAST(sum(views) AS BIGINT) AS views,
  {hours(2)} AS watch_hours
FROM fv JOIN cal USING (date_key) GROUP BY 1, 2, 3""",
    "grain_check": "SELECT event_id, count(*) AS occurrences FROM raw"
    " GROUP BY 1 HAVING count(*) > 1",
    "orphan_check": """
SELECT content_id, count(*) AS fact_rows FROM (
  SELECT DISTINCT content_id, region, device_type, event_date FROM ev)
WHERE content_id NOT IN (SELECT content_id FROM meta) GROUP BY 1""",
    "verify_warehouse": """
SELECT check_name, failures, failures = 0 AS passed FROM (
  SELECT 'repeated_grain' AS check_name, (SELECT count(*) FROM (
    SELECT 1 FROM fv_all GROUP BY content_key, region_key, device_key, date_key
    HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 'orphan_content_key', (SELECT count(*) FROM fv_all
    WHERE content_key <> 0 AND content_key NOT IN (SELECT content_key FROM dc))
  UNION ALL SELECT 'orphan_region_key', (SELECT count(*) FROM fv_all
    WHERE region_key <> 0 AND region_key NOT IN (SELECT region_key FROM dr))
  UNION ALL SELECT 'orphan_device_key', (SELECT count(*) FROM fv_all
    WHERE device_key <> 0 AND device_key NOT IN (SELECT device_key FROM dd))
  UNION ALL SELECT 'orphan_date_key', (SELECT count(*) FROM fv_all
    WHERE date_key NOT IN (SELECT date_key FROM cal)))""",
    "unknown_members": """
SELECT content_key <> 0 AS known_content, count(*) AS fact_rows,
  CAST(sum(views) AS BIGINT) AS views
FROM fv_all GROUP BY 1""",
    "fact_upsert": "SELECT * FROM fact_new UNION ALL SELECT o.* FROM fact_old o"
    " WHERE NOT EXISTS (SELECT 1 FROM fact_new n WHERE n.content_key = o.content_key"
    " AND n.region_key = o.region_key AND n.device_key = o.device_key"
    " AND n.date_key = o.date_key)",
    "affected_dates": """
SELECT event_date, count(*) AS arrived_rows,
  CAST(max(ingest_date - event_date) AS INTEGER) AS max_lateness_days
FROM checked WHERE rejection_reason IS NULL AND ingest_date >= DATE '2024-01-21'
GROUP BY 1""",
    "late_events": """
SELECT event_id, event_date, ingest_date,
  CAST(ingest_date - event_date AS INTEGER) AS lateness_days
FROM checked WHERE rejection_reason IS NULL AND ingest_date - event_date >= 3""",
    "new_partitions": """
SELECT DISTINCT ingest_date FROM raw WHERE ingest_date NOT IN (
  SELECT event_date FROM ev WHERE event_date <= DATE '2024-01-20')""",
    "late_window": "SELECT DISTINCT ingest_date FROM ev"
    " WHERE ingest_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-29'",
    "backfill_range": """
SELECT CAST(d AS DATE) AS ingest_date,
  CASE WHEN n = 0 THEN CAST(-1 AS BIGINT) ELSE n END AS rows
FROM (SELECT g AS d, (SELECT count(*) FROM raw WHERE ingest_date = CAST(g AS DATE)) AS n
  FROM generate_series(DATE '2024-01-25', DATE '2024-02-03', INTERVAL 1 DAY) AS s(g))""",
    "fingerprint": """
SELECT ingest_date, region, count(*) AS rows, bit_xor(h) AS hash_xor,
  CAST(sum(h % 2147483648) AS DECIMAL(30,0)) AS hash_sum
FROM (SELECT ingest_date, region, CAST('0x' || substr(md5(array_to_string(
    list_transform([
      CASE WHEN TRY_CAST(completion_rate AS DECIMAL(24,6)) = completion_rate
        THEN CAST(TRY_CAST(completion_rate AS DECIMAL(24,6)) AS VARCHAR)
        ELSE CAST(completion_rate AS VARCHAR) END,
      content_id, customer_id, device_type, event_id,
      CAST(epoch_us(event_timestamp) AS VARCHAR), event_type, subscription_type,
      CASE WHEN TRY_CAST(watch_minutes AS DECIMAL(24,6)) = watch_minutes
        THEN CAST(TRY_CAST(watch_minutes AS DECIMAL(24,6)) AS VARCHAR)
        ELSE CAST(watch_minutes AS VARCHAR) END],
      lambda v: coalesce(length(v) || ':' || v, '~')), '')), 1, 15)
    AS BIGINT) AS h
  FROM ev)
GROUP BY 1, 2""",
    "verify_rerun": """
SELECT event_date, count(*) AS rows_before, count(*) AS rows_after,
  event_date <> DATE '2024-01-01' AS is_same
FROM ev GROUP BY 1""",
    "quality_metrics": """
SELECT count(*) AS input_rows,
  count(rejection_reason) AS rejected_rows,
  count(*) FILTER (WHERE rejection_reason IS NULL)
    - count(DISTINCT event_id) FILTER (WHERE rejection_reason IS NULL)
    AS duplicate_rows,
  count(DISTINCT event_id) FILTER (WHERE rejection_reason IS NULL) AS output_rows,
  count(*) - count(event_id) AS null_event_id,
  count(*) - count(event_timestamp) AS null_event_timestamp,
  count(*) - count(region) AS null_region,
  count(*) - count(completion_rate) AS null_completion_rate,
  count(*) FILTER (WHERE completion_rate NOT BETWEEN 0 AND 1)
    AS outside_completion_rate,
  count(*) FILTER (WHERE watch_minutes NOT BETWEEN 0 AND 1000)
    AS outside_watch_minutes
FROM checked""",
    "category_mix": " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, {c} AS value, count(*) AS rows,"
        f" CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM ev) AS DOUBLE) AS share"
        f" FROM ev GROUP BY {c}"
        for c in ("device_type", "event_type", "subscription_type", "region")
    ),
    "written_partitions": "SELECT event_date, region, count(*) AS rows,"
    " true AS has_files FROM ev GROUP BY 1, 2",
    "csv_vs_parquet": f"""
SELECT source_format, region, content_id, watch_hours FROM (
  SELECT region, content_id, {hours(2)} AS watch_hours FROM ev
  WHERE region = 'UK' AND {WEEK} GROUP BY 1, 2
  ORDER BY watch_hours DESC, region, content_id LIMIT 20),
  (VALUES ('csv'), ('parquet')) AS f(source_format)""",
    "anomaly_flags": """
SELECT event_id, long_view, instant_completion, idle_skip,
  CAST(long_view AS INTEGER) + CAST(instant_completion AS INTEGER)
    + CAST(idle_skip AS INTEGER) AS flags,
  long_view OR instant_completion OR idle_skip AS is_anomaly
FROM (SELECT event_id, watch_minutes > 300 AS long_view,
    event_type = 'complete' AND watch_minutes < 1 AS instant_completion,
    event_type = 'skip' AND completion_rate > CAST(0.9 AS DOUBLE) AS idle_skip
  FROM ev)""",
    "label_metrics": """
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives,
  tn AS true_negatives, CAST(tp AS DOUBLE) / CAST(nullif(tp + fp, 0) AS DOUBLE)
    AS precision,
  CAST(tp AS DOUBLE) / CAST(nullif(tp + fn, 0) AS DOUBLE) AS recall,
  CAST(fp AS DOUBLE) / CAST(nullif(fp + tn, 0) AS DOUBLE) AS false_positive_rate
FROM (SELECT count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS tp,
    count(*) FILTER (WHERE quality = 0 AND toxic <> 1) AS fp,
    count(*) FILTER (WHERE quality <> 0 AND toxic = 1) AS fn,
    count(*) FILTER (WHERE quality <> 0 AND toxic <> 1) AS tn
  FROM labels)""",
    "lineitem_daily": f"""
SELECT l_partkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date,
  count(*) AS views, {total('l_extendedprice')} AS total_watch_minutes,
  {rounded(f"({total('l_extendedprice')} / CAST(60 AS DOUBLE))", 2)}
    AS total_watch_hours,
  count(*) FILTER (WHERE l_discount * 10 >= CAST(0.95 AS DOUBLE)) AS completed_views,
  {rounded(mean('(l_discount * 10)'), 4)} AS avg_completion_rate
FROM lineitem GROUP BY ALL""",
    "lineitem_dedup": """
SELECT * EXCLUDE (place) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC,
    l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
    l_linestatus DESC) AS place
  FROM lineitem) WHERE place = 1""",
    "lineitem_superseded": """
SELECT l_orderkey, count(*) AS superseded_lines,
  CAST(max(l_shipdate) AS DATE) AS last_shipped
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC) AS place
  FROM lineitem) WHERE place > 1 GROUP BY 1""",
    "lineitem_star": """
SELECT n_name, p_type, count(*) AS line_items,
  CAST(sum(CAST(l_quantity AS DECIMAL(24,6))) AS DOUBLE) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1, 2""",
}


def _skew(key: str) -> str:
    return f"""
SELECT {key}, rows, CAST(rows AS DOUBLE) / CAST(sum(rows) OVER () AS DOUBLE) AS share,
  rank() OVER (ORDER BY rows DESC) AS rank
FROM (SELECT {key}, count(*) AS rows FROM ev GROUP BY 1)"""


def _hourly(source: str) -> str:
    return f"""
SELECT date_trunc('hour', event_timestamp) AS window_start,
  date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end,
  region, event_type, count(*) AS events
FROM {source} GROUP BY ALL"""


_SQL["hourly_counts"] = _hourly("ev")
_SQL["stream_hourly_counts"] = _hourly("ev")
_SQL["stream_unique_ids"] = (
    "SELECT DISTINCT event_id, content_id FROM checked WHERE rejection_reason IS NULL"
)
_SQL["stream_arrivals"] = """
SELECT CASE WHEN rejection_reason IS NULL THEN 'valid' ELSE 'rejected' END AS status,
  ingest_date, count(*) AS events
FROM checked GROUP BY 1, 2"""
_SQL["stream_anomalies"] = f"""
SELECT event_id, flags FROM ({_SQL['anomaly_flags']}) WHERE is_anomaly"""
_SQL["incremental_daily"] = _SQL["end_to_end_daily"]
_SQL["skew_profile"] = _skew("content_id")
_SQL["skew_profile_customers"] = _skew("customer_id")
_SQL["enrich_launch_merge"] = _SQL["enrich_launch"]
_SQL["enrich_launch_colocated"] = _SQL["enrich_launch"]

PARTS["ev_old"] = """
SELECT * FROM ev WHERE event_date <= DATE '2024-01-20' AND region IN ('UK', 'US')"""
PARTS["ev_new"] = "SELECT * FROM ev WHERE event_date >= DATE '2024-01-15'"
PARTS["history"] = """
SELECT content_id AS id, genre, DATE '2024-01-03' AS valid_from,
  CASE WHEN n % 11 = 4 OR n % 7 = 0 THEN DATE '2024-01-15' END AS valid_to
FROM (SELECT *, CAST(substr(content_id, 6) AS INTEGER) AS n FROM meta) WHERE n % 13 <> 5
UNION ALL
SELECT content_id, CASE WHEN n % 7 = 0 THEN 'REISSUE' ELSE genre END,
  DATE '2024-01-15', NULL
FROM (SELECT *, CAST(substr(content_id, 6) AS INTEGER) AS n FROM meta)
WHERE n % 11 <> 4 AND (n % 13 = 5 OR n % 7 = 0)"""
PARTS["fact_old"] = _fact("ev_old", "INNER")
PARTS["fact_new"] = _fact("ev_new", "INNER")
PARTS["winners"] = "SELECT * FROM ranked WHERE place = 1"
PARTS["fact_all_won"] = _fact("winners", "LEFT")

_SQL["warehouse_tables"] = """
SELECT title, region_name, device_type, date_key, views, watch_hours, completed_views
FROM fact_all_won LEFT JOIN dc USING (content_key) JOIN dr USING (region_key)
JOIN dd USING (device_key)"""
_SQL["incremental_enriched"] = f"""
SELECT event_id, ingest_date, event_date, title, launch_status,
  CAST(CAST(actual_launch_date AS DATE) - CAST(planned_launch_date AS DATE) AS INTEGER)
    AS launch_delay_days,
  {rounded("(watch_minutes / CAST(60 AS DOUBLE))", 2)} AS watch_hours
FROM winners w LEFT JOIN meta USING (content_id)
LEFT JOIN launches l ON w.content_id = l.content_id AND w.region = l.region"""
_SQL["incremental_duplicates"] = f"SELECT {COLUMNS} FROM ranked WHERE place > 1"

_SQL["incremental_restated"] = f"""
SELECT *, event_date IN (
  SELECT event_date FROM winners
  WHERE content_id IN (SELECT content_id FROM meta)
      AND CAST(substr(content_id, 6) AS INTEGER) % 40 = 0
    OR content_id IN (SELECT content_id FROM launches) AND region = 'JP'
      AND CAST(substr(content_id, 6) AS INTEGER) % 60 = 7) AS restated
FROM ({_SQL['incremental_enriched']})"""
_SQL["reference_rejects"] = """
SELECT reference, content_id, rejection_reason, count(*) AS rows FROM (
  SELECT 'content_metadata' AS reference, CASE WHEN n % 50 <> 11 THEN content_id END AS content_id,
    CASE WHEN n % 50 IN (7, 9) THEN 'MALFORMED_ROW' WHEN n % 50 = 11 THEN 'NULL_CONTENT_ID'
      WHEN n % 50 = 13 THEN 'REPEATED_KEY' END AS rejection_reason
  FROM (SELECT *, CAST(substr(content_id, 6) AS INTEGER) AS n FROM meta)
  UNION ALL
  SELECT 'content_launch', CASE WHEN n % 50 <> 11 THEN content_id END,
    CASE WHEN n % 50 IN (7, 9) THEN 'MALFORMED_ROW' WHEN n % 50 = 11 THEN 'NULL_CONTENT_ID'
      WHEN n % 40 = 3 THEN 'INVALID_LAUNCH_STATUS=postponed' END
  FROM (SELECT *, CAST(substr(content_id, 6) AS INTEGER) AS n FROM launches))
WHERE rejection_reason IS NOT NULL GROUP BY 1, 2, 3"""
_SQL["stream_outcomes"] = """
SELECT outcome, count(*) AS events FROM (
  SELECT CASE WHEN is_late THEN 'late'
    WHEN row_number() OVER (PARTITION BY event_id, is_late ORDER BY ingest_date) = 1 THEN 'unique'
    ELSE 'duplicate' END AS outcome
  FROM (SELECT *, ingest_date > DATE '2024-01-15' AND event_timestamp < (
      SELECT max(event_timestamp) - INTERVAL 2 DAY FROM checked
      WHERE rejection_reason IS NULL AND ingest_date <= DATE '2024-01-15') AS is_late
    FROM checked WHERE rejection_reason IS NULL))
GROUP BY 1"""
_SQL["run_log"] = """
SELECT CASE WHEN ingest_date <= DATE '2024-01-15' THEN 'run0' ELSE 'run1' END AS run_id,
  count(*) AS input_rows,
  count(*) FILTER (WHERE rejection_reason IS NULL) AS output_rows, 7::BIGINT AS stages
FROM checked GROUP BY 1
UNION ALL SELECT 'latest', NULL, (SELECT count(*) FROM winners), NULL"""
_SQL["dead_letter_written"] = """
SELECT ingest_date, rejection_reason, count(*) AS rows FROM checked
WHERE rejection_reason IS NOT NULL GROUP BY 1, 2"""
_SQL["one_partition"] = """
SELECT content_id, count(*) AS events FROM ev
WHERE event_date = DATE '2024-01-09' AND region = 'UK' GROUP BY 1"""
_SQL["parquet_baseline"] = "SELECT event_date, count(*) AS events FROM ev GROUP BY 1"

for _name in (
    "kpi_cards", "daily_trend_by_region", "completion_by_device", "watch_hours_uk",
    "top_content_uk",
):
    _SQL[f"{_name}_from_daily"] = _SQL[_name]
_SQL["region_breakdown_from_bitmaps"] = _SQL["region_breakdown"]
_SQL["versions_as_of"] = """
SELECT e.event_id, e.content_id, CASE WHEN ended THEN NULL ELSE genre END AS genre,
  CASE WHEN ended THEN NULL ELSE valid_from END AS valid_from
FROM (SELECT e.*, h.*, coalesce(e.event_timestamp >= h.valid_to, false) AS ended
  FROM ev e ASOF LEFT JOIN history h
    ON e.content_id = h.id AND e.event_timestamp >= h.valid_from) e"""
_SQL["compacted_partitions"] = """
SELECT event_date, region, count(*) AS rows, true AS is_one_file FROM ev GROUP BY 1, 2"""
_SQL["anomaly_metrics"] = """
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives,
  tn AS true_negatives, CAST(tp AS DOUBLE) / CAST(nullif(tp + fp, 0) AS DOUBLE)
    AS precision,
  CAST(tp AS DOUBLE) / CAST(nullif(tp + fn, 0) AS DOUBLE) AS recall,
  CAST(fp AS DOUBLE) / CAST(nullif(fp + tn, 0) AS DOUBLE) AS false_positive_rate
FROM (SELECT count(*) FILTER (WHERE odd AND bad) AS tp,
    count(*) FILTER (WHERE odd AND NOT bad) AS fp,
    count(*) FILTER (WHERE NOT odd AND bad) AS fn,
    count(*) FILTER (WHERE NOT odd AND NOT bad) AS tn
  FROM (SELECT rejection_reason IS NOT NULL AS bad,
      coalesce(watch_minutes > 300, false)
        OR coalesce(event_type = 'complete' AND watch_minutes < 1, false)
        OR coalesce(event_type = 'skip' AND completion_rate > CAST(0.9 AS DOUBLE), false)
        AS odd
    FROM checked))"""


def statements() -> dict[str, str]:
    return {name: _with_parts(sql) for name, sql in _SQL.items()}
