"""The same results in ANSI SQL over the given tables."""

from __future__ import annotations

from verification.inputs import AS_OF, CLOCK_SPEED, CLOCK_START_S, LOCATIONS
from verification.queries import METRICS_AS_OF

_PLACES = "[" + ", ".join(f"'{x}'" for x in LOCATIONS) + "]"

_SENT = f"""
sent AS (
  SELECT event_id, copy, ts, epoch_us(ts) // 1000 AS "timestamp", CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_id % 17 = 0 THEN NULL
              WHEN event_id % 23 = 0 THEN CAST('NaN' AS FLOAT)
              ELSE CAST(json_extract_string(props, '$.k') AS FLOAT) END AS upload_speed,
         CAST(value AS FLOAT) AS download_speed,
         CAST(event_id % 99 + 1 AS FLOAT) AS latency,
         {_PLACES}[CAST(event_id % 10 AS INT) + 1] AS location
  FROM (SELECT *, unnest(CASE WHEN event_id % 10 = 3 THEN [0, 1] ELSE [0] END) AS copy FROM events)
)"""

_LAYERS = f"""
{_SENT},
bronze AS (
  SELECT "timestamp", user_id, upload_speed, download_speed, latency, location,
         CAST(make_timestamp("timestamp" * 1000) AS DATE) AS date
  FROM sent
),
all_bronze AS (
  SELECT * FROM bronze
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM documents
),
present AS (
  SELECT * FROM bronze
  WHERE "timestamp" IS NOT NULL AND user_id IS NOT NULL AND location IS NOT NULL AND date IS NOT NULL
    AND upload_speed IS NOT NULL AND NOT isnan(upload_speed)
    AND download_speed IS NOT NULL AND NOT isnan(download_speed)
    AND latency IS NOT NULL AND NOT isnan(latency)
),
silver AS (
  SELECT * FROM present
  QUALIFY row_number() OVER (PARTITION BY user_id, "timestamp"
                             ORDER BY upload_speed, download_speed, latency, location, date) = 1
),
gold AS (
  SELECT date, location, CAST(hour(make_timestamp("timestamp" * 1000)) AS INT) AS hour,
         avg(CAST(upload_speed AS DOUBLE)) AS avg_upload_speed,
         avg(CAST(download_speed AS DOUBLE)) AS avg_download_speed,
         avg(CAST(latency AS DOUBLE)) AS avg_latency
  FROM silver GROUP BY ALL
)"""

_SECOND = f'({CLOCK_START_S} + ("timestamp" - {CLOCK_START_S * 1000}) // {1000 * CLOCK_SPEED})'


def _row_count_samples(layer: str, second: str) -> str:
    return f"""
  SELECT '{layer}_table_row_count' AS metric, 'all' AS series, NULL AS job_id, NULL AS query_id, second,
         CAST(sum(n) OVER (ORDER BY second) AS DOUBLE) AS value
  FROM (SELECT {second} - {second} % 30 AS second, count(*) AS n FROM {layer} GROUP BY ALL)"""


_GOLD_SECOND = (
    f"({CLOCK_START_S} + ((date - DATE '1970-01-01') * 24 + hour) * 3600 // {CLOCK_SPEED}"
    f" - {CLOCK_START_S} // {CLOCK_SPEED})"
)

_SAMPLES = f"""
{_LAYERS},
samples AS (
  SELECT 'kafka_server_brokertopicmetrics_messagesin_total' AS metric, location AS series,
         NULL AS job_id, NULL AS query_id, second,
         CAST(sum(n) OVER (PARTITION BY location, date ORDER BY second) AS DOUBLE) AS value
  FROM (SELECT location, date, {_SECOND} AS second, count(*) AS n FROM bronze GROUP BY ALL)
  UNION ALL {_row_count_samples('bronze', _SECOND)}
  UNION ALL {_row_count_samples('silver', _SECOND)}
  UNION ALL {_row_count_samples('gold', _GOLD_SECOND)}
  UNION ALL
  SELECT 'table_last_update_timestamp', 'all', NULL, NULL, {_SECOND} - {_SECOND} % 30 AS second,
         CAST(max({_SECOND}) AS DOUBLE)
  FROM bronze GROUP BY ALL
  UNION ALL
  SELECT 'spark_job_duration', user_id, event_type, NULL, second, CAST(max(value) AS DOUBLE)
  FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS FLOAT) AS value,
               {CLOCK_START_S} + (epoch_us(ts) // 1000 - {CLOCK_START_S * 1000}) // {60000 * CLOCK_SPEED} * 60 AS second
        FROM events)
  GROUP BY ALL
  UNION ALL
  SELECT 'trino_query_elapsed_time_seconds', user_id, NULL, location, {_SECOND} - {_SECOND} % 60 AS second,
         CAST(max(latency) AS DOUBLE)
  FROM bronze GROUP BY ALL
)"""

_ROWS = """CAST("timestamp" AS VARCHAR) AS "timestamp", user_id,
  CASE WHEN isnan(upload_speed) THEN NULL ELSE round(CAST(upload_speed AS DOUBLE), 6) END AS upload_speed,
  round(CAST(download_speed AS DOUBLE), 6) AS download_speed,
  round(CAST(latency AS DOUBLE), 6) AS latency, location"""
_NAN = "coalesce(isnan(upload_speed), false) AS upload_is_nan"
_DATED_ROWS = f"{_ROWS}, CAST(date AS VARCHAR) AS date, {_NAN}"
_GOLD_ROWS = """CAST(date AS VARCHAR) AS date, location, hour, round(avg_upload_speed, 6) AS avg_upload_speed,
  round(avg_download_speed, 6) AS avg_download_speed, round(avg_latency, 6) AS avg_latency"""


def _rate(metric: str, seconds: int) -> str:
    return f"""
one AS (
  SELECT series, second, max(value) AS value FROM samples WHERE metric = '{metric}' GROUP BY ALL
),
grown AS (
  SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN 0
                 WHEN value < lag(value) OVER w THEN value
                 ELSE value - lag(value) OVER w END AS increase
  FROM one WINDOW w AS (PARTITION BY series ORDER BY second)
),
rates AS (
  SELECT series, second AS ts,
         (sum(increase) OVER w - first_value(increase) OVER w)
           / nullif(second - first_value(second) OVER w, 0) AS rate
  FROM grown
  WINDOW w AS (PARTITION BY series ORDER BY second RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)
)"""


def _message(table: str) -> str:
    def member(name: str, text: str, before: str = ",") -> str:
        return f"coalesce('{before}\"{name}\":' || {text}, '')"

    def number(name: str) -> str:
        return f"CASE WHEN isnan({name}) THEN '\"NaN\"' ELSE CAST({name} AS VARCHAR) END"

    return (
        "SELECT '{\"timestamp\":' || CAST(\"timestamp\" AS VARCHAR) || "
        + " || ".join(
            [
                member("user_id", "'\"' || user_id || '\"'"),
                member("upload_speed", number("upload_speed")),
                member("download_speed", number("download_speed")),
                member("latency", number("latency")),
                member("location", "'\"' || location || '\"'"),
            ]
        )
        + f" || '}}' AS message FROM {table}"
    )


_STATISTICS = ", ".join(
    f"""round(avg(CAST({m} AS DOUBLE)), 6) AS avg_{m}, round(min(CAST({m} AS DOUBLE)), 6) AS min_{m},
  round(max(CAST({m} AS DOUBLE)), 6) AS max_{m},
  round(quantile_cont(CAST({m} AS DOUBLE), 0.5), 6) AS p50_{m},
  round(quantile_cont(CAST({m} AS DOUBLE), 0.95), 6) AS p95_{m}"""
    for m in ("upload_speed", "download_speed", "latency")
)

_MISSING = ", ".join(
    f"count(*) FILTER ({c} IS NULL OR coalesce(isnan({c}), false)) AS missing_{c}"
    if c in ("upload_speed", "download_speed", "latency")
    else f'count(*) FILTER ("{c}" IS NULL) AS missing_{c}'
    for c in ("timestamp", "user_id", "upload_speed", "download_speed", "latency", "location", "date")
)

_COUNTS = """
counts AS (
  SELECT 'bronze' AS layer, (SELECT count(*) FROM all_bronze) AS row_count
  UNION ALL SELECT 'silver', (SELECT count(*) FROM silver)
  UNION ALL SELECT 'gold', (SELECT count(*) FROM gold)
)"""


def _colour(value: str, base: str, *steps: tuple[int, str]) -> str:
    whens = " ".join(f"WHEN {value} >= {bound} THEN '{colour}'" for bound, colour in sorted(steps, reverse=True))
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{base}' END"


def _newest(metric: str) -> str:
    return f"arg_max(value, second) FILTER (metric = '{metric}')"


def _on_grid(metric: str) -> str:
    """The newest value, of the last 300 seconds, of each series at every step of 15 seconds."""
    return f"""
      SELECT series, job_id, query_id, t, arg_max(value, second) AS value
      FROM (SELECT *, unnest(range(CAST(ceil(second / 15.0) AS BIGINT) * 15, second + 301, 15)) AS t
            FROM samples WHERE metric = '{metric}')
      GROUP BY series, job_id, query_id, t"""


_JOBS = """
jobs AS (
  SELECT 'ingest_bronze' AS job, 'bronze' AS layer, (SELECT count(*) FROM all_bronze) AS rows_in,
         (SELECT count(*) FROM all_bronze WHERE date IS NULL) AS rows_rejected, (SELECT count(*) FROM all_bronze) AS rows_out
  UNION ALL
  SELECT 'bronze_to_silver', 'silver', (SELECT count(date) FROM all_bronze),
         (SELECT count(date) FROM all_bronze) - (SELECT count(*) FROM present), (SELECT count(*) FROM silver)
  UNION ALL
  SELECT 'silver_to_gold', 'gold', (SELECT count(*) FROM silver), 0, (SELECT count(*) FROM gold)
)"""


#: Bronze has each message twice, once from either; the layers above have each key once.
_TWICE_BRONZE = "SELECT layer, CASE layer WHEN 'bronze' THEN 2 * row_count ELSE row_count END AS row_count FROM counts"


def oracle_sql() -> dict[str, str]:
    over_layers = {
        "scan_messages": f"""
            SELECT 'measurements' AS topic, partition, 0 AS "timestampType", count(*) AS messages,
                   min("offset") AS first_offset, max("offset") AS last_offset,
                   max(CAST(floor(epoch(ts)) AS BIGINT)) AS last_time,
                   CAST(sum(length(message)) AS BIGINT) AS characters
            FROM (SELECT CAST(event_id % 3 AS INT) AS partition, event_id * 2 + copy AS "offset", ts, message
                  FROM ({_message('sent').replace(' AS message', ' AS message, event_id, copy, ts')})
                  UNION ALL SELECT 3, doc_id, TIMESTAMP '{AS_OF} 00:00:00', text FROM documents)
            GROUP BY ALL""",
        "scan_bronze": f"SELECT {_DATED_ROWS} FROM all_bronze",
        "scan_silver": f"SELECT {_DATED_ROWS} FROM silver",
        "scan_gold": f"SELECT {_GOLD_ROWS} FROM gold",
        "scan_silver_dates": f"SELECT {_DATED_ROWS} FROM silver WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
        "publish_messages": _message("bronze"),
        "encode_json": _message("silver"),
        "parse_messages": f"SELECT {_ROWS}, {_NAN} FROM all_bronze",
        "bronze_lineage": f"""
            SELECT user_id, location, CAST(CAST(make_timestamp("timestamp" * 1000) AS DATE) AS VARCHAR) AS date,
                   'measurements' AS _topic, CAST(event_id % 3 AS INT) AS _partition,
                   event_id * 2 + copy AS _offset, CAST(floor(epoch(ts)) AS BIGINT) AS _ingest_ts
            FROM sent
            UNION ALL
            SELECT NULL, NULL, NULL, 'measurements', 3, doc_id,
                   CAST(epoch(TIMESTAMP '{AS_OF} 00:00:00') AS BIGINT) FROM documents""",
        "add_date": f"SELECT {_DATED_ROWS} FROM bronze",
        "add_date_if_missing": """
            SELECT '-' AS date, 'kept' AS layer, count(*) AS row_count FROM bronze
            UNION ALL SELECT CAST(date + 1 AS VARCHAR), 'kept, by date', count(*) FROM bronze GROUP BY ALL
            UNION ALL SELECT CAST(date AS VARCHAR), 'derived, by date', count(*) FROM bronze GROUP BY ALL""",
        "add_hour": f'SELECT {_ROWS}, CAST(hour(make_timestamp("timestamp" * 1000)) AS INT) AS hour, {_NAN} FROM bronze',
        "add_hour_seconds": """
            SELECT location, CAST("timestamp" % 86400 // 3600 AS INT) AS hour, count(*) AS n FROM bronze GROUP BY ALL""",
        "drop_nulls": f"SELECT {_DATED_ROWS} FROM present",
        "dedup": f"""
            SELECT {_DATED_ROWS} FROM (
              SELECT s."timestamp", s.user_id, s.upload_speed, s.download_speed,
                     CAST(s.latency + s.copy AS FLOAT) AS latency, s.location,
                     CAST(make_timestamp(s."timestamp" * 1000) AS DATE) AS date
              FROM sent s
              WHERE s.upload_speed IS NOT NULL AND NOT isnan(s.upload_speed)
                AND s.download_speed IS NOT NULL AND s.location IS NOT NULL
            ) QUALIFY row_number() OVER (PARTITION BY user_id, "timestamp"
                        ORDER BY upload_speed, download_speed, latency, location, date) = 1""",
        "clean": f"SELECT {_DATED_ROWS} FROM silver",
        "gold_hourly": f"SELECT {_GOLD_ROWS} FROM gold",
        "gold_kpis": f"""
            SELECT CAST(date AS VARCHAR) AS date, location,
                   CAST(hour(make_timestamp("timestamp" * 1000)) AS INT) AS hour,
                   count(*) AS sample_count, {_STATISTICS}
            FROM silver GROUP BY 1, 2, 3""",
        "date_distribution": "SELECT CAST(date AS VARCHAR) AS date, count(*) AS count FROM all_bronze GROUP BY ALL",
        "top_locations": f"""
            SELECT location, round(avg(avg_download_speed), 6) AS avg_dl FROM gold
            WHERE date >= DATE '{AS_OF}' - INTERVAL '1' DAY
            GROUP BY location ORDER BY avg(avg_download_speed) DESC NULLS LAST, location LIMIT 10""",
        "top_locations_weighted": f"""
            SELECT location, round(avg(CAST(download_speed AS DOUBLE)), 6) AS avg_dl, count(*) AS sample_count
            FROM silver WHERE date >= DATE '{AS_OF}' - INTERVAL '1' DAY
            GROUP BY location ORDER BY avg(CAST(download_speed AS DOUBLE)) DESC NULLS LAST, location LIMIT 10""",
        "hourly_trend": """
            SELECT CAST(date AS VARCHAR) AS date, hour, round(avg(avg_download_speed), 6) AS avg_dl,
                   round(avg(avg_upload_speed), 6) AS avg_ul
            FROM gold WHERE location = 'New York' GROUP BY date, hour ORDER BY date, hour""",
        "latency_by_location": """
            SELECT location, round(avg(avg_latency), 6) AS avg_latency FROM gold GROUP BY location ORDER BY 2, 1""",
        "gold_today": f"""
            SELECT CAST(date AS VARCHAR) AS date, location, round(avg_upload_speed, 6) AS avg_upload_speed,
                   round(avg_download_speed, 6) AS avg_download_speed, round(avg_latency, 6) AS avg_latency
            FROM gold WHERE date = DATE '{AS_OF}'""",
        "gold_sql": f"""
            SELECT location, count(*) AS hours, round(avg(avg_download_speed), 6) AS avg_dl,
                   round(avg(avg_latency), 6) AS avg_latency
            FROM gold WHERE date >= DATE '{AS_OF}' - INTERVAL '1' DAY GROUP BY location""",
        "preview_rows": f'SELECT {_DATED_ROWS} FROM silver ORDER BY silver.user_id, silver."timestamp" LIMIT 10',
        "bronze_append": """
            SELECT CAST(date AS VARCHAR) AS date, location, 2 * count(*) AS n FROM bronze GROUP BY date, location""",
        "silver_overwrite_partitions": f"""
            SELECT {_DATED_ROWS} FROM (
              SELECT * REPLACE (CASE WHEN date >= DATE '2024-01-16' THEN latency * 2 ELSE latency END AS latency)
              FROM silver)""",
        "gold_overwrite_partitions": f"""
            SELECT {_GOLD_ROWS} FROM gold g
            WHERE g.location <> 'Berlin' OR g.hour < 12
               OR NOT EXISTS (SELECT 1 FROM gold h WHERE h.location = 'Berlin' AND h.date = g.date AND h.hour < 12)""",
        "run_medallion": f"SELECT {_GOLD_ROWS} FROM gold",
        "run_medallion_daily": f"SELECT {_GOLD_ROWS} FROM gold",
        "ddl_layers": """
            SELECT 'bronze' AS layer, 7 AS columns, count(DISTINCT date) AS dates, count(*) AS row_count FROM all_bronze
            UNION ALL SELECT 'silver', 7, count(DISTINCT date), count(*) FROM silver
            UNION ALL SELECT 'gold', 6, count(DISTINCT date), count(*) FROM gold""",
        "quality_report": f"""
            SELECT count(*) AS rows_in, {_MISSING},
                   count(*) FILTER ("timestamp" IS NULL AND user_id IS NULL AND upload_speed IS NULL
                     AND download_speed IS NULL AND latency IS NULL AND location IS NULL) AS malformed,
                   count(*) - (SELECT count(*) FROM present) AS rejected,
                   (SELECT count(*) FROM present) - (SELECT count(*) FROM silver) AS duplicates,
                   (SELECT count(*) FROM silver) AS survivors
            FROM all_bronze""",
        "stream_bronze": f"SELECT {_DATED_ROWS} FROM all_bronze",
        "stream_silver": f"SELECT {_DATED_ROWS} FROM silver",
        "stream_silver_stateful": f"SELECT {_DATED_ROWS} FROM silver",
        "stream_gold_hourly": f"SELECT {_GOLD_ROWS} FROM gold",
        "stream_silver_smallest": f"""
            SELECT * FROM (SELECT {_DATED_ROWS} FROM (
              SELECT s."timestamp", s.user_id, s.upload_speed, s.download_speed,
                     CAST(s.latency + s.copy AS FLOAT) AS latency, s.location,
                     CAST(make_timestamp(s."timestamp" * 1000) AS DATE) AS date
              FROM sent s
              WHERE s.upload_speed IS NOT NULL AND NOT isnan(s.upload_speed)
                AND s.download_speed IS NOT NULL AND s.location IS NOT NULL
            ) QUALIFY row_number() OVER (PARTITION BY user_id, "timestamp"
                        ORDER BY upload_speed, download_speed, latency, location, date) = 1)
            WHERE CAST("timestamp" AS BIGINT) <= (SELECT max("timestamp") FROM present) - 36 * 3600 * 1000""",
        "stream_gold_incremental": f"SELECT {_GOLD_ROWS} FROM gold",
        "redo_changed_day": """
            SELECT 1 AS turn, 'bronze_to_silver' AS job, count(*) AS rows_out FROM silver WHERE NOT (date = DATE '2024-01-09' AND location = 'Tokyo')
            UNION ALL SELECT 1, 'silver_to_gold', count(*) FROM gold WHERE NOT (date = DATE '2024-01-09' AND location = 'Tokyo')
            UNION ALL SELECT 3, 'bronze_to_silver', count(*) FROM silver WHERE date = DATE '2024-01-09'
            UNION ALL SELECT 3, 'silver_to_gold', count(*) FROM gold WHERE date = DATE '2024-01-09'""",
        "scan_messages_offsets": f"""
            SELECT partition, count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset
            FROM (SELECT CAST(event_id % 3 AS INT) AS partition, event_id * 2 + copy AS "offset" FROM sent
                  UNION ALL SELECT 3, doc_id FROM documents)
            WHERE CASE partition WHEN 0 THEN "offset" >= 300 AND "offset" < 900 WHEN 1 THEN "offset" >= 0 AND "offset" < 500
                  WHEN 2 THEN "offset" >= 100 AND "offset" < 800 ELSE "offset" >= 20 AND "offset" < 90 END
            GROUP BY partition""",
        "ingest_twice_adds_nothing": f"SELECT {_DATED_ROWS} FROM all_bronze",
        "ingest_text_twice": f"SELECT {_DATED_ROWS} FROM bronze",
        "ingest_gap_then_resume": f"SELECT {_DATED_ROWS} FROM all_bronze",
        "ingest_after_crash": f"SELECT {_DATED_ROWS} FROM all_bronze",
        "storage_usage": "SELECT CAST(date AS VARCHAR) AS date, true AS has_files, true AS has_bytes FROM silver GROUP BY date",
    }
    over_counts = {
        "register_tables": "SELECT layer, row_count FROM counts",
        "show_tables": """
            SELECT CASE layer WHEN 'bronze' THEN 'measurements_raw' WHEN 'silver' THEN 'measurements_clean'
                              ELSE 'measurements_hourly' END AS table_name, row_count FROM counts""",
        "maintenance_report": "SELECT layer, row_count, CAST(1 AS BIGINT) AS commits, 'ok' AS status FROM counts",
        "stream_then_batch": _TWICE_BRONZE,
        "batch_then_stream": _TWICE_BRONZE,
        "layer_row_counts": "SELECT layer, row_count FROM counts UNION ALL SELECT 'messages', count(*) FROM all_bronze",
        "table_metrics": f"""
            SELECT layer || '_table_row_count' AS metric, 'all' AS series,
                   CAST(epoch(TIMESTAMP '{AS_OF} 00:00:00') AS BIGINT) AS ts, CAST(row_count AS DOUBLE) AS value FROM counts
            UNION ALL
            SELECT 'kafka_message_count', 'all', CAST(epoch(TIMESTAMP '{AS_OF} 00:00:00') AS BIGINT),
                   CAST(count(*) AS DOUBLE) FROM all_bronze
            UNION ALL
            SELECT 'table_last_update_timestamp', 'all', CAST(epoch(TIMESTAMP '{AS_OF} 00:00:00') AS BIGINT),
                   CAST(epoch(TIMESTAMP '{AS_OF} 00:00:00') AS DOUBLE)""",
    }
    over_jobs = {
        "run_metrics": """
            SELECT job, rows_in, CAST(rows_rejected AS BIGINT) AS rows_rejected, rows_out, 'ok' AS status,
                   true AS has_rate FROM jobs""",
        "run_log_metrics": """
            SELECT 'spark_job_duration' AS metric, job AS series, job AS job_id, CAST(NULL AS DOUBLE) AS messages, true AS has_value FROM jobs
            UNION ALL
            SELECT 'kafka_server_brokertopicmetrics_messagesin_total', job, job, CAST(rows_in AS DOUBLE), true
            FROM jobs WHERE job = 'ingest_bronze'""",
        "table_history": "SELECT layer, rows_in, rows_out FROM jobs",
        "error_rate_dated": """
            SELECT job, rows_in, CAST(rows_rejected AS BIGINT) AS rows_rejected FROM jobs WHERE job <> 'silver_to_gold'""",
        "error_rate": """
            SELECT job, rows_in, CAST(rows_rejected AS BIGINT) AS rows_rejected,
                   round(rows_rejected / nullif(rows_in, 0) * 100, 6) AS error_pct FROM jobs""",
    }
    row_counts = "metric IN ('bronze_table_row_count', 'silver_table_row_count', 'gold_table_row_count')"
    as_of = f"CAST(epoch(TIMESTAMP '{METRICS_AS_OF}') AS BIGINT)"
    names = [f"{layer}_table_row_count" for layer in ("bronze", "silver", "gold")]
    over_samples = {
        "metric_latest": f"""
            SELECT metric, series, max(second) AS ts, arg_max(value, second) AS value
            FROM samples WHERE {row_counts} GROUP BY metric, series""",
        "metric_latest_scan": f"""
            SELECT metric, series, max(second) AS ts, arg_max(value, second) AS value
            FROM samples WHERE {row_counts} GROUP BY metric, series""",
        "metric_time_range": f"""
            SELECT metric, series, count(*) AS samples, min(second) AS first_ts, max(second) AS last_ts
            FROM samples WHERE second BETWEEN {as_of} - 3600 AND {as_of} GROUP BY metric, series""",
        "avg_by_label": f"""
            SELECT t AS ts, job_id AS label, round(avg(value), 6) AS value
            FROM ({_on_grid("spark_job_duration")}) GROUP BY ALL
            UNION ALL
            SELECT t, query_id, round(avg(value), 6)
            FROM ({_on_grid("trino_query_elapsed_time_seconds")}) GROUP BY ALL""",
        "quality_pct": f"""
            SELECT ts, series, round(pct, 6) AS quality_pct, {_colour('pct', 'red', (80, 'yellow'), (95, 'green'))} AS status
            FROM (SELECT s.t AS ts, s.series, s.value / nullif(b.value, 0) * 100 AS pct
                  FROM ({_on_grid("silver_table_row_count")}) s JOIN ({_on_grid("bronze_table_row_count")}) b
                    ON s.t = b.t AND s.series = b.series)""",
        "metric_status": f"""
            SELECT metric, {_colour('value', 'green', (80, 'red'))} AS status, count(*) AS samples
            FROM samples WHERE {row_counts} GROUP BY ALL""",
        "metric_timeline": f"""
            SELECT second - second % 30 AS ts, {', '.join(f'{_newest(m)} AS {m}' for m in names)}
            FROM samples WHERE {row_counts} GROUP BY ALL""",
        "freshness_seconds": f"""
            SELECT series, freshness_s, {_colour('freshness_s', 'green', (300, 'red'))} AS status
            FROM (SELECT series, {as_of} - CAST(arg_max(value, second) AS BIGINT) AS freshness_s
                  FROM samples WHERE metric = 'table_last_update_timestamp' GROUP BY series)""",
        "pipeline_health": f"""
            SELECT series, {', '.join(f"{m}, {_colour(m, 'green', (80, 'red'))} AS {m}_status" for m in names)}
            FROM (SELECT series, {', '.join(f'{_newest(m)} AS {m}' for m in names)}
                  FROM samples WHERE {row_counts} GROUP BY series)""",
    }
    messages_in = _rate("kafka_server_brokertopicmetrics_messagesin_total", 60)
    bronze_rows = _rate("bronze_table_row_count", 300)
    over_rates = {
        "counter_rate_1m": (messages_in, "SELECT series, ts, round(rate, 6) AS rate FROM rates"),
        "throughput_total": (messages_in, """
            SELECT t AS ts, round(sum(rate), 6) AS rate FROM (
              SELECT g.series, t, (sum(increase) - arg_min(increase, second)) / (max(second) - min(second)) AS rate
              FROM (SELECT unnest(range((SELECT min(second) // 15 * 15 FROM one), (SELECT max(second) + 61 FROM one), 15)) AS t) steps
              JOIN grown g ON g.second BETWEEN t - 60 AND t
              GROUP BY g.series, t HAVING count(*) > 1) GROUP BY t"""),
        "counter_rate_5m": (
            bronze_rows,
            f"""SELECT series, ts, round(rate, 6) AS rate,
                       {_colour('rate', 'green', (50, 'yellow'), (80, 'red'))} AS status FROM rates""",
        ),
    }
    return {
        **{k: f"WITH {_LAYERS} {sql}" for k, sql in over_layers.items()},
        **{k: f"WITH {_LAYERS}, {_COUNTS} {sql}" for k, sql in over_counts.items()},
        **{k: f"WITH {_LAYERS}, {_JOBS} {sql}" for k, sql in over_jobs.items()},
        **{k: f"WITH {_SAMPLES} {sql}" for k, sql in over_samples.items()},
        **{k: f"WITH {_SAMPLES}, {rate} {sql}" for k, (rate, sql) in over_rates.items()},
    }
