"""ANSI SQL for the registered queries, over the driver's tables.

The telemetry views are common table expressions in front of each statement; fixed tables are
written out from the same lists the Spark side reads.
"""

from __future__ import annotations

from fieldpulse.functions.labels import BANDS
from fieldpulse.plans.views import AS_OF
from fieldpulse.sources.reference import ESCALATION_RULES, SENSOR_TEMPLATES, THRESHOLDS

NOW = f"TIMESTAMP '{AS_OF}'"


def values(rows: list[tuple]) -> str:
    def cell(x) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "TRUE" if x else "FALSE"
        return f"'{x}'" if isinstance(x, str) else f"CAST({x} AS DOUBLE)" if isinstance(x, float) else str(x)

    return ", ".join("(" + ", ".join(cell(c) for c in row) + ")" for row in rows)


KIND = (
    "CASE (user_id // 5) % 5 WHEN 0 THEN 'temperature' WHEN 1 THEN 'pressure' "
    "WHEN 2 THEN 'vibration' WHEN 3 THEN 'flow_rate' ELSE 'h2s_concentration' END"
)
UNIT = (
    "CASE (user_id // 5) % 5 WHEN 0 THEN 'celsius' WHEN 1 THEN 'bar' "
    "WHEN 2 THEN 'mm_s' WHEN 3 THEN 'm3_h' ELSE 'ppm' END"
)
SUBTYPE = (
    "CASE user_id % 3 WHEN 0 THEN CASE (user_id // 5) % 5 WHEN 0 THEN 'bearing_temp' "
    "WHEN 1 THEN 'inlet_pressure' WHEN 2 THEN 'axial_vibration' WHEN 3 THEN 'flow_rate' "
    "ELSE 'none' END WHEN 1 THEN 'custom' END"
)

CTES = {
    "platforms": """
      SELECT 'P' || r_regionkey AS platform_id, r_name AS platform_name,
             r_regionkey * 10.0 AS latitude, r_regionkey * -10.0 AS longitude,
             r_name AS region, 'ACTIVE' AS status FROM region""",
    "equipment": f"""
      SELECT 'EQ-' || n_nationkey AS equipment_id, 'P' || n_regionkey AS platform_id,
             n_name AS equipment_name,
             CASE (n_nationkey // 5) % 5 WHEN 0 THEN 'pump' WHEN 1 THEN 'compressor'
               WHEN 2 THEN 'turbine' WHEN 3 THEN 'generator' ELSE 'valve' END AS equipment_type,
             {NOW} - n_nationkey * INTERVAL '400 hours' AS last_maintenance FROM nation""",
    "sensors": f"""
      SELECT 'S-' || user_id AS sensor_id, 'EQ-' || (user_id % 25) AS equipment_id,
             'P' || (user_id % 25 % 5) AS platform_id, {KIND} AS sensor_type,
             {SUBTYPE} AS subtype, {UNIT} AS unit, 0.0 AS min_range, 300.0 AS max_range,
             CASE WHEN user_id % 10 = 9 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status, user_id
      FROM (SELECT DISTINCT user_id FROM events)""",
    "readings": f"""
      SELECT ts AS "time", CAST(event_id AS VARCHAR) AS reading_id,
             'P' || (user_id % 25 % 5) AS platform_id, 'S-' || user_id AS sensor_id,
             {KIND} AS sensor_type, {SUBTYPE} AS subtype, value, {UNIT} AS unit,
             CASE event_type WHEN 'error' THEN 'BAD' WHEN 'signup' THEN 'UNCERTAIN'
               ELSE 'GOOD' END AS quality_flag,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS quality_score,
             'EQ-' || (user_id % 25) AS equipment_id, event_id, event_type
      FROM events""",
    "raw": """
      SELECT CASE WHEN event_id % 97 = 0 THEN left(body, 40) ELSE body END AS body,
             'sensors/' || platform_id || '/' || sensor_id || '/data' AS topic,
             event_id, "time" AS received_at
      FROM (SELECT *, '{"reading_id":"' || reading_id || '","platform_id":"' || platform_id
               || '","sensor_id":"'
               || CASE WHEN event_id % 79 = 0 THEN '' ELSE sensor_id END
               || '","sensor_type":"' || upper(sensor_type) || '",'
               || CASE WHEN event_id % 89 = 0 THEN ''
                    ELSE '"value":' || CASE WHEN event_id % 83 = 0 THEN '"n/a"'
                      ELSE CAST(value AS VARCHAR) END || ',' END
               || '"unit":"' || unit || '","timestamp":' || CASE WHEN event_id % 73 = 0 THEN
                    CASE event_id % 4 WHEN 0 THEN '9223372036854775807' WHEN 1 THEN '-9000000000000000000'
                      WHEN 2 THEN '99999999999999999' ELSE '"n/a"' END
                    ELSE CAST(epoch_us("time") // 1000 AS VARCHAR) END
               || ',"quality_flag":"' || quality_flag || '"}' AS body
            FROM readings)""",
    "docs": """
      SELECT *, CASE WHEN json_valid(body) THEN body END AS doc FROM raw""",
    "parsed": """
      SELECT *, CASE WHEN doc IS NULL THEN 'invalid_json'
           WHEN coalesce(sensor_id, '') = '' THEN 'missing_sensor_id'
           WHEN value_text IS NULL THEN 'missing_value'
           WHEN TRY_CAST(value_text AS DOUBLE) IS NULL THEN 'non_numeric_value'
           WHEN time_ms IS NULL THEN 'bad_timestamp' END AS error_reason
      FROM (SELECT *, CASE WHEN TRY_CAST(json_extract_string(doc, '$.timestamp') AS BIGINT)
                    BETWEEN 0 AND 4102444800000
                  THEN CAST(json_extract_string(doc, '$.timestamp') AS BIGINT) END AS time_ms, json_extract_string(doc, '$.reading_id') AS reading_id,
                json_extract_string(doc, '$.platform_id') AS platform_id,
                json_extract_string(doc, '$.sensor_id') AS sensor_id,
                json_extract_string(doc, '$.sensor_type') AS sensor_type,
                json_extract_string(doc, '$.value') AS value_text,
                json_extract_string(doc, '$.unit') AS unit,
                json_extract_string(doc, '$.timestamp') AS epoch_text,
                json_extract_string(doc, '$.quality_flag') AS quality_flag FROM docs)""",
    "dlq": """
      SELECT 'parse' AS stage, error_reason, sensor_id, platform_id, body,
             received_at AS failed_at FROM parsed WHERE error_reason IS NOT NULL
      UNION ALL
      SELECT 'quality', 'bad_quality', sensor_id, platform_id, body, received_at FROM parsed
      WHERE error_reason IS NULL AND quality_flag = 'BAD'""",
    "judged": """
      SELECT *, CASE WHEN value >= 200 OR value <= 1 THEN 'CRITICAL'
                  WHEN value >= 140 OR value <= 3 THEN 'WARNING' ELSE 'NORMAL' END AS severity,
             CASE WHEN value >= 200 OR value <= 1 THEN 'threshold_exceeded'
                  WHEN value >= 140 OR value <= 3 THEN 'threshold_warning'
                  ELSE 'none' END AS anomaly_type,
             CASE WHEN value >= 200 THEN 200.0 WHEN value <= 1 THEN 1.0
                  WHEN value >= 140 THEN 140.0 WHEN value <= 3 THEN 3.0 END AS threshold_value,
             sensor_id || ' read ' || CAST(value AS VARCHAR) ||
             CASE WHEN value >= 200 THEN ', at or above the critical maximum of 200.0'
                  WHEN value <= 1 THEN ', at or below the critical minimum of 1.0'
                  WHEN value >= 140 THEN ', at or above the warning maximum of 140.0'
                  WHEN value <= 3 THEN ', at or below the warning minimum of 3.0'
                  ELSE ', inside all limits' END AS description
      FROM readings""",
    "alerts": """
      SELECT 'A-' || reading_id AS alert_id, sensor_id, platform_id, equipment_id, anomaly_type,
             severity, value AS actual_value, threshold_value, sensor_type, unit, description,
             reading_id, "time" AS detected_at, event_id % 3 = 0 AS resolved,
             CASE WHEN event_id % 3 = 0 THEN "time" + (event_id % 180) * INTERVAL '1 minute' END
               AS resolved_at, event_id
      FROM judged WHERE severity <> 'NORMAL'""",
    "emissions": """
      SELECT reading_id AS measurement_id, platform_id,
             CASE event_type WHEN 'view' THEN 'CO2' WHEN 'click' THEN 'NOx'
               WHEN 'signup' THEN 'SOx' WHEN 'error' THEN 'CH4' ELSE 'VOC' END AS emission_type,
             value AS value_ppm, 100.0 AS limit_ppm, "time" AS measured_at
      FROM readings WHERE sensor_type = 'h2s_concentration'""",
    "baseline": """
      SELECT *, count(*) OVER f AS n, avg(value) OVER f AS mean, stddev_pop(value) OVER f AS std
      FROM readings
      WINDOW f AS (PARTITION BY sensor_id ORDER BY "time", reading_id
                   ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "moving": """
      SELECT *, CASE WHEN n < 10 THEN 'NORMAL'
                  WHEN std < 1e-10 THEN
                    CASE WHEN abs(value - mean) < 1e-10 THEN 'NORMAL' ELSE 'CRITICAL' END
                  WHEN abs(value - mean) / std > 3.75 THEN 'CRITICAL'
                  WHEN abs(value - mean) / std > 2.5 THEN 'WARNING' ELSE 'NORMAL' END AS severity,
             CASE WHEN n >= 10 THEN CASE WHEN std < 1e-10 THEN 0.0
                  ELSE abs(value - mean) / std END END AS deviation
      FROM baseline""",
    "stepped": """
      SELECT *, lag(value) OVER w AS prev_value,
             (epoch_us("time") - epoch_us(lag("time") OVER w)) / 1e6 AS dt
      FROM readings WINDOW w AS (PARTITION BY sensor_id ORDER BY "time", reading_id)""",
    "rated": """
      SELECT *, CASE WHEN rate > 0.01 THEN 'CRITICAL' WHEN rate > 0.005 THEN 'WARNING'
                  ELSE 'NORMAL' END AS severity
      FROM (SELECT *, CASE WHEN dt > 0 AND dt <= 21600 THEN abs(value - prev_value) / dt END AS rate
            FROM stepped)""",
    "minute": """
      SELECT time_bucket(INTERVAL '1 minute', "time") AS bucket, platform_id, sensor_id,
             sensor_type, avg(value) AS avg_value, min(value) AS min_value,
             max(value) AS max_value, count(*) AS reading_count, stddev_samp(value) AS stddev_value
      FROM readings GROUP BY ALL""",
    "hourly": """
      SELECT g.event_type, g.ts, coalesce(c.n, 0) AS n
      FROM (SELECT event_type, unnest(generate_series(min(date_trunc('hour', ts)),
                   max(date_trunc('hour', ts)), INTERVAL '1 hour')) AS ts
            FROM events GROUP BY event_type) g
      LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS ts, count(*) AS n
                 FROM events GROUP BY 1, 2) c
      ON g.event_type = c.event_type AND g.ts = c.ts""",
    "running": """
      SELECT *, sum(n) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts) AS total
      FROM hourly""",
    "samples": """
      SELECT ts, 'flow' AS job, 'node-1' AS instance, metric, event_type AS component,
             CAST(value AS DOUBLE) AS value
      FROM (SELECT ts, event_type, 'items_input' AS metric, total AS value FROM running
            UNION ALL SELECT ts, event_type, 'items_output', total * 2 FROM running
            UNION ALL SELECT ts, event_type, 'items_queued', n * 3 FROM running
            UNION ALL SELECT ts, event_type, 'up', CASE WHEN n > 0 THEN 1 ELSE 0 END FROM running)""",
    "rates": """
      SELECT *, CASE WHEN epoch_us(ts) > min(epoch_us(ts)) OVER f
               THEN (sum(step) OVER f - first_value(step) OVER f)
                    / ((epoch_us(ts) - min(epoch_us(ts)) OVER f) / 1e6) END AS rate
      FROM (SELECT *, coalesce(CASE WHEN value < lag(value) OVER w THEN value
                    ELSE value - lag(value) OVER w END, 0) AS step
            FROM samples WHERE metric = 'items_output'
            WINDOW w AS (PARTITION BY component ORDER BY ts))
      WINDOW f AS (PARTITION BY component ORDER BY ts
                   RANGE BETWEEN INTERVAL '3 hours' PRECEDING AND CURRENT ROW)""",
    "thresholds": f"""
      SELECT * FROM (VALUES {values(THRESHOLDS)}) AS t(sensor_type, subtype, min_normal,
        max_normal, warning_low, warning_high, critical_low, critical_high, unit)""",
    "rules": f"""
      SELECT * FROM (VALUES {values(ESCALATION_RULES)}) AS t(rule_id, severity, action_type,
        target_endpoint, delay_seconds, max_retries, enabled)""",
    "templates": f"""
      SELECT * FROM (VALUES {values(SENSOR_TEMPLATES)}) AS t(suffix, sensor_type, unit,
        min_range, max_range)""",
}

_NEEDS = {
    "raw": ["readings"],
    "docs": ["raw"],
    "parsed": ["docs"],
    "dlq": ["parsed"],
    "judged": ["readings"],
    "alerts": ["judged"],
    "emissions": ["readings"],
    "baseline": ["readings"],
    "moving": ["baseline"],
    "stepped": ["readings"],
    "rated": ["stepped"],
    "minute": ["readings"],
    "running": ["hourly"],
    "samples": ["running"],
    "rates": ["samples"],
}


def sql(body: str, *views: str, recursive: str = "") -> str:
    """Statement with the named views and what they build on in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for view in views:
        need(view)
    parts = [f"{name} AS ({CTES[name].strip()})" for name in order]
    if recursive:
        parts.append(recursive)
    head = "WITH " + ("RECURSIVE " if recursive else "")
    return (head + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def band_sql(value: str, steps: str) -> str:
    cases = [
        f"WHEN {value} >= {bound} THEN '{name}'"
        for bound, name in sorted(
            (s for s in BANDS[steps] if s[0] is not None), key=lambda s: -s[0]
        )
    ]
    first = next(name for bound, name in BANDS[steps] if bound is None)
    return f"CASE {' '.join(cases)} ELSE '{first}' END"


def rollup_sql(width: str, source: str = "readings") -> str:
    return f"""
      SELECT time_bucket(INTERVAL '{width}', "time") AS bucket, platform_id, sensor_id,
             sensor_type, round(avg(value), 6) AS avg_value, min(value) AS min_value,
             max(value) AS max_value, count(*) AS reading_count,
             round(stddev_samp(value), 6) AS stddev_value
      FROM {source} GROUP BY ALL"""
