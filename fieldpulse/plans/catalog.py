"""Registered queries: each operator run over the driver's whole tables, with its SQL.

Computed doubles are reported with six digits on both sides. Timestamps leave as
``timestamp_ntz``, so that a reader's local time zone cannot shift them.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.guards import clamp
from fieldpulse.functions.labels import RESOLVED_LABELS, band, label_map
from fieldpulse.functions.times import instant, normalize_ts, rewrite_epoch_in_text
from fieldpulse.operators import alerts as al
from fieldpulse.operators import (
    assets,
    detect,
    joins,
    metrics,
    parse,
    rollup,
    routing,
    stages,
    validate,
)
from fieldpulse.plans import dashboards as dash
from fieldpulse.plans import flow
from fieldpulse.plans.oracles import NOW, band_sql, rollup_sql, sql
from fieldpulse.plans.views import (
    AS_OF,
    FIXTURE,
    RULE_FIXTURE,
    Views,
    alerts_of,
    load,
    raw_of,
    readings_of,
)
from fieldpulse.session import scratch_dir
from fieldpulse.sources import contracts, evolution, publish, readers, reference, sinks
from fieldpulse.streaming import detectors as stream_detectors
from fieldpulse.streaming import compacted, jobs, merging, timers

Query = Callable[[Views], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

SENSOR = ("P2", "S-7")
PANEL = "10 days"


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        _ORACLES[name] = oracle
        return fn

    return register


def tidy(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: tidy(fn(load(spark, folder)))

    return {name: runner(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def dimensions(v: Views) -> flow.Dimensions:
    return flow.Dimensions(v.platforms, v.equipment, v.sensors)


# --- sources, parsing, sinks ---------------------------------------------------------------


@query(
    "filter_topic",
    sql(
        """SELECT event_id, split_part(topic, '/', 2) AS topic_platform,
             split_part(topic, '/', 3) AS topic_sensor
           FROM raw WHERE regexp_full_match(topic, 'sensors/P2/[^/]*/data')""",
        "raw",
    ),
)
def _(v: Views) -> DataFrame:
    matched = readers.filter_topic(v.raw, "sensors/P2/+/data")
    return matched.select("event_id", "topic_platform", "topic_sensor")


@query(
    "explode_batch",
    sql(
        """SELECT event_id, json_extract_string(item, '$.reading_id') AS reading_id,
             json_extract_string(item, '$.unit') AS unit
           FROM (SELECT event_id, unnest(CASE WHEN starts_with(body, '[')
                     THEN CASE WHEN json_valid(body) THEN json_extract(body, '$[*]')
                          ELSE [NULL] END
                     ELSE [CASE WHEN json_valid(body) THEN CAST(body AS JSON) END] END) AS item
                 FROM (SELECT event_id, CASE event_id % 3
                           WHEN 0 THEN '[' || body || ',' || body || ']'
                           WHEN 1 THEN body ELSE '[' || body || ']' END AS body FROM raw))""",
        "raw",
    ),
)
def _(v: Views) -> DataFrame:
    body = F.col("body")
    batch = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), body, F.lit(","), body, F.lit("]")))
        .when(F.col("event_id") % 3 == 1, body)
        .otherwise(F.concat(F.lit("["), body, F.lit("]")))
    )
    items = readers.explode_batch(v.raw.select("event_id", batch.alias("body")))
    documents = readers.with_document(items, ["reading_id", "unit"])
    return documents.select("event_id", "_doc.reading_id", "_doc.unit")


@query(
    "extract_fields",
    sql(
        """SELECT event_id, doc IS NOT NULL AS body_ok,
             coalesce(json_extract_string(doc, '$.sensor_id'), '') AS sensor_id,
             coalesce(json_extract_string(doc, '$.platform_id'), '') AS platform_id,
             coalesce(json_extract_string(doc, '$.sensor_type'), '') AS sensor_type,
             coalesce(json_extract_string(doc, '$.timestamp'), '') AS epoch_time,
             coalesce(json_extract_string(doc, '$.value'), '') AS value,
             coalesce(json_extract_string(doc, '$.unit'), '') AS unit FROM docs""",
        "docs",
    ),
)
def _(v: Views) -> DataFrame:
    fields = {n: f"$.{n}" for n in ("sensor_id", "platform_id", "sensor_type", "value", "unit")}
    lifted = readers.extract_fields(v.raw, {**fields, "epoch_time": "$.timestamp"})
    return lifted.select("event_id", "body_ok", *fields, "epoch_time")


@query(
    "parse_reading",
    sql(
        """SELECT event_id, reading_id, sensor_id, TRY_CAST(value_text AS DOUBLE) AS value,
             epoch_ms(time_ms) AS "time", quality_flag, error_reason,
             CASE error_reason WHEN 'invalid_json' THEN 'not a JSON object'
               WHEN 'missing_sensor_id' THEN 'no sensor_id'
               WHEN 'missing_value' THEN 'no value'
               WHEN 'non_numeric_value' THEN 'not a number: ' || value_text
               WHEN 'bad_timestamp' THEN 'no time: ' || coalesce(epoch_text, '') END AS error_text,
             CASE WHEN error_reason IS NOT NULL THEN 'UNKNOWN' END AS severity FROM parsed""",
        "parsed",
    ),
)
def _(v: Views) -> DataFrame:
    return parse.with_parsed(v.raw).select(
        "event_id",
        "reading_id",
        "sensor_id",
        "value",
        "time",
        "quality_flag",
        "error_reason",
        "error_text",
        "severity",
    )


@query(
    "normalize_ts",
    sql(
        """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', "time")
             WHEN 3 THEN NULL ELSE date_trunc('millisecond', "time") END AS event_time
           FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    millis = F.unix_millis("time")
    text = (
        F.when(F.col("event_id") % 4 == 0, F.floor(millis / 1000).cast("string"))
        .when(F.col("event_id") % 4 == 1, millis.cast("string"))
        .when(F.col("event_id") % 4 == 2, F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise("not a time")
    )
    texts = v.readings.select("event_id", text.alias("raw_time"))
    return texts.select("event_id", normalize_ts(F.col("raw_time")).alias("event_time"))


@query(
    "epoch_to_iso",
    sql(
        """SELECT event_id, CASE WHEN event_id % 97 = 0 OR event_id % 73 = 0 THEN body ELSE
             replace(body, '"timestamp":' || CAST(epoch_us(received_at) // 1000 AS VARCHAR),
               '"time":"' || strftime(received_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"') END AS body
           FROM raw""",
        "raw",
    ),
)
def _(v: Views) -> DataFrame:
    return v.raw.select("event_id", rewrite_epoch_in_text(F.col("body")).alias("body"))


READING_SQL = """SELECT "time", reading_id, platform_id, sensor_id, sensor_type, value, unit,
    quality_flag, {date} AS date FROM readings"""


@query(
    "write_readings",
    sql(READING_SQL.format(date="""strftime("time", '%Y-%m-%d')"""), "readings"),
)
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "readings")
    sinks.write_readings(v.readings, path)
    stored = v.spark.read.parquet(path)
    return stored.withColumn("date", F.col("date").cast("string"))


@query(
    "csv_roundtrip",
    sql(
        """SELECT reading_id, platform_id, sensor_id, sensor_type, value, unit,
             epoch_us("time") // 1000 AS "timestamp", quality_flag FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "csv")
    sinks.write_csv_readings(v.readings, path)
    return readers.read_csv_readings(v.spark, path)


ARCHIVED = "reading_id string, sensor_id string, value double"


def _archive_sql(*folders: str) -> str:
    columns = {
        "platform": "platform_id AS platform",
        "year": "strftime(\"time\", '%Y') AS year",
        "month": "strftime(\"time\", '%m') AS month",
        "day": "strftime(\"time\", '%d') AS day",
        "hour": "strftime(\"time\", '%H') AS hour",
    }
    listed = ", ".join(columns[f] for f in folders)
    return sql(f"SELECT reading_id, sensor_id, value, {listed} FROM readings", "readings")


def _archive_rows(v: Views) -> DataFrame:
    return v.readings.select(
        "time", "reading_id", "platform_id", "sensor_id", "sensor_type", "value"
    )


@query("archive_json", _archive_sql("year", "month", "day", "hour"))
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "archive-json")
    sinks.archive_json(_archive_rows(v), path, layout="date")
    schema = f"{ARCHIVED}, year string, month string, day string, hour string"
    return v.spark.read.schema(schema).json(f"{path}/sensors")


@query("archive_parquet", _archive_sql("platform", "year", "month", "day"))
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "archive-parquet")
    sinks.archive_parquet(_archive_rows(v), path)
    schema = f"{ARCHIVED}, platform string, year string, month string, day string"
    return v.spark.read.schema(schema).parquet(f"{path}/sensors")


@query(
    "keyed_records",
    sql(
        """SELECT sensor_id || '-' || anomaly_type AS key, 'alerts.critical' AS topic, alert_id,
             severity, CAST(resolved_at IS NULL AS BOOLEAN) AS resolved_at_is_null FROM alerts""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "records")
    rows = v.alerts.select("alert_id", "sensor_id", "anomaly_type", "severity", "resolved_at")
    records = sinks.to_keyed_records(rows, ["sensor_id", "anomaly_type"], "alerts.critical")
    sinks.write_records(records, path)
    value = F.col("value")
    return v.spark.read.parquet(path).select(
        "key",
        "topic",
        F.get_json_object(value, "$.alert_id").alias("alert_id"),
        F.get_json_object(value, "$.severity").alias("severity"),
        F.contains(value, F.lit('"resolved_at":null')).alias("resolved_at_is_null"),
    )


@query(
    "convert_record",
    sql(
        """SELECT reading_id, platform_id, sensor_id, sensor_type, value, unit,
             date_trunc('millisecond', "time") AS "timestamp", quality_flag FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "convert")
    rows = v.readings.withColumn("timestamp", F.timestamp_millis(F.unix_millis("time")))
    sinks.convert(rows, contracts.READING, path, "json")
    return v.spark.read.schema(contracts.READING.schema).json(path)


@query(
    "read_evolved",
    sql(
        """SELECT reading_id, sensor_id, value,
             CASE WHEN "time" < TIMESTAMP '2024-01-15' THEN 'GOOD' ELSE quality_flag END
               AS quality_flag FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    base = scratch_dir(v.spark, "evolved")
    change = instant("2024-01-15 00:00:00")
    rows = v.readings.select("reading_id", "sensor_id", "value", "quality_flag", "time")
    rows.filter(F.col("time") < change).drop("quality_flag").write.parquet(f"{base}/v1")
    rows.filter(F.col("time") >= change).write.parquet(f"{base}/v2")
    read = readers.read_evolved(v.spark, [f"{base}/v1", f"{base}/v2"], contracts.READING)
    return read.select("reading_id", "sensor_id", "value", "quality_flag")


DLQ_SQL = """SELECT stage, error_reason, sensor_id, body, failed_at,
    strftime(failed_at, '%Y-%m-%d') AS date FROM dlq"""


@query("dlq_sink", sql(DLQ_SQL, "dlq"))
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "dlq")
    sinks.write_dlq(v.dlq, path)
    schema = (
        "error_reason string, sensor_id string, body string, failed_at timestamp, "
        "stage string, date string"
    )
    stored = v.spark.read.schema(schema).json(f"{path}/dlq")
    return stored.select("stage", "error_reason", "sensor_id", "body", "failed_at", "date")


@query(
    "union_dlq",
    sql("SELECT stage, error_reason, sensor_id, platform_id, body, failed_at FROM dlq", "dlq"),
)
def _(v: Views) -> DataFrame:
    return v.dlq.drop("error_text")


@query(
    "audit_failures",
    sql(
        """SELECT stage, error_reason, count(*) AS failures, count(DISTINCT sensor_id) AS sensors,
             min(failed_at) AS first_at, max(failed_at) AS last_at,
             arg_max(body, failed_at) AS sample_body FROM dlq GROUP BY stage, error_reason""",
        "dlq",
    ),
)
def _(v: Views) -> DataFrame:
    return assets.audit_failures(v.dlq).drop("sample_sensor_id", "sample_platform_id")


CONFORM_SQL = """SELECT event_id, concat_ws(',',
    CASE WHEN reading_id IS NULL THEN 'missing:reading_id' END,
    CASE WHEN platform_id IS NULL THEN 'missing:platform_id' END,
    CASE WHEN sensor_id IS NULL THEN 'missing:sensor_id' END,
    CASE WHEN sensor_type IS NULL THEN 'missing:sensor_type'
         WHEN lower(sensor_type) NOT IN ('temperature', 'pressure', 'vibration', 'flow_rate')
         THEN 'enum:sensor_type' END,
    CASE WHEN value_text IS NULL THEN 'missing:value'
         WHEN TRY_CAST(value_text AS DOUBLE) IS NULL THEN 'type:value' END,
    CASE WHEN unit IS NULL THEN 'missing:unit' END,
    CASE WHEN epoch_text IS NULL THEN 'missing:timestamp'
         WHEN time_ms IS NULL THEN 'type:timestamp' END) AS violations,
    coalesce(quality_flag, 'GOOD') AS quality_flag FROM parsed"""


def _documents(v: Views) -> DataFrame:
    documents = readers.with_document(v.raw, contracts.READING.names)
    return contracts.normalize_vocabulary(documents.select("event_id", "_doc.*").drop("_corrupt"))


@query("conform", sql(CONFORM_SQL, "parsed"))
def _(v: Views) -> DataFrame:
    checked = contracts.conform(
        _documents(v), contracts.READING, enums={"platform_id": None}, keep=("event_id",)
    )
    return checked.select(
        "event_id", F.concat_ws(",", "violations").alias("violations"), "quality_flag"
    )


@query(
    "validate_schema",
    sql(
        f"""SELECT CASE WHEN violations = '' THEN 'valid' ELSE 'invalid' END AS outcome,
              replace(violations, ',', ', ') AS error_text, count(*) AS records
            FROM ({CONFORM_SQL}) GROUP BY ALL""",
        "parsed",
    ),
)
def _(v: Views) -> DataFrame:
    judged = validate.schema_outcome(_documents(v), enums={"platform_id": None})
    outcome = F.when(F.col("error_reason").isNull(), F.lit("valid")).otherwise(F.lit("invalid"))
    text = F.coalesce("error_text", F.lit("")).alias("error_text")
    return judged.groupBy(outcome.alias("outcome"), text).agg(F.count(F.lit(1)).alias("records"))


# --- projection, filter, routing, validation -------------------------------------------------


@query(
    "stamp",
    sql(
        f"""SELECT reading_id, 'mqtt' AS source, 'sensor-reading' AS schema_name, 'raw' AS stage,
              {NOW} AS raw_at FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    stamped = validate.stamp(
        v.readings.select("reading_id"), "raw", AS_OF, source="mqtt", schema_name="sensor-reading"
    )
    return stamped


@query(
    "quality_gate",
    sql(
        """SELECT event_id, CASE WHEN gaps = '' THEN 'passed' ELSE 'failed' END AS gate,
             CASE WHEN gaps <> '' THEN 'Empty: ' || gaps END AS error_text
           FROM (SELECT event_id, concat_ws(', ',
                   CASE WHEN coalesce(sensor_id, '') = '' THEN 'sensor_id' END,
                   CASE WHEN coalesce(platform_id, '') = '' THEN 'platform_id' END,
                   CASE WHEN coalesce(value_text, '') = '' THEN 'value' END) AS gaps
                 FROM parsed)""",
        "parsed",
    ),
)
def _(v: Views) -> DataFrame:
    fields = {n: f"$.{n}" for n in validate.REQUIRED}
    lifted = readers.extract_fields(v.raw, fields)
    gate = F.when(F.col("error_reason").isNull(), F.lit("passed")).otherwise(F.lit("failed"))
    return validate.gate_outcome(lifted).select("event_id", gate.alias("gate"), "error_text")


@query(
    "validate_range",
    sql(
        """SELECT r.reading_id, CASE WHEN s.sensor_id IS NULL THEN 'WARNING'
             WHEN r.value < s.min_range OR r.value > s.max_range THEN 'FAILED'
             ELSE 'PASSED' END AS validation_status, r."time" AS validated_at,
             1 AS schema_version
           FROM readings r LEFT JOIN (SELECT * FROM sensors WHERE status = 'ACTIVE') s
           ON r.sensor_id = s.sensor_id""",
        "readings",
        "sensors",
    ),
)
def _(v: Views) -> DataFrame:
    checked = validate.validate_range(v.readings, v.sensors.filter("status = 'ACTIVE'"))
    return checked.select("reading_id", "validation_status", "validated_at", "schema_version")


@query(
    "clamp",
    sql(
        "SELECT reading_id, greatest(5.0, least(150.0, value)) AS clamped FROM readings", "readings"
    ),
)
def _(v: Views) -> DataFrame:
    return v.readings.select("reading_id", clamp(F.col("value"), 5, 150).alias("clamped"))


RULES_SQL = """
    SELECT *, 'temperature_anomaly' AS rule FROM readings
    WHERE sensor_type = 'temperature' AND (value > 150 OR value < -40)
    UNION ALL SELECT *, 'pressure_anomaly' FROM readings
    WHERE sensor_type = 'pressure' AND (value > 150 OR value < 0)
    UNION ALL SELECT *, 'flow_anomaly' FROM readings
    WHERE sensor_type = 'flow_rate' AND value > 10000
    UNION ALL SELECT *, 'quality_anomaly' FROM readings WHERE quality_score < 0.05"""


@query(
    "rule_anomalies",
    sql(
        f"""SELECT reading_id, sensor_id, rule AS anomaly_type, 'WARNING' AS severity,
              "time" AS detected_at, 'anomaly-detected' AS stage FROM ({RULES_SQL})""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    return routing.rule_anomalies(v.readings, RULE_FIXTURE).select(
        "reading_id", "sensor_id", "anomaly_type", "severity", "detected_at", "stage"
    )


@query(
    "route_all",
    sql(
        f"""SELECT rule AS route, count(*) AS readings FROM (
              SELECT event_id, rule FROM ({RULES_SQL})
              UNION ALL SELECT event_id, 'unmatched' FROM readings
              WHERE event_id NOT IN (SELECT event_id FROM ({RULES_SQL}))) GROUP BY rule""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    routed = routing.route_all(v.readings, routing.domain_rules(RULE_FIXTURE))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("readings"))


@query(
    "route_if_all",
    sql(
        """SELECT reading_id, CASE WHEN quality_flag = 'GOOD' AND subtype = 'custom'
             THEN 'matched' ELSE 'unmatched' END AS route FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    checks = {"good": F.col("quality_flag") == "GOOD", "custom": F.col("subtype") == "custom"}
    return routing.route_if_all(v.readings, checks).select("reading_id", "route")


JUDGED_ROUTES = """SELECT *, CASE severity WHEN 'CRITICAL' THEN 'critical' WHEN 'WARNING'
    THEN 'warning' ELSE 'unmatched' END AS severity_route,
    CASE severity WHEN 'CRITICAL' THEN 'P1' WHEN 'WARNING' THEN 'P2' END AS priority,
    CASE WHEN severity IN ('CRITICAL', 'WARNING') THEN 'true' END AS notify,
    CASE severity WHEN 'CRITICAL' THEN 'pagerduty' WHEN 'WARNING' THEN 'slack' END AS channel
    FROM judged"""


def _judged(v: Views) -> DataFrame:
    judged = detect.threshold_detect(v.readings, FIXTURE)
    return judged.withColumns(
        {
            "severity": F.col("anomaly.severity"),
            "anomaly_type": F.col("anomaly.type"),
            "detected_at": F.col("time"),
        }
    )


@query(
    "route_severity",
    sql(
        f"SELECT reading_id, severity_route, priority, notify, channel FROM ({JUDGED_ROUTES})",
        "judged",
    ),
)
def _(v: Views) -> DataFrame:
    return routing.route_severity(_judged(v)).select(
        "reading_id", "severity_route", "priority", "notify", "channel"
    )


@query(
    "alert_to_json",
    sql(
        f"""SELECT reading_id, sensor_id, anomaly_type, severity,
              strftime("time", '%Y-%m-%d %H:%M:%S.%g') AS stamped,
              coalesce(priority, '') AS priority, coalesce(channel, '') AS channel,
              CAST(value AS VARCHAR) AS value_text FROM ({JUDGED_ROUTES})""",
        "judged",
    ),
)
def _(v: Views) -> DataFrame:
    documents = routing.alert_to_json(routing.route_severity(_judged(v)))
    read = readers.with_document(documents, routing.ALERT_DOCUMENT, "document")
    aliases = {
        "sensor_id": "sensor_id",
        "anomaly.type": "anomaly_type",
        "anomaly.severity": "severity",
        "anomaly.timestamp": "stamped",
        "alert.priority": "priority",
        "alert.channel": "channel",
        "value": "value_text",
    }
    doc = F.col("_doc")
    return read.select("reading_id", *[doc[name].alias(alias) for name, alias in aliases.items()])


@query(
    "compliance_events",
    sql(
        """SELECT reading_id, 'emission_event' AS report_type,
             'EPA-40CFR98' AS regulatory_framework, "time" AS reported_at FROM judged
           WHERE sensor_type IN ('gas_emission', 'h2s_concentration')
           UNION ALL SELECT reading_id, 'safety_event', 'EPA-40CFR98', "time" FROM judged
           WHERE severity = 'CRITICAL'""",
        "judged",
    ),
)
def _(v: Views) -> DataFrame:
    return routing.compliance_events(_judged(v)).select(
        "reading_id", "report_type", "regulatory_framework", "reported_at"
    )


@query(
    "split_by",
    sql(
        """SELECT reading_id, CASE WHEN sensor_type IN
             ('temperature', 'pressure', 'vibration', 'flow_rate') THEN sensor_type
             ELSE 'unmatched' END AS output FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    parts = routing.split_by(v.readings, "sensor_type", contracts.SENSOR_TYPES)
    return routing.union_dlq(
        *[df.select("reading_id", F.lit(name).alias("output")) for name, df in parts.items()]
    )


@query(
    "label_map",
    sql(
        """SELECT alert_id, CASE WHEN resolved THEN 'RESOLVED' ELSE 'OPEN' END AS resolved
           FROM alerts""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    return v.alerts.select("alert_id", label_map(F.col("resolved"), RESOLVED_LABELS).alias("resolved"))


@query(
    "band",
    sql(
        f"""SELECT sensor_id, count(*) AS alerts,
              {band_sql('count(*)', 'platform_alerts')} AS alert_band,
              {band_sql('max(actual_value)', 'value_gauge')} AS value_band
            FROM alerts GROUP BY sensor_id""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    return (
        v.alerts.groupBy("sensor_id")
        .agg(F.count(F.lit(1)).alias("alerts"), F.max("actual_value").alias("_top"))
        .select(
            "sensor_id",
            "alerts",
            band(F.col("alerts"), "platform_alerts").alias("alert_band"),
            band(F.col("_top"), "value_gauge").alias("value_band"),
        )
    )


@query(
    "assess_emissions",
    sql(
        """SELECT measurement_id, emission_type, value_ppm <= limit_ppm AS compliant,
             year(measured_at) || '-Q' || quarter(measured_at) AS reporting_period
           FROM emissions""",
        "emissions",
    ),
)
def _(v: Views) -> DataFrame:
    return assets.assess_emissions(v.emissions).select(
        "measurement_id", "emission_type", "compliant", "reporting_period"
    )


@query(
    "emission_summary",
    sql(
        """SELECT platform_id, emission_type,
             year(measured_at) || '-Q' || quarter(measured_at) AS reporting_period,
             count(*) AS measurements, count(*) FILTER (value_ppm > limit_ppm) AS exceedances,
             max(value_ppm) AS max_ppm, round(avg(value_ppm), 6) AS avg_ppm,
             round(1.0 - count(*) FILTER (value_ppm > limit_ppm) / count(*), 6) AS compliance_rate
           FROM emissions GROUP BY ALL""",
        "emissions",
    ),
)
def _(v: Views) -> DataFrame:
    return assets.emission_summary(assets.assess_emissions(v.emissions))


@query(
    "seasonal_residual",
    sql(
        """SELECT reading_id, round(expected, 6) AS expected, round(value - expected, 6) AS residual
           FROM (SELECT *, CASE WHEN subtype = 'bearing_temp' AND sensor_type = 'temperature'
                    THEN 55.0 + 3.0 * sin(2.0 * pi() * epoch_us("time") / 3.6e9 / 24.0)
                  WHEN subtype = 'inlet_pressure' AND sensor_type = 'pressure' THEN 18.0
                  ELSE 50.0 END AS expected FROM readings)""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    residuals = joins.seasonal_residual(v.readings, reference.signals(v.spark))
    return residuals.select("reading_id", "expected", "residual")


# --- joins -------------------------------------------------------------------------------------


@query(
    "enrich",
    sql(
        """SELECT r.reading_id, r.sensor_id, e.equipment_name, e.equipment_type, p.platform_name,
             p.latitude, p.longitude, p.region,
             CASE WHEN s.sensor_id IS NULL THEN 'sensor_unknown'
                  WHEN e.equipment_id IS NULL THEN 'equipment_unknown' ELSE 'matched' END
               AS match_status
           FROM readings r
           LEFT JOIN (SELECT * FROM sensors WHERE status = 'ACTIVE') s ON r.sensor_id = s.sensor_id
           LEFT JOIN (SELECT * FROM equipment WHERE equipment_type <> 'valve') e
             ON s.equipment_id = e.equipment_id
           LEFT JOIN platforms p ON e.platform_id = p.platform_id""",
        "readings",
        "sensors",
        "equipment",
        "platforms",
    ),
)
def _(v: Views) -> DataFrame:
    enriched = joins.enrich(
        v.readings,
        v.sensors.filter("status = 'ACTIVE'"),
        v.equipment.filter("equipment_type <> 'valve'"),
        v.platforms,
    )
    return enriched.select(
        "reading_id",
        "sensor_id",
        "equipment_name",
        "equipment_type",
        "platform_name",
        "latitude",
        "longitude",
        "region",
        "match_status",
    )


HEALTH_SQL = """SELECT platform_id, platform_name, region, coalesce(working, 0) AS sensor_count,
      coalesce(open_alerts, 0) AS alert_count, newest AS latest_alert_time
    FROM (SELECT * FROM platforms WHERE status = 'ACTIVE')
    LEFT JOIN (SELECT platform_id AS sp, count(*) AS working FROM sensors
               WHERE status = 'ACTIVE' GROUP BY platform_id) ON sp = platform_id
    LEFT JOIN (SELECT platform_id AS ap, sum(CASE WHEN resolved THEN 0 ELSE 1 END) AS open_alerts,
                 max(detected_at) AS newest FROM alerts GROUP BY platform_id) ON ap = platform_id"""


@query("platform_health", sql(HEALTH_SQL, "platforms", "sensors", "alerts"))
def _(v: Views) -> DataFrame:
    return joins.platform_health(v.platforms, v.sensors, v.alerts)


def _table_limits(name: str) -> str:
    return f"CASE WHEN t.sensor_type IS NOT NULL THEN t.{name} ELSE e.{name} END AS {name}"


@query(
    "threshold_by_table",
    sql(
        f"""SELECT reading_id, CASE WHEN value >= critical_high OR value <= critical_low
                THEN 'CRITICAL' WHEN value >= warning_high OR value <= warning_low THEN 'WARNING'
                ELSE 'NORMAL' END AS severity,
              CASE WHEN value >= critical_high THEN critical_high
                WHEN value <= critical_low THEN critical_low
                WHEN value >= warning_high THEN warning_high
                WHEN value <= warning_low THEN warning_low END AS threshold_value
            FROM (SELECT r.reading_id, r.value, {_table_limits('critical_high')},
                    {_table_limits('critical_low')}, {_table_limits('warning_high')},
                    {_table_limits('warning_low')}
                  FROM readings r LEFT JOIN thresholds t
                    ON r.sensor_type = t.sensor_type AND r.subtype = t.subtype
                  LEFT JOIN (SELECT sensor_type, max(critical_high) AS critical_high,
                      max(warning_high) AS warning_high, min(critical_low) AS critical_low,
                      min(warning_low) AS warning_low FROM thresholds GROUP BY sensor_type) e
                    ON r.sensor_type = e.sensor_type)""",
        "readings",
        "thresholds",
    ),
)
def _(v: Views) -> DataFrame:
    judged = detect.threshold_by_table(v.readings, reference.thresholds(v.spark))
    return judged.select("reading_id", "anomaly.severity", "anomaly.threshold_value")


@query(
    "expand_sensors",
    sql(
        """SELECT e.equipment_id || '-' || t.suffix AS sensor_id, e.equipment_id, e.platform_id,
             t.sensor_type, t.unit, t.min_range, t.max_range
           FROM equipment e CROSS JOIN templates t
           WHERE e.equipment_type IN
             ('pump', 'compressor', 'turbine', 'generator', 'separator', 'heater')""",
        "equipment",
        "templates",
    ),
)
def _(v: Views) -> DataFrame:
    return joins.expand_sensors(v.equipment)


@query(
    "append_new",
    sql(
        """SELECT sensor_id, platform_id, 'known' AS origin, CAST(NULL AS TIMESTAMP) AS "time"
           FROM sensors WHERE status = 'ACTIVE'
           UNION ALL
           SELECT sensor_id, platform_id, arg_min(quality_flag, "time"), min("time") FROM readings
           WHERE sensor_id NOT IN (SELECT sensor_id FROM sensors WHERE status = 'ACTIVE')
           GROUP BY sensor_id, platform_id""",
        "sensors",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    known = v.sensors.filter("status = 'ACTIVE'").select(
        "sensor_id",
        "platform_id",
        F.lit("known").alias("origin"),
        F.lit(None).cast("timestamp").alias("time"),
    )
    seen = v.readings.select(
        "sensor_id", "platform_id", F.col("quality_flag").alias("origin"), "time"
    )
    return joins.append_new(known, seen, ["sensor_id"], ["time"])


@query(
    "join_by_field",
    sql(
        """SELECT coalesce(c.sensor_id, w.sensor_id, b.sensor_id) AS sensor_id, c.n AS critical,
             w.n AS warning, b.n AS bad_quality
           FROM (SELECT sensor_id, count(*) AS n FROM alerts WHERE severity = 'CRITICAL'
                 GROUP BY 1) c
           FULL JOIN (SELECT sensor_id, count(*) AS n FROM alerts WHERE severity = 'WARNING'
                 GROUP BY 1) w ON c.sensor_id = w.sensor_id
           FULL JOIN (SELECT sensor_id, count(*) AS n FROM readings WHERE quality_flag = 'BAD'
                 GROUP BY 1) b ON coalesce(c.sensor_id, w.sensor_id) = b.sensor_id""",
        "alerts",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("value"))

    return joins.join_by_field(
        {
            "critical": counted(v.alerts.filter("severity = 'CRITICAL'")),
            "warning": counted(v.alerts.filter("severity = 'WARNING'")),
            "bad_quality": counted(v.readings.filter("quality_flag = 'BAD'")),
        },
        "sensor_id",
    )


@query(
    "escalate",
    sql(
        f"""SELECT * FROM (
              SELECT a.alert_id, r.rule_id, r.action_type, r.target_endpoint,
                a.detected_at + r.delay_seconds * INTERVAL '1 second' AS notify_at, a.resolved_at
              FROM alerts a JOIN rules r ON a.severity = r.severity AND r.enabled)
            WHERE notify_at <= {NOW} AND (resolved_at IS NULL OR resolved_at > notify_at)""",
        "alerts",
        "rules",
    ),
)
def _(v: Views) -> DataFrame:
    due = al.escalate(v.alerts, reference.escalation_rules(v.spark), AS_OF)
    return due.select(
        "alert_id", "rule_id", "action_type", "target_endpoint", "notify_at", "resolved_at"
    )


@query(
    "orphans",
    sql(
        """SELECT sensor_id, equipment_id FROM sensors WHERE equipment_id NOT IN
             (SELECT equipment_id FROM equipment WHERE equipment_type <> 'valve')""",
        "sensors",
        "equipment",
    ),
)
def _(v: Views) -> DataFrame:
    fitted = v.equipment.filter("equipment_type <> 'valve'")
    return joins.orphans(v.sensors, fitted, "equipment_id").select("sensor_id", "equipment_id")


# --- aggregation, buckets, lifecycle -------------------------------------------------------------


def _register_rollup(name: str, width: str) -> None:
    @query(name, sql(rollup_sql(width), "readings"))
    def _(v: Views) -> DataFrame:
        return rollup.rollup(v.readings, width)


for _name, _width in {
    "rollup_1m": "1 minute",
    "rollup_5m": "5 minutes",
    "rollup_15m": "15 minutes",
    "rollup_1d": "1 day",
}.items():
    _register_rollup(_name, _width)


SHIFT = 1e8


@query(
    "rollup_of_rollup_large_values",
    sql(
        f"""SELECT bucket, platform_id, sensor_id, sensor_type, avg_value + {SHIFT} AS avg_value,
             min_value + {SHIFT} AS min_value, max_value + {SHIFT} AS max_value, reading_count,
             round(d.stddev_value, 4) AS stddev_value FROM ({rollup_sql("1 day")}) r
             JOIN (SELECT time_bucket(INTERVAL '1 day', time) AS bucket, sensor_id,
                 stddev_samp(value + {SHIFT}) AS stddev_value FROM readings GROUP BY ALL) d
             USING (bucket, sensor_id)""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """Deviations far smaller than the values survive both steps."""
    far = v.readings.withColumn("value", F.col("value") + SHIFT)
    merged = rollup.rollup_of_rollup(rollup.rollup(far, "15 minutes"), "1 day")
    return merged.withColumns(
        {"avg_value": F.round("avg_value", 6), "stddev_value": F.round("stddev_value", 4)}
    )


@query("rollup_of_rollup", sql(rollup_sql("1 day"), "readings"))
def _(v: Views) -> DataFrame:
    return rollup.rollup_of_rollup(rollup.rollup(v.readings, "15 minutes"), "1 day")


@query(
    "refresh_rollup",
    sql(
        f"""SELECT bucket, platform_id, sensor_id, sensor_type,
              round(avg_value + CASE WHEN bucket >= {NOW} - INTERVAL '10 days'
                AND bucket < {NOW} - INTERVAL '1 day' THEN 0 ELSE 1 END, 6) AS avg_value,
              min_value, max_value, reading_count, stddev_value FROM ({rollup_sql('1 hour')})
            WHERE bucket < {NOW} - INTERVAL '1 day'""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """The stored rollup misses the last three days and has recognisably other averages."""
    early = v.readings.filter(F.col("time") < instant("2024-01-28 00:00:00"))
    stored = rollup.rollup(early, "1 hour").withColumn("avg_value", F.col("avg_value") + 1)
    return rollup.refresh_rollup(v.readings, stored, "1 hour", "10 days", "1 day", AS_OF)


@query(
    "refresh_rollup_table",
    sql(rollup_sql("15 minutes"), "readings"),
)
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "rollup-table")
    early = v.readings.filter(F.col("time") < instant("2024-01-30 12:00:00"))
    rollup.write_rollup(rollup.rollup(early, "15 minutes"), path)
    rollup.refresh_rollup_table(v.spark, v.readings, path, "rollup_15m", "2024-01-31 00:15:00")
    return v.spark.read.parquet(path).drop("date")


@query(
    "retention",
    sql(
        f"""SELECT reading_id, "time" FROM readings
            WHERE "time" >= {NOW} - INTERVAL '10 days'""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    kept = rollup.apply_retention(v.readings, "time", 10, AS_OF)
    return kept.select("reading_id", "time")


@query("refresh_first_run", sql(rollup_sql("15 minutes"), "readings"))
def _(v: Views) -> DataFrame:
    """A site without a stored rollup."""
    path = scratch_dir(v.spark, "rollup-first")
    everything = ("15 minutes", "60 days", "0 minutes", "1 hour")
    rollup.refresh_rollup_table(v.spark, v.readings, path, everything, "2024-01-31 00:15:00")
    return v.spark.read.parquet(path).drop("date")


@query(
    "retention_on_path",
    sql(
        f"""SELECT reading_id, "time" FROM readings
            WHERE CAST("time" AS DATE) + INTERVAL '1 day' > {NOW} - INTERVAL '10 days'""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """Whole expired days leave a fact table that is kept by path."""
    path = scratch_dir(v.spark, "retained")
    sinks.write_readings(v.readings, path)
    rollup.drop_expired_days(v.spark, path, 10, AS_OF)
    return v.spark.read.parquet(path).select("reading_id", "time")


@query(
    "ingest_stats",
    sql(
        """SELECT time_bucket(INTERVAL '30 seconds', "time") AS bucket, count(*) AS readings,
             count(*) FILTER (quality_flag <> 'GOOD') AS anomalies,
             round(count(*) / 30.0, 6) AS readings_per_sec FROM readings GROUP BY 1""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    return rollup.ingest_stats(v.readings)


@query(
    "latest",
    sql(
        f"""SELECT platform_id, sensor_type, arg_max(value, "time") AS value,
              max("time") AS "time" FROM readings
            WHERE "time" >= {NOW} - INTERVAL '10 days' GROUP BY platform_id, sensor_type""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    newest = rollup.latest(
        v.readings, ["platform_id", "sensor_type"], AS_OF, PANEL, tie=("reading_id",)
    )
    return newest.select("platform_id", "sensor_type", "value", "time")


@query(
    "compact_latest",
    sql(
        """SELECT sensor_id, arg_max(reading_id, "time") AS reading_id, max("time") AS "time"
           FROM readings GROUP BY sensor_id""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    newest = rollup.compact_latest(v.readings, ["sensor_id"], "time", ("reading_id",))
    return newest.select("sensor_id", "reading_id", "time")


@query(
    "equipment_health",
    sql(
        f"""SELECT equipment_id, platform_id, equipment_name, equipment_type,
              CASE WHEN n = 0 THEN 'OFFLINE' WHEN score >= 0.95 THEN 'HEALTHY'
                WHEN score >= 0.85 THEN 'DEGRADED' WHEN score >= 0.7 THEN 'WARNING'
                ELSE 'CRITICAL' END AS status, round(score, 6) AS health_score,
              last_maintenance,
              round(epoch_us({NOW}) / 3.6e9 - epoch_us(last_maintenance) / 3.6e9, 6)
                AS hours_since_maintenance, {NOW} AS assessed_at
            FROM (SELECT e.*, coalesce(r.n, 0) AS n, CASE WHEN coalesce(r.n, 0) = 0 THEN 0.0
                    ELSE greatest(1.0 - coalesce(a.burden, 0) / r.n, 0.0) END AS score
                  FROM equipment e
                  LEFT JOIN (SELECT equipment_id, count(*) AS n FROM readings
                      WHERE "time" >= {NOW} - INTERVAL '10 days' GROUP BY 1) r
                    ON e.equipment_id = r.equipment_id
                  LEFT JOIN (SELECT equipment_id,
                      sum(CASE severity WHEN 'CRITICAL' THEN 1.0 ELSE 0.5 END) AS burden
                      FROM alerts WHERE detected_at >= {NOW} - INTERVAL '10 days' GROUP BY 1) a
                    ON e.equipment_id = a.equipment_id)""",
        "equipment",
        "readings",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    return assets.equipment_health(v.readings, v.alerts, v.equipment, v.sensors, AS_OF, PANEL)


# --- detectors and alerts --------------------------------------------------------------------------


@query(
    "threshold_detect",
    sql(
        """SELECT reading_id, severity, anomaly_type, threshold_value, description FROM judged""",
        "judged",
    ),
)
def _(v: Views) -> DataFrame:
    return detect.threshold_detect(v.readings, FIXTURE).select(
        "reading_id",
        "anomaly.severity",
        F.col("anomaly.type").alias("anomaly_type"),
        "anomaly.threshold_value",
        "anomaly.description",
    )


@query(
    "moving_average_detect",
    sql(
        """SELECT reading_id, sensor_id, severity,
             CASE severity WHEN 'NORMAL' THEN 'none' ELSE 'moving_average_deviation' END
               AS anomaly_type,
             round(deviation, 6) AS deviation, round(mean, 6) AS mean, round(std, 6) AS stddev,
             n AS window_count FROM moving""",
        "moving",
    ),
)
def _(v: Views) -> DataFrame:
    found = detect.moving_average_detect(v.readings, FIXTURE, digits=6)
    return found.select(
        "reading_id",
        "sensor_id",
        "moving_average.severity",
        F.col("moving_average.type").alias("anomaly_type"),
        "moving_average.deviation",
        "moving_average.mean",
        "moving_average.stddev",
        F.col("moving_average.window_count").cast("bigint").alias("window_count"),
    )


@query(
    "rate_of_change_detect",
    sql(
        """SELECT reading_id, sensor_id, severity, severity <> 'NORMAL' AS is_spike,
             round(rate, 6) AS rate FROM rated""",
        "rated",
    ),
)
def _(v: Views) -> DataFrame:
    found = detect.rate_of_change_detect(v.readings, FIXTURE)
    return found.select(
        "reading_id",
        "sensor_id",
        "rate_of_change.severity",
        "rate_of_change.is_spike",
        "rate_of_change.rate",
    )


DETECT_SQL = sql(
    """SELECT sha256(reading_id || '|' || anomaly_type) AS alert_id, sensor_id, anomaly_type,
         severity, value AS actual_value, threshold_value, "time" AS detected_at
       FROM judged WHERE severity <> 'NORMAL'
       UNION ALL
       SELECT sha256(reading_id || '|moving_average_deviation'), sensor_id,
         'moving_average_deviation', severity, value,
         round(CASE WHEN value >= mean THEN mean + 2.5 * std ELSE mean - 2.5 * std END, 6), "time"
       FROM moving WHERE severity <> 'NORMAL'
       UNION ALL
       SELECT sha256(reading_id || '|rate_of_change_spike'), sensor_id, 'rate_of_change_spike',
         severity, value, 0.005, "time"
       FROM rated WHERE severity <> 'NORMAL'""",
    "judged",
    "moving",
    "rated",
)
ALERT_COLUMNS = (
    "alert_id",
    "sensor_id",
    "anomaly_type",
    "severity",
    "actual_value",
    "threshold_value",
    "detected_at",
)


@query("detect_all", DETECT_SQL)
def _(v: Views) -> DataFrame:
    return detect.detect_all(v.readings, FIXTURE).select(*ALERT_COLUMNS)


@query(
    "correlate",
    sql(
        """SELECT time_bucket(INTERVAL '1 hour', detected_at) AS bucket, platform_id,
             count(DISTINCT sensor_id) AS sensors, count(*) AS alerts,
             min(detected_at) AS first_at, max(detected_at) AS last_at,
             CASE WHEN bool_or(severity = 'CRITICAL') THEN 'CRITICAL' ELSE 'WARNING' END
               AS severity, 'multi_sensor_correlation' AS anomaly_type
           FROM alerts GROUP BY 1, 2 HAVING count(DISTINCT sensor_id) >= 2""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    return al.correlate(v.alerts, "1 hour", 2, "platform_id")


@query(
    "dedup_alerts_quiet_gap",
    sql(
        """SELECT alert_id, sensor_id, detected_at FROM (
             SELECT *, lag(detected_at) OVER (PARTITION BY sensor_id ORDER BY detected_at) AS before
             FROM alerts)
           WHERE before IS NULL OR detected_at > before + INTERVAL '24 hours'""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    kept = al.dedup_alerts(v.alerts, ["sensor_id"], "24 hours")
    return kept.select("alert_id", "sensor_id", "detected_at")


@query(
    "dedup_alerts_fixed",
    sql(
        """SELECT a.alert_id, a.sensor_id, a.detected_at
           FROM alerts a JOIN kept k ON a.sensor_id = k.sensor_id AND a.detected_at = k.at""",
        "alerts",
        recursive="""kept AS (
          SELECT sensor_id, min(detected_at) AS at FROM alerts GROUP BY sensor_id
          UNION ALL
          SELECT k.sensor_id, min(a.detected_at) FROM kept k JOIN alerts a
            ON a.sensor_id = k.sensor_id AND a.detected_at > k.at + INTERVAL '24 hours'
          GROUP BY k.sensor_id)""",
    ),
)
def _(v: Views) -> DataFrame:
    kept = al.dedup_alerts(
        v.alerts, ["sensor_id"], "24 hours", mode="fixed", slice_width="5 days"
    )
    return kept.select("alert_id", "sensor_id", "detected_at")


LIFECYCLE_SQL = sql(
    """SELECT alert_id, severity = 'CRITICAL' AS acknowledged,
         CASE WHEN severity = 'CRITICAL' THEN 'operator' END AS acknowledged_by,
         CASE WHEN severity = 'CRITICAL' THEN detected_at + INTERVAL '10 minutes' END
           AS acknowledged_at, resolved, resolved_at FROM alerts""",
    "alerts",
)
LIFECYCLE_COLUMNS = (
    "alert_id",
    "acknowledged",
    "acknowledged_by",
    "acknowledged_at",
    "resolved",
    "resolved_at",
)


def _acknowledged(v: Views) -> tuple[str, DataFrame]:
    """The stored alert table, and entries for its critical alerts."""
    path = scratch_dir(v.spark, "alerts")
    al.write_alerts(v.alerts, path)
    acks = v.alerts.filter("severity = 'CRITICAL'").select(
        "alert_id",
        F.lit("operator").alias("acknowledged_by"),
        (F.col("detected_at") + F.expr("INTERVAL 10 MINUTES")).alias("acknowledged_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )
    return path, acks


@query("alert_lifecycle", LIFECYCLE_SQL)
def _(v: Views) -> DataFrame:
    path, acks = _acknowledged(v)
    return al.resolve(v.spark.read.parquet(path), acks).select(*LIFECYCLE_COLUMNS)


@query("alert_lifecycle_stored", LIFECYCLE_SQL)
def _(v: Views) -> DataFrame:
    """The table itself after the write-back, applied twice."""
    path, acks = _acknowledged(v)
    al.resolve_stored(v.spark, path, acks)
    al.resolve_stored(v.spark, path, acks)
    return v.spark.read.parquet(path).select(*LIFECYCLE_COLUMNS)


# --- dashboards --------------------------------------------------------------------------------------

SINCE_PANEL = f"""platform_id = '{SENSOR[0]}' AND sensor_id = '{SENSOR[1]}'
    AND "time" >= {NOW} - INTERVAL '{PANEL}'"""
DAYS_ALERTS = f"detected_at >= {NOW} - INTERVAL '24 hours'"


def _dashboard(name: str, oracle: str, fn: Query) -> None:
    query(name, oracle)(fn)


_dashboard(
    "q01",
    sql(
        "SELECT count(*) AS active_platforms FROM platforms WHERE status = 'ACTIVE'", "platforms"
    ),
    lambda v: dash.active_platforms(v.platforms),
)
_dashboard(
    "q02",
    sql("SELECT count(*) AS sensors_online FROM sensors WHERE status = 'ACTIVE'", "sensors"),
    lambda v: dash.sensors_online(v.sensors),
)
_dashboard(
    "q03",
    sql("SELECT count(*) AS unresolved_alerts FROM alerts WHERE NOT resolved", "alerts"),
    lambda v: dash.unresolved_alerts(v.alerts),
)
_dashboard(
    "q04",
    sql(
        f"""SELECT round(count(*) / greatest((epoch_us(max("time")) - epoch_us(min("time"))) / 1e6,
              1.0), 6) AS readings_per_sec FROM readings
            WHERE "time" >= {NOW} - INTERVAL '1 hour'""",
        "readings",
    ),
    lambda v: dash.ingest_rate(v.readings, AS_OF, "1 hour"),
)
_dashboard(
    "q05",
    sql(HEALTH_SQL, "platforms", "sensors", "alerts"),
    lambda v: dash.health_summary(v.platforms, v.sensors, v.alerts),
)
_dashboard(
    "q06",
    sql(
        f"""SELECT bucket, platform_id, CAST(sum(reading_count) AS BIGINT) AS readings FROM minute
            WHERE bucket >= {NOW} - INTERVAL '24 hours' GROUP BY bucket, platform_id""",
        "minute",
    ),
    lambda v: dash.readings_per_platform(
        dash.minute_rollup(v.readings, AS_OF, "24 hours"), AS_OF, "24 hours"
    ),
)
_dashboard(
    "q07",
    sql(
        f'SELECT "time", value AS sensor_value FROM readings WHERE {SINCE_PANEL}', "readings"
    ),
    lambda v: dash.raw_series(v.readings, *SENSOR, AS_OF, PANEL),
)
_dashboard(
    "q08",
    sql(
        f"""SELECT bucket, round(avg_value, 6) AS avg_value, min_value, max_value FROM minute
            WHERE platform_id = '{SENSOR[0]}' AND sensor_id = '{SENSOR[1]}'
              AND bucket >= {NOW} - INTERVAL '{PANEL}'""",
        "minute",
    ),
    lambda v: dash.trend_band(dash.minute_rollup(v.readings, AS_OF, PANEL), *SENSOR, AS_OF, PANEL),
)
_dashboard(
    "q09",
    sql(
        f"""SELECT value AS current_value FROM readings WHERE {SINCE_PANEL}
            ORDER BY "time" DESC, reading_id DESC LIMIT 1""",
        "readings",
    ),
    lambda v: dash.current_value(v.readings, *SENSOR, AS_OF, PANEL),
)
_dashboard(
    "q10",
    sql(f"SELECT min(value) AS min_value FROM readings WHERE {SINCE_PANEL}", "readings"),
    lambda v: dash.min_value(v.readings, *SENSOR, AS_OF, PANEL),
)
_dashboard(
    "q11",
    sql(f"SELECT max(value) AS max_value FROM readings WHERE {SINCE_PANEL}", "readings"),
    lambda v: dash.max_value(v.readings, *SENSOR, AS_OF, PANEL),
)
_dashboard(
    "q12",
    sql(
        f"""SELECT CAST(round(CAST(avg(value) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_value
            FROM readings WHERE {SINCE_PANEL}""",
        "readings",
    ),
    lambda v: dash.avg_value(v.readings, *SENSOR, AS_OF, PANEL).select(
        F.col("avg_value").cast("double").alias("avg_value")
    ),
)
ALERT_ROW_SQL = """detected_at, {lead} severity, anomaly_type, actual_value, threshold_value,
    description, CAST(resolved AS VARCHAR) AS resolved"""
_dashboard(
    "q13",
    sql(
        f"""SELECT {ALERT_ROW_SQL.format(lead='')} FROM alerts
            WHERE platform_id = '{SENSOR[0]}' AND sensor_id = '{SENSOR[1]}'
            ORDER BY detected_at DESC, alert_id DESC LIMIT 20""",
        "alerts",
    ),
    lambda v: dash.sensor_alerts(v.alerts, *SENSOR),
)
_dashboard(
    "q14_platforms",
    sql("SELECT platform_id FROM platforms WHERE status = 'ACTIVE'", "platforms"),
    lambda v: dash.platform_choices(v.platforms),
)
_dashboard(
    "q14_sensors",
    sql(
        f"""SELECT sensor_id FROM sensors
            WHERE platform_id = '{SENSOR[0]}' AND status = 'ACTIVE'""",
        "sensors",
    ),
    lambda v: dash.sensor_choices(v.sensors, SENSOR[0]),
)
_dashboard(
    "q15",
    sql(
        """SELECT count(*) AS critical_alerts FROM alerts
           WHERE NOT resolved AND severity = 'CRITICAL'""",
        "alerts",
    ),
    lambda v: dash.critical_alerts(v.alerts),
)
_dashboard(
    "q16",
    sql(
        f"""SELECT CAST(coalesce(round(CAST(avg((epoch_us(resolved_at) - epoch_us(detected_at))
              / 1e6 / 60.0) AS DECIMAL(38,10)), 1), 0) AS DOUBLE) AS avg_resolution_min
            FROM alerts WHERE resolved AND {DAYS_ALERTS}""",
        "alerts",
    ),
    lambda v: dash.mean_resolution(v.alerts, AS_OF).select(
        F.col("avg_resolution_min").cast("double").alias("avg_resolution_min")
    ),
)
_dashboard(
    "q17",
    sql(
        f"""SELECT date_trunc('hour', detected_at) AS hour, severity, count(*) AS alerts
            FROM alerts WHERE {DAYS_ALERTS} GROUP BY 1, 2""",
        "alerts",
    ),
    lambda v: dash.alert_timeline(v.alerts, AS_OF),
)
_dashboard(
    "q18",
    sql(
        f"SELECT severity, count(*) AS alerts FROM alerts WHERE {DAYS_ALERTS} GROUP BY 1",
        "alerts",
    ),
    lambda v: dash.severity_distribution(v.alerts, AS_OF),
)
_dashboard(
    "q19",
    sql(
        f"""SELECT platform_id || ' / ' || sensor_id AS sensor, count(*) AS alert_count
            FROM alerts WHERE {DAYS_ALERTS} GROUP BY platform_id, sensor_id
            ORDER BY alert_count DESC, platform_id, sensor_id LIMIT 10""",
        "alerts",
    ),
    lambda v: dash.top_sensors(v.alerts, AS_OF),
)
_dashboard(
    "q20",
    sql(
        f"""SELECT {ALERT_ROW_SQL.format(lead='platform_id, sensor_id,')} FROM alerts
            ORDER BY detected_at DESC, alert_id DESC LIMIT 50""",
        "alerts",
    ),
    lambda v: dash.recent_alerts(v.alerts),
)
_dashboard(
    "q21",
    sql(
        f"""SELECT round((epoch_us(max("time")) - epoch_us(min("time"))) / 1e6, 6)
              AS time_spread_s FROM readings WHERE "time" >= {NOW} - INTERVAL '1 hour'""",
        "readings",
    ),
    lambda v: dash.time_spread(v.readings, AS_OF, "1 hour"),
)
_dashboard(
    "q22",
    sql(
        f"""SELECT bucket, round(sum(reading_count) / 60.0, 6) AS writes_per_sec FROM minute
            WHERE bucket >= {NOW} - INTERVAL '24 hours' GROUP BY bucket""",
        "minute",
    ),
    lambda v: dash.write_rate(
        dash.minute_rollup(v.readings, AS_OF, "24 hours"), AS_OF, "24 hours"
    ),
)
_dashboard(
    "q23",
    sql(
        f"""SELECT count(*) AS readings FROM readings
            WHERE "time" >= {NOW} - INTERVAL '1 hour'""",
        "readings",
    ),
    lambda v: dash.readings_last_minute(v.readings, AS_OF, "1 hour"),
)


# --- metric series ---------------------------------------------------------------------------------------


@query(
    "counter_rate",
    sql("SELECT ts, component, value, round(rate, 6) AS rate FROM rates", "rates"),
)
def _(v: Views) -> DataFrame:
    counters = v.samples.filter("metric = 'items_output'")
    return metrics.counter_rate(counters, "3 hours", slice_width="1 day").select("ts", "component", "value", "rate")


@query(
    "instant_values",
    sql(
        """SELECT component, max(ts) AS ts, arg_max(value, ts) AS value FROM samples
           WHERE metric = 'items_queued' GROUP BY component""",
        "samples",
    ),
)
def _(v: Views) -> DataFrame:
    newest = metrics.instant_values(v.samples, "items_queued", "flow")
    return newest.select("component", "ts", "value")


@query(
    "sum_matching",
    sql(
        """SELECT ts, sum(value) AS value, count(*) AS series FROM samples
           WHERE metric = 'items_queued' AND regexp_full_match(component, 'v.*|c.*|err') GROUP BY ts""",
        "samples",
    ),
)
def _(v: Views) -> DataFrame:
    queues = v.samples.filter("metric = 'items_queued'")
    return metrics.sum_matching(queues, "component", "v.*|c.*|err")


ISLANDS = """
    SELECT component, min(ts) AS pending_since, min(ts) + INTERVAL '2 hours' AS fires_at,
      max(ts) AS last_true_at, count(*) AS samples
    FROM (SELECT *, sum(changed) OVER (PARTITION BY component ORDER BY ts) AS island
          FROM (SELECT *, CASE WHEN (value > 6) = lag(value > 6)
                    OVER (PARTITION BY component ORDER BY ts) THEN 0 ELSE 1 END AS changed
                FROM samples WHERE metric = 'items_queued'))
    WHERE value > 6 GROUP BY component, island HAVING max(ts) - min(ts) >= INTERVAL '2 hours'"""


@query("sustained", sql(ISLANDS, "samples"))
def _(v: Views) -> DataFrame:
    queues = v.samples.filter("metric = 'items_queued'")
    episodes = metrics.sustained(queues, F.col("value") > 6, "2 hours", slice_width="1 day")
    return episodes.select("component", "pending_since", "fires_at", "last_true_at", "samples")


@query(
    "evaluate_rules",
    sql(
        f"""SELECT 'Backlog' AS alertname, 'warning' AS severity, component, pending_since, samples
            FROM ({ISLANDS})
            UNION ALL
            SELECT 'Busy', 'critical', '', min(ts), count(*)
            FROM (SELECT *, sum(changed) OVER (ORDER BY ts) AS island
                  FROM (SELECT *, CASE WHEN (total > 30) = lag(total > 30) OVER (ORDER BY ts)
                            THEN 0 ELSE 1 END AS changed
                        FROM (SELECT ts, sum(value) AS total FROM samples
                              WHERE metric = 'items_queued' GROUP BY ts)))
            WHERE total > 30 GROUP BY island HAVING max(ts) - min(ts) >= INTERVAL '1 hour'""",
        "samples",
    ),
)
def _(v: Views) -> DataFrame:
    """Rules of both kinds on hourly samples, whose spans are wider than the stock rules'."""
    rule = metrics.MetricRule
    rules = (
        rule("Backlog", "items_queued", "gt", 6, "2 hours", "warning"),
        rule("Busy", "items_queued", "gt", 30, "1 hour", "critical", kind="sum"),
    )
    found = metrics.evaluate_rules(v.samples, rules, slice_width="1 day")
    return found.select("alertname", "severity", "component", "pending_since", "samples")


@query(
    "group_notifications",
    sql(
        """SELECT alertname, severity, session, session_start,
             CAST(floor((epoch_us(detected_at) - epoch_us(session_start)) / 43200e6) AS BIGINT)
               AS slot, count(*) AS alerts,
             min(detected_at) + INTERVAL '10 seconds' AS notified_at
           FROM (SELECT *, min(detected_at) OVER (PARTITION BY alertname, severity, session)
                     AS session_start
                 FROM (SELECT *, CAST(sum(starts) OVER (PARTITION BY alertname, severity
                           ORDER BY detected_at) AS BIGINT) AS session
                       FROM (SELECT detected_at, anomaly_type AS alertname, severity,
                               CASE WHEN detected_at <= lag(detected_at) OVER (
                                 PARTITION BY anomaly_type, severity ORDER BY detected_at)
                                 + INTERVAL '6 hours' THEN 0 ELSE 1 END AS starts FROM alerts)))
           GROUP BY ALL""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    occurrences = v.alerts.withColumn("alertname", F.col("anomaly_type"))
    return metrics.group_notifications(
        occurrences, repeat="12 hours", resolve_after="6 hours", ts="detected_at"
    )


@query(
    "component_status",
    sql(
        """SELECT component, arg_max(value, ts) FILTER (metric = 'items_input') AS items_in,
             any_value(rate) AS items_out_rate,
             arg_max(value, ts) FILTER (metric = 'items_queued') AS queue_size
           FROM samples JOIN (SELECT component AS c, round(arg_max(rate, ts), 6) AS rate
                              FROM rates GROUP BY component) ON component = c
           GROUP BY component""",
        "rates",
    ),
)
def _(v: Views) -> DataFrame:
    return metrics.component_status(v.samples, span="3 hours", job="flow", slice_width="1 day")


# --- the composed flow and the streaming versions -------------------------------------------------------

FLOW_SQL = sql(
    """SELECT epoch_ms(time_ms) AS "time", reading_id, platform_id, sensor_id,
         lower(sensor_type) AS sensor_type, CAST(value_text AS DOUBLE) AS value, unit, quality_flag
       FROM parsed WHERE error_reason IS NULL""",
    "parsed",
)


@query("flow_readings", FLOW_SQL)
def _(v: Views) -> DataFrame:
    """The fact table after a run of the whole batch flow."""
    config = flow.FlowConfig(FIXTURE, RULE_FIXTURE, AS_OF, archive_layout="date")
    paths = flow.run_batch(v.raw, dimensions(v), scratch_dir(v.spark, "flow"), config)
    return v.spark.read.parquet(paths["readings"]).drop("date")


@query(
    "flow_dlq",
    sql(
        """SELECT CASE WHEN error_reason IS NULL THEN 'range' ELSE 'parse' END AS stage,
             coalesce(error_reason, 'out_of_range') AS error_reason, sensor_id, body,
             received_at AS failed_at FROM parsed
           WHERE error_reason IS NOT NULL OR TRY_CAST(value_text AS DOUBLE) NOT BETWEEN 0 AND 300""",
        "parsed",
    ),
)
def _(v: Views) -> DataFrame:
    """The dead letters after a run of the whole batch flow, with the full archive layout."""
    config = flow.FlowConfig(FIXTURE, RULE_FIXTURE)
    paths = flow.run_batch(v.raw, dimensions(v), scratch_dir(v.spark, "flow"), config)
    schema = "error_reason string, sensor_id string, body string, failed_at timestamp, stage string"
    return v.spark.read.schema(schema).json(f"{paths['dlq']}/dlq").select(
        "stage", "error_reason", "sensor_id", "body", "failed_at"
    )


FLOW_RUNS = 2  # runs into which the published flow's documents are dealt


@query(
    "published_records",
    sql(
        f"""SELECT run, topic, count(*) AS records FROM (
              SELECT 'day-' || (event_id % {FLOW_RUNS}) AS run, unnest(CASE
                WHEN error_reason IS NOT NULL THEN ['sensor.raw', 'sensor.dlq']
                WHEN TRY_CAST(value_text AS DOUBLE) NOT BETWEEN 0 AND 300
                  THEN ['sensor.raw', 'sensor.validated', 'sensor.enriched', 'sensor.dlq']
                ELSE ['sensor.raw', 'sensor.validated', 'sensor.enriched'] END) AS topic
              FROM parsed) GROUP BY run, topic""",
        "parsed",
    ),
)
def _(v: Views) -> DataFrame:
    """Records of the flow's topics per run. An attempt at the first run breaks off, the last run
    is done twice: neither shows in the result."""
    base = scratch_dir(v.spark, "published")
    config = flow.FlowConfig(FIXTURE, RULE_FIXTURE, archive_layout="date")

    def part(k: int) -> DataFrame:
        return v.raw.filter(F.col("event_id") % FLOW_RUNS == k)

    broken = publish.begin(v.spark, base, "day-0")
    sinks.write_records(
        sinks.to_keyed_records(part(0).select("body"), [F.lit("raw")], "sensor.raw"), broken.path("topics")
    )
    for k in (*range(FLOW_RUNS), FLOW_RUNS - 1):
        flow.run_batch(part(k), dimensions(v), base, config, f"day-{k}")
    records = publish.read_published(v.spark, base, "topics", "key string", "topic string")
    shown = records.filter(F.col("topic").isin("sensor.raw", "sensor.validated", "sensor.enriched", "sensor.dlq"))
    return shown.groupBy("run", "topic").agg(F.count(F.lit(1)).alias("records"))


@query(
    "stream_rollup",
    sql(
        f"""SELECT * FROM ({rollup_sql('15 minutes')}) WHERE bucket + INTERVAL '15 minutes' <=
              (SELECT date_trunc('millisecond', max("time")) - INTERVAL '1 day' FROM readings)""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """Buckets the watermark has passed once the source is drained."""
    stream = readings_of(v.stream_events())
    return jobs.drain(v.spark, jobs.stream_rollup(stream, "15 minutes"), "stream-rollup")


@query("stream_rollup_completed", sql(rollup_sql("15 minutes"), "readings"))
def _(v: Views) -> DataFrame:
    """All buckets: those of the stream, and by the batch refresh the held-back and late ones."""
    stream = readings_of(v.stream_events())
    done = jobs.drain(v.spark, jobs.stream_rollup(stream, "15 minutes"), "stream-rollup")
    path = scratch_dir(v.spark, "stream-rollup-completed")
    jobs.complete_rollup(v.spark, v.readings, done, path, "15 minutes")
    return v.spark.read.parquet(path).drop("date")


# Days of the readings whose late rows the log must find again.
LATE_DAYS = ("2024-01-03", "2024-01-27")


@query("logged_rollup", sql(rollup_sql("15 minutes"), "readings"))
def _(v: Views) -> DataFrame:
    """The rollup kept by its log: readings first, then late ones of two days far apart."""
    base = scratch_dir(v.spark, "logged-rollup")
    late = F.to_date("time").cast("string").isin(*LATE_DAYS) & (F.hour("time") % 5 == 2)
    refreshed = []
    for k, rows in enumerate((v.readings.filter(~late), v.readings.filter(late))):
        rows.write.mode("append").parquet(f"{base}/landed")
        stream = v.spark.readStream.schema(v.readings.schema).parquet(f"{base}/landed")
        jobs.start_logged_facts(
            stream, f"{base}/facts", f"{base}/log", f"{base}/checkpoint", "15 minutes", trigger={"availableNow": True}
        ).awaitTermination()
        refreshed = jobs.refresh_logged(v.spark, f"{base}/facts", f"{base}/log", f"{base}/rollup", "15 minutes")
    if set(map(str, refreshed)) != set(LATE_DAYS):
        raise RuntimeError(f"refreshed {refreshed} instead of the late rows' days")
    return v.spark.read.parquet(f"{base}/rollup").drop("date").withColumns(
        {"avg_value": F.round("avg_value", 6), "stddev_value": F.round("stddev_value", 6)}
    )


def _version(*fields: tuple) -> contracts.Contract:
    made = [contracts.ContractField(name, kind, **options) for name, kind, options in fields]
    return contracts.Contract("reading", "sensor.raw", tuple(made))


_ID = ("event_id", T.LongType(), {})
VERSIONS = {
    "v1": _version(_ID, ("value", T.IntegerType(), {}), ("flag", T.StringType(), {"enum": ("GOOD", "BAD", "UNCERTAIN")})),
    "v2": _version(
        _ID, ("value", T.LongType(), {"nullable": True}), ("flag", T.StringType(), {"enum": ("GOOD", "BAD")}),
        ("unit", T.StringType(), {}),
    ),
    "v3": _version(_ID, ("value", T.StringType(), {}), ("unit", T.StringType(), {})),
    "v4": _version(
        _ID, ("value", T.DoubleType(), {"nullable": True}), ("unit", T.StringType(), {"default": "none"}),
        ("flag", T.StringType(), {"enum": ("GOOD", "BAD", "UNKNOWN"), "default": "GOOD"}),
    ),
}


@query(
    "read_versions",
    sql(
        """SELECT event_id, 'v' || (event_id % 4 + 1) AS version,
             CASE event_id % 4 WHEN 0 THEN CAST(floor(value) AS DOUBLE)
               WHEN 1 THEN CASE WHEN event_id % 3 > 0 THEN CAST(floor(value) AS DOUBLE) END
               ELSE value END AS value,
             CASE event_id % 4 WHEN 0 THEN 'none' ELSE unit END AS unit,
             CASE WHEN quality_flag <> 'UNCERTAIN' THEN quality_flag
               WHEN event_id % 4 = 1 THEN 'GOOD' ELSE 'UNKNOWN' END AS flag,
             CAST(NULL AS VARCHAR) AS rejected
           FROM readings WHERE event_id % 4 <> 2
           UNION ALL SELECT NULL, 'v3', NULL, NULL, NULL, 'type:value:string->double'""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """Readings written in turns under four versions of a contract and read by the newest one; the
    third version does not resolve and comes out as one row with its reason."""
    base = scratch_dir(v.spark, "versions")
    flag, odd = F.col("quality_flag"), F.col("event_id") % 3 == 0
    whole = F.floor("value")
    written = {
        "v1": {"value": whole.cast("int"), "flag": flag},
        "v2": {"value": F.when(~odd, whole), "flag": F.when(flag != "UNCERTAIN", flag), "unit": F.col("unit")},
        "v3": {"value": F.col("value").cast("string"), "unit": F.col("unit")},
        "v4": {"value": F.col("value"), "unit": F.col("unit"), "flag": F.when(flag == "UNCERTAIN", "UNKNOWN").otherwise(flag)},
    }
    files = {}
    for k, (name, columns) in enumerate(written.items()):
        rows = v.readings.filter(F.col("event_id") % 4 == k)
        rows.select("event_id", *[c.alias(n) for n, c in columns.items()]).write.parquet(f"{base}/{name}")
        files[name] = (VERSIONS[name], [f"{base}/{name}"])
    found, rejected = evolution.read_versions(v.spark, files, VERSIONS["v4"], {"flag": "UNKNOWN"})
    reasons = [(name, "; ".join(r)) for name, r in rejected.items()]
    refused = v.spark.createDataFrame(reasons, "version string, rejected string")
    return found.unionByName(refused, allowMissingColumns=True)


@query(
    "merged_records",
    sql("""SELECT platform_id, reading_id, true AS in_whole_batch FROM readings""", "readings"),
)
def _(v: Views) -> DataFrame:
    """Readings of a stream of four files, merged per platform by 100 records or 5 seconds."""
    base = scratch_dir(v.spark, "merged")
    v.readings.select("platform_id", "sensor_id", "reading_id").repartition(4, "reading_id").write.parquet(f"{base}/landed")
    rows = v.spark.read.parquet(f"{base}/landed")
    stream = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landed")
    records = sinks.to_keyed_records(stream, ["sensor_id"])
    records = records.withColumn("platform_id", F.get_json_object("value", "$.platform_id"))
    merged = merging.merge_records(records, ("platform_id",), lanes=1)
    job = jobs.start_file_sink(merged, f"{base}/out", f"{base}/checkpoint", trigger={"processingTime": "1 second"})
    batches = merging.await_records(v.spark, job, f"{base}/out", merged.schema, rows.count())
    whole = (F.col("closed_by") == "time") | (F.col("records") >= merging.MIN_RECORDS)
    return batches.select("platform_id", whole.alias("in_whole_batch"), F.explode("values").alias("value")).select(
        "platform_id", F.get_json_object("value", "$.reading_id").alias("reading_id"), "in_whole_batch"
    )


def _over_floor(pdf, config):
    """How often a value holds the floor; a reading below it is an error."""
    value = pdf["value"].to_numpy()
    if (value < config["floor"]).any():
        raise ValueError(f"below {config['floor']:g}")
    return pd.DataFrame({"times": value / config["floor"]})


@query(
    "user_stage",
    sql(
        """SELECT reading_id, CASE WHEN value >= 3 THEN round(value / 3, 6) END AS times,
             CASE WHEN value < 3 THEN 'over_floor' END AS stage,
             CASE WHEN value < 3 THEN 'stage_error' END AS error_reason,
             CASE WHEN value < 3 THEN 'ValueError: below 3' END AS error_text FROM readings""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """A user's record function that raises on some readings, both outputs together."""
    floor = stages.Property("floor", float, required=True, low=0.0)
    run = flow.stage(stages.isolated(_over_floor, "times double", (floor,), {"floor": "3"}), name="over_floor", stored=True)
    rows = v.readings.select("reading_id", "value")
    # A file may be one task; the function costs far more than the shuffle of two columns.
    tasks = 2 * v.spark.sparkContext.defaultParallelism
    passed, failed = run(rows.repartition(tasks, "reading_id"))
    return passed.unionByName(failed, allowMissingColumns=True).drop("value")


@query(
    "compacted_topic",
    sql(
        f"""SELECT sensor_id, reading_id, "time", value FROM (
              SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY "time" DESC, reading_id DESC) AS n
              FROM readings WHERE "time" >= {NOW} - INTERVAL '20 days')
            WHERE n = 1 AND quality_flag <> 'BAD'""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """A topic that is compacted and expires, fed in nine micro-batches and folded by threes; a
    sensor whose newest reading is bad counts as deleted. One micro-batch comes twice."""
    base = scratch_dir(v.spark, "compacted-topic")
    rows = v.readings.select("sensor_id", "reading_id", "time", "value", "quality_flag")
    rows.repartition(9, "reading_id").write.parquet(f"{base}/landed")
    topic = compacted.CompactedTopic(
        f"{base}/topic", rows.schema, ("sensor_id",), "time", ("reading_id",), "quality_flag = 'BAD'",
        retention_days=20, buckets=2, fan=3,
    )
    stream = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landed")
    compacted.start_compacted(stream, topic, f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    if compacted.write_delta(topic, rows.limit(0), 4):
        raise RuntimeError("a micro-batch came in twice")
    compacted.fold(v.spark, topic, AS_OF)
    compacted.drop_hidden(v.spark, topic, 0.0)
    return compacted.read_topic(v.spark, topic, AS_OF).drop("quality_flag")


@query("stream_detect", DETECT_SQL)
def _(v: Views) -> DataFrame:
    stream = readings_of(v.stream_events()).drop("event_id", "event_type")
    found = stream_detectors.stream_detect_all(stream, FIXTURE)
    return jobs.drain(v.spark, found, "stream-detect").select(*ALERT_COLUMNS)


@query(
    "stream_dlq",
    sql(
        """SELECT 'parse' AS stage, error_reason, sensor_id, platform_id, body,
             received_at AS failed_at FROM parsed WHERE error_reason IS NOT NULL""",
        "parsed",
    ),
)
def _(v: Views) -> DataFrame:
    rejects = parse.parse_reading(raw_of(readings_of(v.stream_events())))[1]
    dead = sinks.to_dlq(rejects, "parse", F.col("received_at"))
    return jobs.drain(v.spark, dead, "stream-dlq").drop("error_text")


@query(
    "stream_dedup",
    sql(
        """SELECT alert_id, sensor_id, detected_at FROM (
             SELECT *, lag(detected_at) OVER (PARTITION BY sensor_id ORDER BY detected_at) AS before
             FROM alerts)
           WHERE before IS NULL OR detected_at > before + INTERVAL '24 hours'""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    stream = alerts_of(readings_of(v.stream_events())).select(
        "alert_id", "sensor_id", "detected_at"
    )
    kept = stream_detectors.stream_dedup_alerts(stream, ("sensor_id",), "24 hours")
    return jobs.drain(v.spark, kept, "stream-dedup")


def _arriving(v: Views, rows: DataFrame, ts: str, id_col: str, purpose: str) -> DataFrame:
    """``rows`` landed week by week, a fifth of them each 0, 4, ... 16 hours late, as a stream.

    Files of one week may come in any order, so a stream needs a lateness of 8 days to lose none.
    A micro-batch takes three weeks, however many tasks wrote them: their number does not grow.
    """
    path = f"{scratch_dir(v.spark, purpose)}/landed"
    second = F.unix_seconds(ts)
    delay = F.pmod(F.xxhash64(id_col), F.lit(5)) * 4 * 3600
    ends = rows.agg(F.min(second).alias("low"), F.max(second + delay).alias("high")).first()
    low, high = (ends.low, ends.high) if ends.low is not None else (0, 0)
    week = F.floor((second + delay - F.lit(low)) / (7 * 86400))
    weeks = (high - low) // (7 * 86400) + 1
    for i in range(weeks):  # in turn, as the source goes by age
        rows.filter(week == i).write.mode("append").parquet(path)
    files = len(v.spark.read.schema(rows.schema).parquet(path).inputFiles())
    stream = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3 * -(-files // weeks))
    return stream.parquet(path)


LATENESS = "9 days"
HORIZON = """(SELECT date_trunc('millisecond', max("time")) - INTERVAL '9 days' FROM readings)"""
EPISODES = """
    SELECT sensor_id, min("time") AS since, max("time") AS last, max_by(later, "time") AS later
    FROM (SELECT *, sum(starts) OVER (PARTITION BY sensor_id ORDER BY "time") AS run
          FROM (SELECT *, lead("time") OVER w AS later, CASE WHEN held AND lag(held) OVER w
                    AND "time" <= lag("time") OVER w + INTERVAL '1 day' THEN 0 ELSE 1 END AS starts
                FROM (SELECT sensor_id, "time", bool_and(coalesce(value > 20, false)) AS held
                      FROM readings GROUP BY ALL)
                WINDOW w AS (PARTITION BY sensor_id ORDER BY "time")))
    WHERE held GROUP BY sensor_id, run"""


@query(
    "stream_episodes",
    sql(
        f"""SELECT * FROM (WITH ended AS (SELECT *, least(coalesce(later, last + INTERVAL '1 day'), last + INTERVAL '1 day') AS until,
                CASE WHEN later <= last + INTERVAL '1 day' THEN 'sample' ELSE 'silence' END AS closed_by
              FROM ({EPISODES}))
            SELECT sensor_id, 'firing' AS event, since, since + INTERVAL '12 hours' AS "at", NULL AS closed_by
            FROM ended WHERE until - since >= INTERVAL '12 hours' AND since + INTERVAL '12 hours' < {HORIZON}
            UNION ALL
            SELECT sensor_id, 'resolved', since, until, closed_by
            FROM ended WHERE until - since >= INTERVAL '12 hours' AND until < {HORIZON})""",
        "readings",
    ),
)
def _(v: Views) -> DataFrame:
    """Sensors above a limit for half a day, and when that ended, by a reading or a day of silence.

    Events before the watermark at the end of the stream."""
    rows = v.readings.select("sensor_id", "time", "value", "reading_id")
    stream = _arriving(v, rows, "time", "reading_id", "stream-episodes")
    found = timers.stream_episodes(stream, F.col("value") > 20, "12 hours", "1 day", LATENESS, ("sensor_id",), "time")
    return jobs.drain(v.spark, found, "stream-episodes")


@query(
    "stream_notifications",
    sql(
        """SELECT * FROM (WITH starting AS (SELECT anomaly_type AS alertname, severity, detected_at,
                CASE WHEN detected_at <= lag(detected_at) OVER (PARTITION BY anomaly_type, severity
                  ORDER BY detected_at) + INTERVAL '6 hours' THEN 0 ELSE 1 END AS starts FROM alerts),
              numbered AS (SELECT *, sum(starts) OVER (PARTITION BY alertname, severity
                  ORDER BY detected_at) AS session FROM starting),
              placed AS (SELECT *, min(detected_at) OVER s AS session_start, max(detected_at) OVER s AS session_end
                FROM numbered WINDOW s AS (PARTITION BY alertname, severity, session)),
              slotted AS (SELECT *, CAST(floor((epoch_us(detected_at) - epoch_us(session_start)) / 43200e6) AS BIGINT)
                  AS slot FROM placed),
              timed AS (SELECT *, min(detected_at) OVER (PARTITION BY alertname, severity, session, slot)
                  + INTERVAL '1 hour' AS due FROM slotted),
              events AS (
                SELECT alertname, severity, 'notified' AS event, session_start, slot, due AS "at",
                  count(*) FILTER (WHERE detected_at <= due) AS alerts FROM timed
                GROUP BY alertname, severity, session_start, slot, due
                UNION ALL
                SELECT alertname, severity, 'resolved', session_start, NULL, session_end + INTERVAL '6 hours', count(*)
                FROM timed GROUP BY alertname, severity, session_start, session_end)
            SELECT * FROM events
            WHERE "at" < (SELECT date_trunc('millisecond', max(detected_at)) - INTERVAL '9 days' FROM alerts))""",
        "alerts",
    ),
)
def _(v: Views) -> DataFrame:
    """Alerts of a stream grouped by kind and severity: one notification an hour after the first alert
    of each half day, and the end of a session after six quiet hours."""
    rows = v.alerts.select(F.col("anomaly_type").alias("alertname"), "severity", "detected_at", "alert_id")
    stream = _arriving(v, rows, "detected_at", "alert_id", "stream-notifications")
    found = timers.stream_notifications(
        stream, ("alertname", "severity"), "12 hours", "6 hours", "1 hour", LATENESS, "detected_at"
    )
    return jobs.drain(v.spark, found, "stream-notifications")
