from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import at, readings
from fieldpulse.functions.guards import above, clamp, is_filled
from fieldpulse.operators.assets import (
    assess_emissions,
    audit_failures,
    emission_summary,
    equipment_health,
)
from fieldpulse.operators.joins import (
    append_new,
    enrich,
    expand_sensors,
    join_by_field,
    orphans,
    platform_health,
    seasonal_residual,
)
from fieldpulse.operators.routing import (
    alert_to_json,
    compliance_events,
    route_all,
    route_severity,
    rule_anomalies,
    split_by,
    union_dlq,
)
from fieldpulse.plans.flow import stage
from fieldpulse.sources.reference import signals


@pytest.fixture(scope="module")
def dims(spark):
    platforms = spark.createDataFrame(
        [("P1", "Alpha", 1.0, 2.0, "North", "ACTIVE"), ("P2", "Beta", 3.0, 4.0, "South", "ACTIVE"),
         ("P3", "Gone", 3.0, 4.0, "South", "RETIRED")],
        "platform_id string, platform_name string, latitude double, longitude double, region string, status string",
    )
    equipment = spark.createDataFrame(
        [("E1", "P1", "Pump A", "pump", at(-3600)), ("E2", "P2", "Valve", "valve", None), ("E9", "PX", "Lost", "pump", None)],
        "equipment_id string, platform_id string, equipment_name string, equipment_type string, last_maintenance timestamp",
    )
    sensors = spark.createDataFrame(
        [("A", "E1", "P1", "ACTIVE"), ("B", "E2", "P2", "ACTIVE"), ("C", "EX", "P1", "INACTIVE"), ("D", "E9", "P1", "ACTIVE")],
        "sensor_id string, equipment_id string, platform_id string, status string",
    )
    return platforms, equipment, sensors


def test_enrich(spark, dims):
    platforms, equipment, sensors = dims
    df = readings(spark, [("A", 0, 1.0), ("B", 0, 1.0), ("C", 0, 1.0), ("D", 0, 1.0), ("Z", 0, 1.0)])
    got = {r.sensor_id: r for r in enrich(df, sensors, equipment, platforms).collect()}
    assert {k: r.match_status for k, r in got.items()} == {
        "A": "matched", "B": "matched", "C": "equipment_unknown", "D": "platform_unknown", "Z": "sensor_unknown"
    }
    assert (got["A"].equipment_name, got["A"].region) == ("Pump A", "North")
    assert got["A"].equipment_metadata.platform_name == "Alpha" and got["Z"].equipment_metadata is None


def test_platform_health(spark, dims):
    platforms, _, sensors = dims
    alerts = spark.createDataFrame(
        [("a1", "P1", False, at(1)), ("a2", "P1", True, at(9)), ("a3", "P1", False, at(3)), ("a4", "P3", False, at(3))],
        "alert_id string, platform_id string, resolved boolean, detected_at timestamp",
    )
    got = {r.platform_id: r for r in platform_health(platforms, sensors, alerts).collect()}
    assert set(got) == {"P1", "P2"}
    assert (got["P1"].sensor_count, got["P1"].alert_count, got["P1"].latest_alert_time) == (2, 2, at(9))
    assert (got["P2"].sensor_count, got["P2"].alert_count, got["P2"].latest_alert_time) == (1, 0, None)


def test_expand_and_append(spark, dims):
    _, equipment, _ = dims
    fitted = expand_sensors(equipment)
    assert fitted.count() == 10 and fitted.filter("sensor_id = 'E1-TEMP-02'").count() == 1
    again = append_new(fitted, expand_sensors(equipment).unionByName(fitted), ["sensor_id"])
    assert again.count() == 10
    new = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("x", 0, "held")], "id string, n int, v string")
    old = spark.createDataFrame([("x", 9, "old")], "id string, n int, v string")
    got = {r.id: r.v for r in append_new(old, new, ["id"], ["n"]).collect()}
    assert got == {"x": "old", "k": "early"}


def test_append_new_on_a_much_repeated_key(spark):
    incoming = spark.range(20000).select(F.lit("hot").alias("id"), F.col("id").alias("n"))
    old = spark.createDataFrame([], "id string, n bigint")
    assert append_new(old, incoming, ["id"], ["n"]).first().n == 0


def test_join_by_field_and_orphans(spark, dims):
    platforms, equipment, sensors = dims
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "c string, value double")
    b = spark.createDataFrame([("y", 3.0)], "c string, value double")
    c = spark.createDataFrame([("z", 4.0)], "c string, value double")
    got = {r.c: (r.a, r.b, r.d) for r in join_by_field({"a": a, "b": b, "d": c}, "c").collect()}
    assert got == {"x": (1.0, None, None), "y": (2.0, 3.0, None), "z": (None, None, 4.0)}
    assert [r.sensor_id for r in orphans(sensors, equipment, "equipment_id").collect()] == ["C"]
    assert [r.equipment_id for r in orphans(equipment, platforms, "platform_id").collect()] == ["E9"]


def test_seasonal(spark):
    df = readings(spark, [("A", 6 * 3600, 60.0)]).withColumn("subtype", F.lit("bearing_temp"))
    row = seasonal_residual(df, signals(spark), at(0)).first()
    assert row.expected == pytest.approx(58.0) and row.residual == pytest.approx(2.0)
    other = seasonal_residual(df.drop("subtype"), signals(spark), at(0)).first()
    assert (other.expected, other.residual) == (50.0, 10.0)


def test_routes(spark):
    df = readings(spark, [("A", 0, 200.0), ("A", 1, 20.0), ("A", 2, float("nan")), ("A", 3, None)]).withColumn(
        "quality_score", F.when(F.col("value") == 200.0, 0.4)
    )
    got = rule_anomalies(df).collect()
    assert sorted(r.anomaly_type for r in got) == ["quality_anomaly", "temperature_anomaly"]
    assert {r.severity for r in got} == {"WARNING"}
    kept = rule_anomalies(df, keep_normal=True)
    assert kept.filter("anomaly_type = 'unmatched' AND stage = 'analyzed'").count() == 3
    routed = route_all(df, {"hot": F.col("value") > 100, "any": F.col("sensor_id") == "A"})
    assert routed.filter("route = 'any'").count() == 4


@pytest.mark.parametrize(
    "kind, value, rule",
    [
        ("TEMPERATURE", 150.0, None),
        ("temperature", 150.1, "temperature_anomaly"),
        ("temperature", -40.0, None),
        ("temperature", -40.1, "temperature_anomaly"),
        ("pressure", 5000.0, None),
        ("pressure", 5000.1, "pressure_anomaly"),
        ("pressure", -0.1, "pressure_anomaly"),
        ("flow_rate", 10000.0, None),
        ("flow_rate", 10000.1, "flow_anomaly"),
        ("flow_rate", -5.0, None),
        ("vibration", 1e9, None),
    ],
)
def test_rule_edges(spark, kind, value, rule):
    df = readings(spark, [("A", 0, value)]).withColumns(
        {"sensor_type": F.lit(kind), "quality_score": F.lit(0.5)}
    )
    got = [r.anomaly_type for r in rule_anomalies(df).collect()]
    assert got == ([rule] if rule else [])


def test_severity_documents_and_compliance(spark):
    df = spark.createDataFrame(
        [("r1", "S", "P", "temperature", 1.5, "c", "threshold_exceeded", "CRITICAL", at(0)),
         ("r2", "S", "P", "h2s_concentration", 1.5, None, "threshold_warning", "WARNING", at(0)),
         ("r3", "S", "P", "GAS_EMISSION", 1.5, "c", "threshold_exceeded", "CRITICAL", at(0)),
         ("r4", "S", "P", "pressure", 1.5, "c", "x", "INFO", at(0)),
         ("r5", "S", "P", "pressure", 1.5, "c", "x", "ODD", at(0))],
        "reading_id string, sensor_id string, platform_id string, sensor_type string, value double, unit string, "
        "anomaly_type string, severity string, detected_at timestamp",
    )
    routed = route_severity(df)
    got = {r.reading_id: (r.severity_route, r.priority, r.notify, r.channel) for r in routed.collect()}
    assert got == {
        "r1": ("critical", "P1", "true", "pagerduty"),
        "r2": ("warning", "P2", "true", "slack"),
        "r3": ("critical", "P1", "true", "pagerduty"),
        "r4": ("info", None, None, None),
        "r5": ("unmatched", None, None, None),
    }
    document = json.loads(alert_to_json(routed).orderBy("reading_id").collect()[1].document)
    assert len(document) == 10 and document["unit"] == "" and document["alert.channel"] == "slack"
    events = [(r.reading_id, r.report_type) for r in compliance_events(df).collect()]
    assert sorted(events) == [
        ("r1", "safety_event"), ("r2", "emission_event"), ("r3", "emission_event"), ("r3", "safety_event")
    ]
    parts = split_by(df, "severity", ["CRITICAL", "WARNING"])
    assert {k: p.count() for k, p in parts.items()} == {"CRITICAL": 2, "WARNING": 1, "unmatched": 2}


def test_user_stage(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 1, -1.0)])

    def positive(frame, limit):
        return frame.withColumn("error_reason", F.when(F.col("value") < limit, "too_low"))

    passed, failed = stage(positive, 0.0)(df)
    assert passed.count() == 1 and "error_reason" not in passed.columns
    assert failed.first().stage == "positive"
    clean, none = stage(lambda frame: frame, name="noop")(df)
    assert clean.count() == 2 and none.count() == 0


def test_emissions(spark):
    df = spark.createDataFrame(
        [("m1", "P", "CO2", 100.0, 100.0, at(0)), ("m2", "P", "CO2", 100.1, 100.0, at(0)),
         ("m3", "P", "CO2", float("nan"), 100.0, at(0)), ("m4", "P", "CO2", 1.0, 100.0, dt.datetime(2024, 12, 31))],
        "measurement_id string, platform_id string, emission_type string, value_ppm double, limit_ppm double, measured_at timestamp",
    )
    rows = {r.measurement_id: (r.compliant, r.reporting_period) for r in assess_emissions(df).collect()}
    assert rows == {"m1": (True, "2024-Q1"), "m2": (False, "2024-Q1"), "m3": (False, "2024-Q1"), "m4": (True, "2024-Q4")}
    summary = {r.reporting_period: r for r in emission_summary(assess_emissions(df)).collect()}
    assert (summary["2024-Q1"].measurements, summary["2024-Q1"].exceedances) == (3, 2)
    limits = spark.createDataFrame([("CO2", 50.0)], "emission_type string, limit_ppm double")
    assert assess_emissions(df, limits).filter("compliant").count() == 1


def test_equipment_health(spark, dims):
    _, equipment, sensors = dims
    df = readings(spark, [("A", i, 1.0) for i in range(20)])
    alerts = spark.createDataFrame(
        [("A", "WARNING", at(1)), ("A", "CRITICAL", at(2))], "sensor_id string, severity string, detected_at timestamp"
    )
    got = {r.equipment_id: r for r in equipment_health(df, alerts, equipment, sensors, at(60)).collect()}
    assert (got["E1"].status, got["E1"].health_score) == ("DEGRADED", pytest.approx(0.925))
    assert got["E1"].hours_since_maintenance == pytest.approx(3660 / 3600)
    assert (got["E2"].status, got["E2"].health_score) == ("OFFLINE", 0.0)


def test_audit(spark):
    rows = [("parse", "bad", None, "S1", "P", "b1", at(0)), ("parse", "bad", None, "S2", "P", "b2", at(5)),
            ("gate", "empty", None, None, None, "b3", at(1))]
    dlq = spark.createDataFrame(
        rows, "stage string, error_reason string, error_text string, sensor_id string, platform_id string, "
        "body string, failed_at timestamp")
    got = {r.stage: r for r in audit_failures(dlq).collect()}
    assert (got["parse"].failures, got["parse"].sensors, got["parse"].sample_body) == (2, 2, "b2")
    assert "sample_body" not in audit_failures(dlq, with_payload=False).columns
    assert union_dlq(dlq, dlq.drop("error_text")).count() == 6


def test_guards(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (5.0,)], "v double")
    got = [r.x for r in df.select(above(F.col("v"), 1).alias("x")).collect()]
    assert got == [False, False, True]
    clamped = [r.x for r in df.select(clamp(F.col("v"), 0, 3).alias("x")).collect()]
    assert clamped[0] != clamped[0] and clamped[1:] == [None, 3.0]
    text = spark.createDataFrame([(" ",), ("",), (None,), ("x",)], "t string")
    assert [r.x for r in text.select(is_filled(F.col("t")).alias("x")).collect()] == [False, False, False, True]
