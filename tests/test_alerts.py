from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import at
from fieldpulse.functions.times import seconds_of
from fieldpulse.operators.alerts import correlate, dedup_alerts, escalate, resolve, write_alerts
from fieldpulse.sources.reference import escalation_rules

SCHEMA = (
    "alert_id string, sensor_id string, anomaly_type string, severity string, "
    "equipment_id string, platform_id string, detected_at timestamp"
)


def alerts(spark, rows):
    """Alerts from (sensor, seconds, severity) triples."""
    full = [
        (f"a{i:05d}", s, "threshold_exceeded", sev, f"E{s[-1]}", "P1", at(t))
        for i, (s, t, sev) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def kept_by_walk(rows, window, mode):
    kept, last = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i)):
        sensor, t = rows[i][0], round(rows[i][1] * 1000)
        if sensor not in last or t - last[sensor] > window * 1000:
            kept.add(f"a{i:05d}")
            last[sensor] = t
        elif mode == "quiet_gap":
            last[sensor] = t
    return kept


def burst_rows(seed):
    """One sensor with most alerts, in bursts and dense runs; others sparse; equal times occur."""
    rng = random.Random(seed)
    rows = []
    for sensor, count in (("HOT0", 1500), ("S1", 60), ("S2", 3), ("S3", 1)):
        t = round(rng.uniform(0, 4000), 1)
        for _ in range(count):
            t += rng.choice([0, 1, 5, 60, 300, 1800, 1800.5, 2500])
            rows.append((sensor, round(t, 1), "WARNING"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("mode", ["quiet_gap", "fixed"])
@pytest.mark.parametrize("window, slice_width", [("30 minutes", "1 day"), ("30 minutes", "1 hour"),
                                                 ("5 minutes", "10 minutes"), ("2 hours", "1 hour")])
def test_dedup_equals_walk(spark, mode, window, slice_width):
    rows = burst_rows(len(window) + len(mode))
    got = dedup_alerts(alerts(spark, rows), window=window, mode=mode, slice_width=slice_width)
    found = {r.alert_id for r in got.collect()}
    assert found == kept_by_walk(rows, seconds_of(window), mode)
    assert got.columns == alerts(spark, rows[:1]).columns


def test_dedup_edges(spark):
    rows = [("S1", 0, "INFO"), ("S1", 1800, "INFO"), ("S1", 3600.001, "INFO")]
    for mode, kept in (("quiet_gap", ["a00000", "a00002"]), ("fixed", ["a00000", "a00002"])):
        got = dedup_alerts(alerts(spark, rows), mode=mode)
        assert sorted(r.alert_id for r in got.collect()) == kept
    steady = [("S1", i * 1000, "INFO") for i in range(6)]
    quiet = dedup_alerts(alerts(spark, steady))
    fixed = dedup_alerts(alerts(spark, steady), mode="fixed")
    assert [r.alert_id for r in quiet.collect()] == ["a00000"]
    assert sorted(r.alert_id for r in fixed.collect()) == ["a00000", "a00002", "a00004"]
    with pytest.raises(ValueError):
        dedup_alerts(alerts(spark, rows), mode="other")


def test_keys_do_not_mix(spark):
    df = alerts(spark, [("S1", 0, "INFO"), ("S2", 1, "INFO")]).unionByName(
        alerts(spark, [("S1", 2, "INFO")]).withColumns(
            {"alert_id": F.lit("b"), "anomaly_type": F.lit("rate_of_change_spike")}
        )
    )
    assert dedup_alerts(df).count() == 3
    assert dedup_alerts(df, mode="fixed").count() == 3


def test_correlate(spark):
    rows = [
        ("A1", 10, "WARNING"), ("B1", 20, "CRITICAL"), ("A1", 30, "WARNING"),
        ("A1", 299, "WARNING"), ("B1", 300, "WARNING"),
        ("A2", 10, "WARNING"), ("A2", 11, "WARNING"),
    ]
    got = correlate(alerts(spark, rows)).collect()
    assert [(r.equipment_id, r.sensors, r.alerts, r.severity) for r in got] == [("E1", 2, 4, "CRITICAL")]
    assert got[0].bucket == at(0) and got[0].first_at == at(10) and got[0].last_at == at(299)


def test_escalate(spark):
    df = alerts(spark, [("S1", 0, "CRITICAL"), ("S2", 0, "WARNING"), ("S3", 0, "INFO"), ("S4", 0, "NORMAL")])
    df = df.withColumn("resolved_at", F.when(F.col("sensor_id") == "S1", F.lit(at(10))).cast("timestamp"))
    rules = escalation_rules(spark)
    got = escalate(df, rules).collect()
    actions = defaultdict(set)
    for r in got:
        actions[r.sensor_id].add((r.action_type, r.notify_at))
    assert actions == {
        "S1": {("webhook", at(0)), ("pagerduty", at(0))},
        "S2": {("webhook", at(0)), ("email", at(60))},
        "S3": {("log", at(0))},
    }
    assert escalate(df, rules, at(59)).filter("action_type = 'email'").count() == 0
    attempts = escalate(df, rules, each_attempt=True).groupBy("sensor_id", "action_type").count()
    assert {(r.sensor_id, r.action_type): r["count"] for r in attempts.collect()}[("S1", "pagerduty")] == 5
    off = rules.withColumn("enabled", F.col("action_type") != "webhook")
    assert escalate(df, off).filter("action_type = 'webhook'").count() == 0


def test_store_and_resolve(spark, tmp_path):
    path = str(tmp_path / "alerts")
    write_alerts(alerts(spark, [("S1", 0, "INFO"), ("S2", 90_000, "INFO")]), path)
    stored = spark.read.parquet(path)
    assert {str(r.date) for r in stored.collect()} == {"2024-01-01", "2024-01-02"}
    assert stored.filter("resolved OR acknowledged").count() == 0
    acks = spark.createDataFrame(
        [("a00000", "late", at(50), at(70)), ("a00000", "first", at(40), None), ("zz", "x", at(1), None)],
        "alert_id string, acknowledged_by string, acknowledged_at timestamp, resolved_at timestamp",
    )
    done = {r.alert_id: r for r in resolve(stored, acks).collect()}
    assert len(done) == 2
    first = done["a00000"]
    assert (first.acknowledged, first.acknowledged_by, first.acknowledged_at) == (True, "first", at(40))
    assert (first.resolved, first.resolved_at) == (True, at(70))
    assert (done["a00001"].acknowledged, done["a00001"].resolved) == (False, False)
