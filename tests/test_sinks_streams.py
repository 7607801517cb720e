from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import READING_SCHEMA, at, readings
from fieldpulse.config import DetectorConfig
from fieldpulse.operators.alerts import correlate, dedup_alerts
from fieldpulse.operators.detect import detect_all
from fieldpulse.operators.joins import enrich
from fieldpulse.operators.metrics import sustained
from fieldpulse.operators.rollup import ingest_stats, rollup
from fieldpulse.operators.routing import route_severity, rule_anomalies
from fieldpulse.operators.validate import validate_range
from fieldpulse.plans.flow import Dimensions, FlowConfig, run_batch
from fieldpulse.sources import contracts, readers, sinks
from fieldpulse.streaming import detectors, jobs


def folders(path):
    return {
        os.path.relpath(base, path)
        for base, _, files in os.walk(path)
        if any(not f.startswith((".", "_")) for f in files)
    }


def test_reading_table(spark, tmp_path):
    path = str(tmp_path / "facts")
    df = readings(spark, [("A", 0.25, 1.0), ("B", 86400, 2.0)]).withColumn("extra", F.lit(1))
    sinks.write_readings(df.drop("quality_flag"), path)
    sinks.write_readings(df, path)
    stored = spark.read.parquet(path)
    assert set(stored.columns) == {*sinks.READING_COLUMNS, "date"} and stored.count() == 4
    assert folders(path) == {"date=2024-01-01", "date=2024-01-02"}
    assert stored.filter("quality_flag = 'GOOD'").count() == 4
    assert sinks.to_reading_rows(df, "second").orderBy("time").first().time == at(0)


def test_date_bound_prunes_partitions(spark, tmp_path):
    from fieldpulse.functions.times import since

    path = str(tmp_path / "facts")
    sinks.write_readings(readings(spark, [("A", d * 86400, 1.0) for d in range(5)]), path)
    recent = since(spark.read.parquet(path), at(4 * 86400), "1 day")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and recent.count() == 2


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = readings(spark, [("A", 0.5, 1.25), ("B", 1, 2.0)])
    sinks.write_csv_readings(df, path)
    header = open(next(f"{path}/{f}" for f in os.listdir(path) if f.endswith(".csv"))).readline()
    assert header.strip() == "reading_id,platform_id,sensor_id,sensor_type,value,unit,timestamp,quality_flag"
    back = readers.read_csv_readings(spark, path).orderBy("reading_id").collect()
    assert back[0].timestamp == 1704067200500 and back[0].value == 1.25


def test_archives(spark, tmp_path):
    df = readings(spark, [("A", 0, 1.0), ("A", 3600, None)])
    sinks.archive_json(df, str(tmp_path / "j"))
    base = "sensors/platform=P1/type=temperature/year=2024/month=01/day=01/hour="
    assert folders(tmp_path / "j") == {f"{base}00", f"{base}01"}
    part = tmp_path / "j" / f"{base}01"
    text = "".join(open(part / f).read() for f in os.listdir(part) if f.endswith(".json"))
    document = json.loads(text)
    assert document["value"] is None and document["sensor_id"] == "A"
    sinks.archive_json(df, str(tmp_path / "d"), layout="date")
    assert "sensors/year=2024/month=01/day=01/hour=00" in folders(tmp_path / "d")
    sinks.archive_parquet(df, str(tmp_path / "p"))
    assert folders(tmp_path / "p") == {"sensors/platform=P1/year=2024/month=01/day=01"}


def test_keyed_records(spark, tmp_path):
    df = spark.createDataFrame([("S", "spike", None)], "sensor_id string, kind string, note string")
    kept = sinks.to_keyed_records(df, ["sensor_id", "kind"], "alerts.critical").first()
    assert (kept.key, kept.topic) == ("S-spike", "alerts.critical")
    assert json.loads(kept.value) == {"sensor_id": "S", "kind": "spike", "note": None}
    dropped = sinks.to_keyed_records(df, ["sensor_id"], keep_nulls=False).first()
    assert "note" not in json.loads(dropped.value)
    sinks.write_records(sinks.to_keyed_records(df, ["sensor_id"], "t"), str(tmp_path / "r"))
    assert folders(tmp_path / "r") == {"topic=t"}
    assert sinks.TOPICS["compliance.emissions"].compacted and sinks.TOPICS["sensor.raw"].partitions == 5


def test_dlq_and_conversion(spark, tmp_path):
    bad = spark.createDataFrame([("x", "invalid_json")], "body string, error_reason string")
    sinks.write_dlq(sinks.to_dlq(bad, "parse", at(0).isoformat(" ")), str(tmp_path))
    assert "dlq/stage=parse/date=2024-01-01" in folders(tmp_path)
    row = sinks.to_dlq(bad.drop("body"), "gate").first()
    assert row.stage == "gate" and json.loads(row.body) == {"error_reason": "invalid_json"}
    df = readings(spark, [("A", 0, 1.0)]).withColumnRenamed("time", "timestamp")
    sinks.convert(df, contracts.READING, str(tmp_path / "c"), "json")
    assert spark.read.schema(contracts.READING.schema).json(str(tmp_path / "c")).first().timestamp == at(0)


def test_evolved(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.createDataFrame([("r1", 1.0)], "reading_id string, value double").write.parquet(old)
    spark.createDataFrame(
        [("r2", 2.0, "BAD", 7)], "reading_id string, value double, quality_flag string, other int"
    ).write.parquet(new)
    got = readers.read_evolved(spark, [old, new]).orderBy("reading_id").collect()
    assert [(r.reading_id, r.quality_flag, r.unit) for r in got] == [("r1", "GOOD", None), ("r2", "BAD", None)]


def test_fan_out_computes_once(spark):
    seen = []
    df = spark.range(10).withColumn("x", F.rand())
    sinks.fan_out(df, [lambda d: seen.append({r.x for r in d.collect()})] * 2)
    assert seen[0] == seen[1]


# --- streams --------------------------------------------------------------------------------


def landed(spark, path, rows, files=4):
    """Readings in time order, cut into several files so that each makes a micro-batch."""
    df = readings(spark, rows)
    ordered = df.orderBy("time", "reading_id").collect()
    size = -(-len(ordered) // files)
    for i in range(files):
        part = spark.createDataFrame(ordered[i * size : (i + 1) * size], READING_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)
    return df, (
        spark.readStream.schema(READING_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    )


def stream_rows(seed=7, n=240):
    rng = random.Random(seed)
    rows, t = [], 0.0
    for _ in range(n):
        t += rng.choice([0.5, 2, 20, 100])
        sensor = "HOT" if rng.random() < 0.5 else rng.choice(["A", "B", "C"])
        rows.append((sensor, t, round(rng.gauss(20, 3) * (6 if rng.random() < 0.05 else 1), 2)))
    return rows


def test_stream_detectors_equal_batch(spark, tmp_path):
    config = DetectorConfig(window_size=12, deviation_threshold=1.5, max_rate=1.0)
    df, stream = landed(spark, str(tmp_path / "in"), stream_rows())
    columns = ("alert_id", "severity", "anomaly_type", "actual_value", "description")
    got = jobs.drain(spark, detectors.stream_detect_all(stream, config), "t-detect").select(*columns)
    expected = detect_all(df, config).select(*columns)
    assert got.count() == expected.count() > 20
    assert got.exceptAll(expected).count() == 0


@pytest.mark.parametrize("mode", ["quiet_gap", "fixed"])
def test_stream_dedup_equals_batch(spark, tmp_path, mode):
    df, stream = landed(spark, str(tmp_path / "in"), stream_rows(9))
    named = {"alert_id": F.col("reading_id"), "detected_at": F.col("time"), "anomaly_type": F.lit("x")}
    got = jobs.drain(
        spark, detectors.stream_dedup_alerts(stream.withColumns(named), window="3 minutes", mode=mode), "t-dedup"
    )
    expected = dedup_alerts(df.withColumns(named), window="3 minutes", mode=mode)
    assert {r.alert_id for r in got.collect()} == {r.alert_id for r in expected.collect()}


def test_stream_rollup_equals_batch_for_closed_buckets(spark, tmp_path):
    df, stream = landed(spark, str(tmp_path / "in"), stream_rows())
    got = jobs.drain(spark, jobs.stream_rollup(stream, "1 minute", "10 minutes"), "t-rollup")
    last = max(r.time for r in df.collect())
    limit = F.lit(last).cast("timestamp") - F.expr("INTERVAL 11 MINUTES")
    expected = rollup(df, "1 minute").filter(F.col("bucket") <= limit)
    assert got.count() == expected.count() > 10
    assert got.select(expected.columns).exceptAll(expected).count() == 0


def test_refresh_completes_a_stream_rollup(spark, tmp_path):
    """A late reading and the buckets that the watermark holds back are filled in."""
    source = str(tmp_path / "in")
    rows, _ = landed(spark, source, stream_rows())
    late = readings(spark, [("A", 30.0, 99.0), ("B", -7200.0, 5.0)])
    late.coalesce(1).write.mode("append").parquet(source)
    for i, name in enumerate(sorted((f for f in os.listdir(source) if f.endswith(".parquet")), key=lambda f: os.path.getmtime(f"{source}/{f}"))):
        os.utime(f"{source}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(READING_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    got = jobs.drain(spark, jobs.stream_rollup(stream, "1 minute", "10 minutes"), "t-complete")
    facts, path = rows.unionByName(late), str(tmp_path / "out")
    expected = rollup(facts, "1 minute")
    n = got.agg(F.sum("reading_count")).first()[0]
    assert n < facts.count() - late.count()
    assert jobs.complete_rollup(spark, facts, got, path) == facts.count() - n
    full = spark.read.parquet(path).select(expected.columns)
    assert full.count() == expected.count() > got.count()
    assert full.select("bucket", "sensor_id", "reading_count", "max_value").exceptAll(
        expected.select("bucket", "sensor_id", "reading_count", "max_value")
    ).isEmpty()
    none = str(tmp_path / "none")
    assert jobs.complete_rollup(spark, facts, expected, none) == 0
    assert spark.read.parquet(none).count() == expected.count()
    assert jobs.complete_rollup(spark, facts, expected.limit(0), str(tmp_path / "all")) == facts.count()


def test_stream_aggregates_and_correlation(spark, tmp_path):
    df, stream = landed(spark, str(tmp_path / "in"), stream_rows())
    records = jobs.drain(spark, jobs.aggregate_stream(stream, "5 minutes"), "t-agg")
    assert records.filter("topic = 'sensor.aggregated' AND key = 'HOT'").count() > 5
    named = {"detected_at": F.col("time"), "equipment_id": F.lit("E"), "severity": F.lit("WARNING")}
    got = jobs.drain(spark, jobs.stream_correlate(stream.withColumns(named), "5 minutes"), "t-corr")
    expected = correlate(df.withColumns(named))
    assert 0 < got.count() <= expected.count()
    assert got.exceptAll(expected.select(got.columns)).count() == 0


def test_stream_sustained_equals_batch(spark, tmp_path):
    df, stream = landed(spark, str(tmp_path / "in"), stream_rows(3))
    held = F.col("value") < 21
    got = jobs.drain(
        spark, detectors.stream_sustained(stream, held, "40 seconds", ("sensor_id",), "time"), "t-hold"
    ).collect()
    expected = sustained(df, held, "40 seconds", ("sensor_id",), "time").collect()
    assert {(r.sensor_id, r.pending_since) for r in got} == {
        (r.sensor_id, r.pending_since) for r in expected
    } and got
    assert all((r.fired_at - r.pending_since).total_seconds() >= 40 for r in got)


def test_stateless_operators_on_a_stream(spark, tmp_path, dims):
    df, stream = landed(spark, str(tmp_path / "in"), [("S1", i, float(i * 30)) for i in range(8)])

    def chain(frame):
        checked = validate_range(frame, dims.sensors)
        known = enrich(checked, dims.sensors, dims.equipment, dims.platforms)
        scored = known.withColumn("quality_score", F.lit(0.9))
        return route_severity(rule_anomalies(scored)).drop("equipment_metadata")

    got = jobs.drain(spark, chain(stream), "t-chain")
    assert got.exceptAll(chain(df)).count() == 0 and got.count() == chain(df).count() == 2
    stats = jobs.drain(spark, ingest_stats(stream.withWatermark("time", "0 seconds"), "2 seconds"), "t-stats")
    assert stats.filter("readings = 2").count() >= 2


def test_stream_sinks(spark, tmp_path):
    df, stream = landed(spark, str(tmp_path / "in"), stream_rows(5, 40))
    once = {"trigger": {"availableNow": True}}
    base = str(tmp_path)
    jobs.start_readings_sink(stream, f"{base}/facts", f"{base}/c1", **once).awaitTermination()
    assert spark.read.parquet(f"{base}/facts").count() == 40
    jobs.start_archive_sink(stream, f"{base}/arch", f"{base}/c2", **once).awaitTermination()
    assert spark.read.json(f"{base}/arch/sensors").count() == 40
    records = sinks.to_keyed_records(stream, ["sensor_id"], "sensor.raw")
    jobs.start_records_sink(records, f"{base}/topics", f"{base}/c3", **once).awaitTermination()
    assert spark.read.parquet(f"{base}/topics").filter("topic = 'sensor.raw'").count() == 40
    dead = sinks.to_dlq(stream, "parse", F.col("time"))
    jobs.start_dlq_sink(dead, base, f"{base}/c4", **once).awaitTermination()
    assert spark.read.json(f"{base}/dlq").count() == 40
    alerts = detectors.stream_detect_all(stream, DetectorConfig(window_size=6))
    jobs.start_alert_sink(alerts, f"{base}/alerts", f"{base}/c5", **once).awaitTermination()
    assert spark.read.parquet(f"{base}/alerts").filter("NOT resolved").count() > 0
    newest = jobs.read_compacted(spark, f"{base}/facts", ("sensor_id",), "time", ("reading_id",))
    assert newest.count() == df.select("sensor_id").distinct().count()
    jobs.compact_log(spark, f"{base}/facts", f"{base}/state", ("sensor_id",), "time")
    assert spark.read.parquet(f"{base}/state").count() == newest.count()


def raw_file(path, i, documents):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-{i}.json", "w") as f:
        f.write("\n".join(documents) + "\n")


def document(i, **changes):
    doc = {"reading_id": f"r{i}", "platform_id": "P1", "sensor_id": "S1", "sensor_type": "TEMPERATURE",
           "value": 50.0, "unit": "degC", "timestamp": 1704067200000 + i * 1000, "quality_flag": "GOOD"}
    return json.dumps({**doc, **changes})


@pytest.fixture()
def dims(spark):
    return Dimensions(
        spark.createDataFrame([("P1", "Alpha", 1.0, 2.0, "North")],
                              "platform_id string, platform_name string, latitude double, longitude double, region string"),
        spark.createDataFrame([("E1", "P1", "Pump", "pump")],
                              "equipment_id string, platform_id string, equipment_name string, equipment_type string"),
        spark.createDataFrame([("S1", "E1", 0.0, 100.0)],
                              "sensor_id string, equipment_id string, min_range double, max_range double"),
    )


DOCUMENTS = [
    [document(0), document(1, value=130.0), document(2, value="n/a")],
    ["[" + document(3) + "," + document(4, platform_id="") + "]", "{broken"],
    [document(5, value=160.0), document(6, sensor_type="h2s_concentration", value=125.0)],
]


def test_flow_stream_is_repeatable(spark, tmp_path, dims):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, documents in enumerate(DOCUMENTS):
        raw_file(source, i, documents)
    config = FlowConfig(failed_at=at(0).isoformat(" "))
    query = jobs.start_flow(
        spark, source, dims, out, str(tmp_path / "ck"), config, max_files=1, trigger={"availableNow": True}
    )
    query.awaitTermination()
    stored = spark.read.parquet(f"{out}/readings")
    assert sorted(r.reading_id for r in stored.collect()) == ["r0", "r1", "r3", "r5", "r6"]
    assert {r.sensor_type for r in stored.collect()} == {"temperature", "h2s_concentration"}
    assert {r.unit for r in stored.collect()} == {"celsius"}
    dead = spark.read.json(f"{out}/dlq")
    assert {(r.stage, r.error_reason): r["count"] for r in dead.groupBy("stage", "error_reason").count().collect()} == {
        ("parse", "non_numeric_value"): 1, ("parse", "invalid_json"): 1, ("validation", "quality_gate"): 1,
        ("range", "out_of_range"): 3,
    }
    alerts = spark.read.parquet(f"{out}/alerts")
    assert sorted((r.reading_id, r.anomaly_type, r.channel) for r in alerts.collect()) == [
        ("r1", "threshold_exceeded", "pagerduty"), ("r5", "temperature_anomaly", "slack"),
        ("r5", "threshold_exceeded", "pagerduty"), ("r6", "threshold_exceeded", "pagerduty"),
    ]
    events = spark.read.parquet(f"{out}/compliance")
    assert events.filter("report_type = 'emission_event'").count() >= 1
    # A micro-batch run again, as after a failure, replaces its own output.
    raw = readers.explode_batch(readers.read_readings(spark, f"{source}/part-0.json"))
    jobs.fan_out_batch(spark, dims, jobs.FlowPaths(out), config)(raw, 0)
    spark.catalog.refreshByPath(f"{out}/readings")
    assert spark.read.parquet(f"{out}/readings").count() == 5


def test_flow_batch(spark, tmp_path, dims):
    source = str(tmp_path / "in")
    for i, documents in enumerate(DOCUMENTS):
        raw_file(source, i, documents)
    raw = readers.explode_batch(readers.read_readings(spark, source))
    paths = run_batch(raw, dims, str(tmp_path / "out"), FlowConfig(failed_at=at(0).isoformat(" ")))
    assert spark.read.parquet(paths["readings"]).count() == 5
    archived = spark.read.json(f"{paths['archive']}/sensors")
    assert archived.filter("match_status = 'matched' AND equipment_metadata.region = 'North'").count() == 5
    assert archived.filter("validation_status = 'FAILED'").count() == 3
    assert spark.read.json(f"{paths['dlq']}/dlq").count() == 6
    alerts = spark.read.parquet(paths["alerts"])
    assert {r.anomaly_type for r in alerts.filter("reading_id = 'r5'").collect()} >= {"temperature_anomaly", "threshold_exceeded"}
    assert alerts.filter("channel IS NULL").count() == 0
    assert spark.read.parquet(paths["compliance"]).filter("report_type = 'emission_event'").count() >= 1
    topics = {r.topic: r["count"] for r in spark.read.parquet(paths["topics"]).groupBy("topic").count().collect()}
    assert topics["sensor.raw"] == 8 and topics["sensor.validated"] == topics["sensor.enriched"] == 5
    assert topics["sensor.dlq"] == 6 and topics["sensor.alert"] == alerts.count() and topics["sensor.compliance"] >= 1
    assert spark.read.parquet(paths["alerts"]).filter("reading_id = 'r5'").count() >= 1


def test_rolling_matches_plain_loop():
    import numpy as np

    rng = np.random.default_rng(1)
    values = rng.normal(100, 3, 57)
    for size in (1, 5, 20, 100):
        n, mean, std = detectors.rolling(values, 7, size)
        for j, i in enumerate(range(7, 57)):
            frame = values[max(0, i - size + 1) : i + 1]
            assert n[j] == len(frame)
            assert mean[j] == pytest.approx(frame.mean()) and std[j] == pytest.approx(frame.std())


def test_logged_rollup_refreshes_only_listed_days(spark, tmp_path):
    """Late readings of two far-apart days: only their folders are read and written again."""
    base, schema = str(tmp_path), READING_SCHEMA
    day = 86_400.0
    first = readings(spark, [(s, d * day + 600.0 * i, float(i)) for s in ("A", "B") for d in range(8) for i in range(20)])
    late = readings(spark, [("A", 1 * day + 30.0, 99.0), ("C", 6 * day + 45.0, 5.0), ("A", 1 * day + 90_00.0, 1.0)])

    def run(rows):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        jobs.start_logged_facts(stream, f"{base}/facts", f"{base}/log", f"{base}/cp", trigger={"availableNow": True}).awaitTermination()

    def files():
        return {d: sorted(os.listdir(f"{base}/agg/{d}")) for d in os.listdir(f"{base}/agg") if d.startswith("date=")}

    def stored():
        return spark.read.parquet(f"{base}/agg").drop("date")

    run(first)
    assert len(jobs.refresh_logged(spark, f"{base}/facts", f"{base}/log", f"{base}/agg")) == 8
    before = files()
    assert jobs.refresh_logged(spark, f"{base}/facts", f"{base}/log", f"{base}/agg") == [] and files() == before
    run(late)
    days = jobs.refresh_logged(spark, f"{base}/facts", f"{base}/log", f"{base}/agg")
    assert [str(d) for d in days] == ["2024-01-02", "2024-01-07"]
    changed = {d for d, f in files().items() if before[d] != f}
    assert changed == {"date=2024-01-02", "date=2024-01-07"}
    want = rollup(first.unionByName(late), "1 minute")
    assert stored().count() == want.count() and stored().select(want.columns).exceptAll(want).isEmpty()
    plan = spark.read.parquet(f"{base}/facts").filter(F.col("date").isin(days))
    assert len(plan.inputFiles()) > 0 and "PartitionFilters: [date" in plan._jdf.queryExecution().executedPlan().toString()
    # A refresh that stopped before it noted its batches is repeated with the same result.
    spark.read.parquet(f"{base}/log-done").limit(0).write.parquet(f"{base}/none")
    os.rename(f"{base}/log-done", f"{base}/was-done")
    assert len(jobs.refresh_logged(spark, f"{base}/facts", f"{base}/log", f"{base}/agg")) == 8
    assert stored().select(want.columns).exceptAll(want).isEmpty()


def test_stream_detectors_hand_only_alert_columns_to_python(spark, tmp_path, monkeypatch):
    """No time objects and nothing that no alert shows; the chain still gives every column back."""
    path = str(tmp_path / "in")
    rows = readings(spark, [("S", 60 * i, float(i % 7)) for i in range(20)]).withColumn("extra", F.lit("x" * 50))
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    handed, made = [], detectors.SeriesState
    monkeypatch.setattr(detectors, "SeriesState", lambda size, columns, tie: handed.append(columns) or made(size, columns, tie))
    detectors.stream_detect_all(stream, DetectorConfig(window_size=6))
    chain = detectors.stream_detector_chain(stream, DetectorConfig(window_size=6))
    assert set(handed[0]) == {"reading_id", "platform_id", "sensor_id", "sensor_type", "value", "unit", "at_us"}
    assert set(handed[1]) == {*rows.columns, "at_us"} - {"time"}
    assert {f.name: f.dataType for f in chain.schema.fields if f.name in rows.columns} == {f.name: f.dataType for f in rows.schema.fields}
    assert "at_us" not in chain.columns
