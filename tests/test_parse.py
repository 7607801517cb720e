from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fieldpulse.functions.times import epoch_to_iso, normalize_ts, rewrite_epoch_in_text, seconds_of
from fieldpulse.operators.parse import parse_reading, with_parsed
from fieldpulse.operators.validate import quality_gate, stamp, validate_range, validate_schema
from fieldpulse.sources import contracts
from fieldpulse.sources.readers import explode_batch, extract_fields, filter_topic, topic_regex

GOOD = {
    "reading_id": "r1",
    "platform_id": "ALPHA",
    "sensor_id": "ALPHA-COMP-S01",
    "sensor_type": "TEMPERATURE",
    "value": 85.3,
    "unit": "degC",
    "timestamp": 1700000000000,
    "quality_flag": "GOOD",
}


def bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string")


def changed(**fields):
    doc = {**GOOD, **fields}
    return json.dumps({k: v for k, v in doc.items() if v is not ...})


@pytest.mark.parametrize(
    "body, reason, value",
    [
        (changed(), None, 85.3),
        (changed(value="12.5"), None, 12.5),
        (changed(value=" 1e3 "), None, 1000.0),
        (changed(value="1_000"), None, 1000.0),
        (changed(value=True), None, 1.0),
        (changed(value=False), None, 0.0),
        (changed(value="true"), "non_numeric_value", None),
        (changed(value="n/a"), "non_numeric_value", None),
        (changed(value="1.0d"), "non_numeric_value", None),
        (changed(value=""), "non_numeric_value", None),
        (changed(value=[1]), "non_numeric_value", None),
        (changed(value={"x": 1}), "non_numeric_value", None),
        (changed(value=None), "missing_value", None),
        (changed(value=...), "missing_value", None),
        (changed(sensor_id=""), "missing_sensor_id", None),
        (changed(sensor_id=None), "missing_sensor_id", None),
        (changed(sensor_id=0), "missing_sensor_id", None),
        (changed(sensor_id=False), "missing_sensor_id", None),
        (changed(sensor_id="0"), None, 85.3),
        (changed(sensor_id="", value="n/a"), "missing_sensor_id", None),
        (changed(timestamp="soon"), "bad_timestamp", None),
        (changed(timestamp=...), "bad_timestamp", None),
        (changed()[:40], "invalid_json", None),
        (changed() + " x", "invalid_json", None),
        ("[1, 2]", "invalid_json", None),
        ("42", "invalid_json", None),
        ("", "invalid_json", None),
    ],
)
def test_parse_branches(spark, body, reason, value):
    row = with_parsed(bodies(spark, body)).first()
    assert row.error_reason == reason
    if reason is None:
        assert row.value == value and row.severity is None
    else:
        assert row.severity == "UNKNOWN" and row.error_text


def test_parse_not_a_number_value(spark):
    row = with_parsed(bodies(spark, changed(value="x").replace('"x"', "NaN"))).first()
    assert row.error_reason is None and row.value != row.value


def test_parse_without_sensor_or_time(spark):
    body = bodies(spark, changed(sensor_id=..., timestamp=...))
    assert with_parsed(body, require_sensor=False, require_time=False).first().error_reason is None


def test_parse_split(spark):
    good, bad = parse_reading(bodies(spark, changed(), changed(value="n/a"), "{"))
    assert good.count() == 1 and "error_reason" not in good.columns
    assert {r.error_text for r in bad.collect()} == {"not a number: n/a", "not a JSON object"}


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("1700000000", dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("1700000000.9", dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("1700000000123", dt.datetime(2023, 11, 14, 22, 13, 20, 123000)),
        ("2023-11-14T22:13:20Z", dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("2023-11-14T23:13:20.5+01:00", dt.datetime(2023, 11, 14, 22, 13, 20, 500000)),
        ("yesterday", None),
        ("NaN", None),
        ("", None),
        (None, None),
    ],
)
def test_normalize_ts(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string").select(normalize_ts(F.col("t")).alias("t"))
    assert df.first().t == expected


def test_far_future_seconds(spark):
    df = spark.createDataFrame([("4102444800",)], "t string")
    assert df.select(normalize_ts(F.col("t")).alias("t")).first().t == dt.datetime(2100, 1, 1)


def test_epoch_to_iso(spark):
    df = spark.createDataFrame([(1700000000123, 1.0)], "timestamp bigint, value double")
    row = epoch_to_iso(df).first()
    assert row.time == "2023-11-14T22:13:20.123Z" and "timestamp" not in row.asDict()
    text = bodies(spark, '{"timestamp" : 1700000000123, "v": 1}', '{"v": 1}')
    got = [r.b for r in text.select(rewrite_epoch_in_text(F.col("body")).alias("b")).collect()]
    assert got == ['{"time":"2023-11-14T22:13:20.123Z", "v": 1}', '{"v": 1}']


def test_widths():
    assert [seconds_of(w) for w in ("1 minute", "15 minutes", "2 hours", "1 day")] == [
        60,
        900,
        7200,
        86400,
    ]
    with pytest.raises(ValueError):
        seconds_of("soon")


def test_explode_batch(spark):
    df = bodies(spark, f"[{changed()}, {changed(reading_id='r2')}]", changed(), "[]", "[{", "{")
    got = explode_batch(df).groupBy("i").count().collect()
    assert {r.i: r["count"] for r in got} == {0: 2, 1: 1, 3: 1, 4: 1}


@pytest.mark.parametrize(
    "pattern, topic, hit",
    [
        ("sensors/+/+/data", "sensors/ALPHA/S1/data", True),
        ("sensors/+/+/data", "sensors/ALPHA/data", False),
        ("sensors/+/+/data", "sensors/A/B/C/data", False),
        ("sensors/+/+/data", "x/sensors/A/B/data", False),
        ("sensors/#", "sensors/a/b", True),
        ("sensors/#", "sensors", True),
        ("sensors/#", "sensorsx/a", False),
        ("#", "anything/at/all", True),
        ("a.b/+", "aXb/c", False),
    ],
)
def test_topics(spark, pattern, topic, hit):
    df = spark.createDataFrame([(topic,)], "topic string")
    assert (filter_topic(df, pattern).count() == 1) is hit


def test_topic_levels_and_errors(spark):
    df = spark.createDataFrame([("sensors/ALPHA/S1/data",)], "topic string")
    row = filter_topic(df).first()
    assert (row.topic_platform, row.topic_sensor) == ("ALPHA", "S1")
    with pytest.raises(ValueError):
        topic_regex("a/#/b")


def test_extract_fields(spark):
    df = bodies(spark, '{"a": 1, "n": {"x": "y"}}', '{"b": 2}', "{oops")
    rows = extract_fields(df, {"a": "$.a", "deep": "$.n.x"}).orderBy("i").collect()
    assert [(r.a, r.deep, r.body_ok) for r in rows] == [("1", "y", True), ("", "", True), ("", "", False)]


def test_conform_reading(spark):
    rows = [
        ("r1", "ALPHA", "s", "TEMPERATURE", "1.5", "degC", 1700000000000, "SUSPECT"),
        ("r2", "ZULU", "s", "humidity", "x", "bar", None, "ODD"),
        ("r3", "ECHO", "s", "pressure", "2", "bar", 1700000000000, None),
    ]
    df = spark.createDataFrame(
        rows,
        "reading_id string, platform_id string, sensor_id string, sensor_type string, "
        "value string, unit string, timestamp bigint, quality_flag string",
    )
    got = contracts.conform(contracts.normalize_vocabulary(df), contracts.READING).collect()
    assert got[0].violations == [] and got[0].unit == "celsius"
    assert got[0].quality_flag == "UNCERTAIN"
    assert got[0].timestamp == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert set(got[1].violations) == {
        "enum:platform_id",
        "enum:sensor_type",
        "type:value",
        "missing:timestamp",
        "enum:quality_flag",
    }
    assert got[2].violations == [] and got[2].quality_flag == "GOOD"


@pytest.mark.parametrize("name", sorted(contracts.CONTRACTS))
def test_contract_round_trip(spark, name, tmp_path):
    contract = contracts.CONTRACTS[name]
    sample = {"StringType()": "x", "DoubleType()": 1.5, "IntegerType()": 3, "BooleanType()": True}
    row = []
    for f in contract.fields:
        if f.enum:
            row.append(f.enum[-1])
        else:
            row.append(sample.get(repr(f.type), dt.datetime(2024, 1, 1)))
    df = spark.createDataFrame([tuple(row)], contract.schema)
    df.write.parquet(str(tmp_path / name))
    back = contracts.conform(spark.read.parquet(str(tmp_path / name)), contract)
    assert back.first().violations == []
    assert tuple(back.drop("violations").first()) == tuple(row)


def test_validate_schema_and_gate(spark):
    df = spark.createDataFrame(
        [("s", "P", 1.0), ("", "P", 1.0), ("s", "  ", 1.0), ("s", "P", None)],
        "sensor_id string, platform_id string, value double",
    )
    passed, failed = quality_gate(df)
    assert passed.count() == 1
    assert sorted(r.error_text for r in failed.collect()) == [
        "Empty: platform_id",
        "Empty: sensor_id",
        "Empty: value",
    ]
    valid, invalid = validate_schema(df)
    assert valid.count() == 0 and invalid.count() == 4


def test_validate_range(spark):
    from conftest import readings

    rows = [("A", 0, 50.0), ("A", 1, 150.0), ("A", 2, float("nan")), ("A", 3, None), ("B", 4, 1.0)]
    sensors = spark.createDataFrame(
        [("A", 0.0, 100.0)], "sensor_id string, min_range double, max_range double"
    )
    got = validate_range(readings(spark, rows), sensors).orderBy("reading_id").collect()
    assert [r.validation_status for r in got] == ["PASSED", "FAILED", "WARNING", "FAILED", "WARNING"]
    assert all(r.schema_version == 1 and r.validated_at == r.time for r in got)


def test_stamp(spark):
    row = stamp(spark.range(1), "raw", "2024-01-01 00:00:00", source="mqtt").first()
    assert (row.stage, row.source, row.raw_at) == ("raw", "mqtt", dt.datetime(2024, 1, 1))


@pytest.mark.parametrize(
    "raw",
    ["9223372036854775807", "-9223372036854775808", "-9000000000000000000", "99999999999999999", "1e17", "1e300",
     "1e15", "Infinity", "-Infinity", "NaN", "n/a", "", "123456789012345678901234567890"],
)
def test_times_beyond_the_calendar_are_rejected(spark, raw):
    df = spark.createDataFrame([(raw,)], "timestamp string")
    assert df.select(normalize_ts(F.col("timestamp")).alias("t")).first().t is None
    assert epoch_to_iso(df).first()["time"] is None
    quoted = raw if raw.lstrip("-").isdigit() else f'"{raw}"'
    body = f'{{"sensor_id":"s","value":1,"timestamp":{quoted}}}'
    docs = spark.createDataFrame([(body,)], "body string")
    assert docs.select(rewrite_epoch_in_text(F.col("body")).alias("b")).first().b == body
    good, bad = parse_reading(docs)
    assert good.count() == 0 and bad.first().error_reason == "bad_timestamp"
