from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import at, readings
from fieldpulse.functions.labels import band, label_map
from fieldpulse.operators.sequence import extreme_rows
from fieldpulse.operators.rollup import (
    apply_retention,
    compact_latest,
    drop_expired_partitions,
    ingest_stats,
    latest,
    readings_per_sec,
    refresh_range,
    refresh_rollup,
    refresh_rollup_table,
    rollup,
    rollup_of_rollup,
    write_rollup,
)
from fieldpulse.sources.reference import REFRESH_POLICIES, RETENTION_DAYS
from fieldpulse.sources.sinks import write_readings


def sample(spark, n=400, seed=1):
    rng = random.Random(seed)
    return readings(
        spark, [(rng.choice("ABC"), rng.uniform(0, 7200), 1000 + rng.gauss(0, 1)) for _ in range(n)]
    )


def keyed(df, digits=6):
    return {
        (r.bucket, r.sensor_id): tuple(
            round(x, digits) if isinstance(x, float) else x
            for x in (r.avg_value, r.min_value, r.max_value, r.reading_count, r.stddev_value)
        )
        for r in df.collect()
    }


def test_rollup_values(spark):
    rows = [("A", 0, 1.0), ("A", 59.999, 3.0), ("A", 60, 10.0), ("B", 0, 5.0)]
    got = keyed(rollup(readings(spark, rows), "1 minute"))
    assert got == {
        (at(0), "A"): (2.0, 1.0, 3.0, 2, 1.414214),
        (at(60), "A"): (10.0, 10.0, 10.0, 1, None),
        (at(0), "B"): (5.0, 5.0, 5.0, 1, None),
    }


def test_coarser_from_finer(spark):
    df = sample(spark)
    direct = keyed(rollup(df, "15 minutes"))
    merged = keyed(rollup_of_rollup(rollup(df, "1 minute"), "15 minutes"))
    assert direct == merged


def test_refresh_range_is_whole_buckets():
    low, high = refresh_range("2024-01-01 12:07:30", "5 minutes", "1 hour", "5 minutes")
    assert (low, high) == (dt.datetime(2024, 1, 1, 11, 10), dt.datetime(2024, 1, 1, 12, 0))


def test_refresh_replaces_only_its_range(spark):
    df = sample(spark)
    marked = rollup(df.filter(F.col("value") > 1000), "1 minute").withColumn("max_value", F.lit(-1.0))
    got = refresh_rollup(df, marked, "1 minute", "1 hour", "10 minutes", at(7200)).collect()
    low, high = at(3600), at(6600)
    inside = keyed(rollup(df.filter((F.col("time") >= low) & (F.col("time") < high)), "1 minute"))
    fresh = [r for r in got if low <= r.bucket < high]
    assert len(fresh) == len(inside) and all(r.max_value > 0 for r in fresh)
    assert all(r.max_value == -1.0 for r in got if not low <= r.bucket < high)


def test_stored_refresh_twice_is_same(spark, tmp_path):
    df = sample(spark)
    facts, path = str(tmp_path / "facts"), str(tmp_path / "agg")
    write_readings(df, facts)
    write_rollup(rollup(df.filter(F.col("time") < at(3600)), "1 minute"), path)
    stored = spark.read.parquet(facts)
    results = []
    for _ in range(2):
        refresh_rollup_table(spark, stored, path, "rollup_1m", "2024-01-01 02:01:00")
        spark.catalog.refreshByPath(path)
        results.append(keyed(spark.read.parquet(path)))
    assert results[0] == results[1] == keyed(rollup(df, "1 minute"))


def test_policies():
    assert REFRESH_POLICIES["rollup_5m"] == ("5 minutes", "6 hours", "5 minutes", "5 minutes")
    assert RETENTION_DAYS == {"readings": 90, "rollup_1m": 180, "rollup_5m": 365, "rollup_15m": None}


def test_retention(spark):
    rows = [("A", 0, 1.0), ("A", 86400, 2.0), ("A", 2 * 86400, 3.0)]
    df = readings(spark, rows)
    assert apply_retention(df, "time", 1, at(2 * 86400)).count() == 2
    assert apply_retention(df, "time", None, at(2 * 86400)).count() == 3


def test_partitions_dropped(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS kept_readings")
    rows = [("A", d * 86400 + 5, float(d)) for d in range(5)]
    readings(spark, rows).withColumn("date", F.to_date("time")).write.partitionBy("date").option(
        "path", str(tmp_path / "t")
    ).saveAsTable("kept_readings")
    gone = drop_expired_partitions(spark, "kept_readings", 2, at(4 * 86400 + 10))
    assert gone == ["2024-01-01", "2024-01-02"]
    assert spark.table("kept_readings").count() == 3
    assert drop_expired_partitions(spark, "kept_readings", 2, at(4 * 86400 + 10)) == []
    spark.sql("DROP TABLE kept_readings")


def test_rates(spark):
    df = readings(spark, [("A", i, 1.0) for i in range(0, 50, 10)])
    assert readings_per_sec(df, at(60)).first().readings_per_sec == pytest.approx(5 / 40)
    assert readings_per_sec(df, at(40), "1 second").first().readings_per_sec == 1.0
    assert readings_per_sec(df, at(900)).first().readings_per_sec == 0.0


def test_ingest_stats(spark):
    df = readings(spark, [("A", i, 1.0) for i in range(0, 60, 10)]).withColumn(
        "quality_flag", F.when(F.second("time") == 10, "BAD").otherwise("GOOD")
    )
    got = ingest_stats(df).orderBy("bucket").collect()
    assert [(r.readings, r.anomalies, r.readings_per_sec) for r in got] == [(3, 1, 0.1), (3, 0, 0.1)]


def test_latest(spark):
    df = readings(spark, [("A", 0, 1.0), ("A", 5, 2.0), ("A", 5, 3.0), ("B", 1, 9.0)])
    got = {r.sensor_id: r.value for r in latest(df, ["sensor_id"], tie=("reading_id",)).collect()}
    assert got == {"A": 3.0, "B": 9.0}
    assert latest(df, ["sensor_id"], at(8), "5 seconds").count() == 1
    assert compact_latest(df, ["sensor_id"], "time", ("reading_id",)).count() == 2


@pytest.mark.parametrize(
    "value, name", [(0, "green"), (2.9, "green"), (3, "yellow"), (10, "orange"), (20, "red"), (None, None)]
)
def test_band(spark, value, name):
    df = spark.createDataFrame([(value,)], "v double") if value is None else spark.createDataFrame([(float(value),)], "v double")
    assert df.select(band(F.col("v"), "platform_alerts").alias("b")).first().b == name


def test_label_map(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "r boolean")
    got = [r.x for r in df.select(label_map(F.col("r"), {"true": "YES"}).alias("x")).collect()]
    assert got == ["YES", "false", None]


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e6, 1e8])
def test_merged_deviation_keeps_its_digits(spark, offset):
    rows = [("s", 60 * i, offset + 0.01 * (i % 5) + 0.02 * (i % 3)) for i in range(300)]
    df = readings(spark, rows)
    direct = rollup(df, "1 day").first()
    merged = rollup_of_rollup(rollup(df, "15 minutes"), "1 day").first()
    assert direct.stddev_value > 0.01
    assert merged.stddev_value == pytest.approx(direct.stddev_value, rel=1e-5)
    assert merged.avg_value == pytest.approx(direct.avg_value, rel=1e-12)


def test_newest_rows_are_found_without_sorting_all_rows(spark):
    rows = [("a", 1, "x", 1.0), ("a", 3, "x", 2.0), ("a", 3, "y", 3.0), ("a", 3, "y", 3.0), (None, 2, "n", 4.0), (None, None, "z", 5.0)]
    rows += [("b", None, "p", 6.0), ("b", None, "q", 7.0)] + [("hot", 9, "same", 8.0)] * 500
    df = spark.createDataFrame(rows, "k string, t long, tie string, v double")
    got = sorted(map(tuple, extreme_rows(df, ["k"], ["t", "tie"]).collect()), key=repr)
    assert got == sorted([("a", 3, "y", 3.0), (None, 2, "n", 4.0), ("b", None, "q", 7.0), ("hot", 9, "same", 8.0)], key=repr)
    first = sorted(map(tuple, extreme_rows(df, ["k"], ["t", "tie"], newest=False).collect()), key=repr)
    assert first == sorted([("a", 1, "x", 1.0), (None, None, "z", 5.0), ("b", None, "p", 6.0), ("hot", 9, "same", 8.0)], key=repr)
    by_text = sorted(map(tuple, extreme_rows(df, ["k"], ["tie"]).collect()), key=repr)
    assert [r[2] for r in by_text] == ["y", "q", "same", "z"]
    for found in (latest(df, ["k"], ts="t", tie=("tie",)), compact_latest(df, ["k"], "t", ("tie",))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "WindowGroupLimit" in plan
    assert extreme_rows(df.limit(0), ["k"], ["t"]).count() == 0
