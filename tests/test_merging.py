"""Batches by count or by time."""

from __future__ import annotations

import pytest

from fieldpulse.streaming import jobs, merging


def landed(spark, path, sizes):
    """One file of records per size; bin "b" gets one record in ten, null texts occur."""
    number = 0
    for size in sizes:
        rows = []
        for _ in range(size):
            rows.append(("b" if number % 10 == 0 else "a", None if number % 7 == 0 else f"k{number % 5}", str(number)))
            number += 1
        spark.createDataFrame(rows, "topic string, key string, value string").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("topic string, key string, value string")
    return stream.option("maxFilesPerTrigger", 1).parquet(path), number


def test_count_or_time(spark, tmp_path):
    stream, n = landed(spark, str(tmp_path / "in"), [30, 5, 400, 60])
    merged = merging.merge_records(stream, min_records=20, max_records=50, max_wait="2 seconds", lanes=2)
    out = str(tmp_path / "out")
    query = jobs.start_file_sink(merged, out, str(tmp_path / "cp"), trigger={"processingTime": "1 second"})
    batches = merging.await_records(spark, query, out, merged.schema, n, 100).collect()
    assert sorted(int(v) for b in batches for v in b["values"]) == list(range(n))
    assert all(len(b["values"]) == len(b["keys"]) == b.records <= 50 for b in batches)
    assert all(b.records >= 20 for b in batches if b.closed_by == "count")
    assert {b.closed_by for b in batches} == {"count", "time"}
    for key in {(b.topic, b.lane) for b in batches}:
        numbers = sorted(b.batch for b in batches if (b.topic, b.lane) == key)
        assert numbers == list(range(len(numbers)))
    assert all(int(v) % 10 == 0 for b in batches if b.topic == "b" for v in b["values"])
    assert all((k is None) == (int(v) % 7 == 0) for b in batches for k, v in zip(b["keys"], b["values"]))


def test_bounds_are_checked(spark, tmp_path):
    stream, _ = landed(spark, str(tmp_path / "in"), [1])
    with pytest.raises(ValueError):
        merging.merge_records(stream, min_records=5, max_records=4)
