"""Compacted topics: runs, folds, tombstones, retention, interruption."""

from __future__ import annotations

import glob
import os
import random

import pytest

from fieldpulse.streaming import compacted
from fieldpulse.streaming.compacted import CompactedTopic, Run
from tests.conftest import at

SCHEMA = "key string, at timestamp, n int, value double"


def frame(spark, rows):
    return spark.createDataFrame([(k, at(s), n, v) for k, s, n, v in rows], SCHEMA)


def topic(spark, tmp_path, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return CompactedTopic(str(tmp_path / "topic"), schema, ("key",), "at", ("n",), **{"fan": 3, "buckets": 2, **options})


def held(df):
    return sorted((r.key or "", r.n) for r in df.collect())


def plain(rows, deleted=lambda r: False):
    newest = {}
    for row in rows:
        if row[0] not in newest or row[1:3] > newest[row[0]][1:3]:
            newest[row[0]] = row
    return sorted((k or "", r[2]) for k, r in newest.items() if not deleted(r))


def batches(n, size, seed=5):
    rng = random.Random(seed)
    number = iter(range(10_000))
    keys = ["a", "b", "c", None, *[f"k{i}" for i in range(20)]]
    return [
        [(rng.choice(keys), rng.randrange(60), next(number), None if rng.random() < 0.2 else 1.0) for _ in range(size)]
        for _ in range(n)
    ]


def test_equals_plain_loop_after_every_batch(spark, tmp_path):
    t = topic(spark, tmp_path, deleted="value IS NULL")
    rows = []
    for i, part in enumerate(batches(10, 25)):
        part = [*part, part[0]]  # a repeated row
        rows += part
        assert compacted.write_delta(t, frame(spark, part), i)
        compacted.fold(spark, t)
        if i in (0, 2, 7, 9):
            assert held(compacted.read_topic(spark, t)) == plain(rows, lambda r: r[3] is None)
    assert compacted.live_runs(spark, t) == [Run(0, 8), Run(9, 9)]
    one = compacted.read_topic(spark, t, key=["k1"])
    assert held(one) == [x for x in held(compacted.read_topic(spark, t)) if x[0] == "k1"]
    assert held(compacted.read_topic(spark, t, key=[None])) == [x for x in plain(rows, lambda r: r[3] is None) if not x[0]]


def test_replay_and_interruption(spark, tmp_path):
    t = topic(spark, tmp_path)
    parts = batches(3, 12)
    for i, part in enumerate(parts):
        compacted.write_delta(t, frame(spark, part), i)
    want = plain(sum(parts, []))
    assert held(compacted.read_topic(spark, t)) == want
    before = compacted.read_topic(spark, t)
    assert compacted.fold(spark, t) == [Run(0, 2)] and compacted.fold(spark, t) == []
    assert held(before) == want  # a reader of the hidden runs
    for i, part in enumerate(parts):
        assert not compacted.write_delta(t, frame(spark, part), i)
    # A fold that did not finish hides nothing and is repeated.
    os.remove(f"{t.path}/run=0-2/_SUCCESS")
    assert compacted.live_runs(spark, t) == [Run(0, 0), Run(1, 1), Run(2, 2)]
    assert held(compacted.read_topic(spark, t)) == want
    assert compacted.fold(spark, t) == [Run(0, 2)]
    assert compacted.drop_hidden(spark, t, 3600.0) == []
    assert len(compacted.drop_hidden(spark, t, -1.0)) == 3
    assert [os.path.basename(p) for p in glob.glob(f"{t.path}/run=*")] == ["run=0-2"]
    assert held(compacted.read_topic(spark, t)) == want


def test_tombstone_outlives_folds_and_late_rows(spark, tmp_path):
    t = topic(spark, tmp_path, deleted="value IS NULL")
    steps = [[("a", 1, 1, 1.0)], [("a", 9, 2, None)], [("b", 1, 3, 1.0)], [("a", 5, 4, 1.0)]]
    for i, rows in enumerate(steps):
        compacted.write_delta(t, frame(spark, rows), i)
        compacted.fold(spark, t)
    assert held(compacted.read_topic(spark, t)) == [("b", 3)]
    compacted.write_delta(t, frame(spark, [("a", 10, 5, 1.0)]), 4)
    assert held(compacted.read_topic(spark, t)) == [("a", 5), ("b", 3)]


def test_retention_drops_old_rows_and_tombstones(spark, tmp_path):
    t = topic(spark, tmp_path, deleted="value IS NULL", retention_days=1)
    day = 86_400
    steps = [[("a", 0, 1, 1.0), ("b", day, 2, 1.0)], [("a", 10, 3, None)], [("c", 2 * day, 4, 1.0)], [("a", 5, 5, 1.0)]]
    now = at(2 * day).isoformat(" ")
    for i, rows in enumerate(steps):
        compacted.write_delta(t, frame(spark, rows), i)
    assert held(compacted.read_topic(spark, t, now)) == [("b", 2), ("c", 4)]
    assert compacted.fold(spark, t, now) == [Run(0, 2)]
    assert spark.read.parquet(f"{t.path}/run=0-2").count() == 2  # the tombstone is gone as well
    assert held(compacted.read_topic(spark, t, now)) == [("b", 2), ("c", 4)]  # the late row is expired
    with pytest.raises(ValueError):
        compacted.read_topic(spark, t)


def test_rows_are_rewritten_once_per_level(spark, tmp_path):
    t = topic(spark, tmp_path)
    for i in range(9):
        compacted.write_delta(t, frame(spark, [(f"k{i}-{j}", j, j, 1.0) for j in range(10)]), i)
        compacted.fold(spark, t)
    written = sum(spark.read.parquet(p).count() for p in glob.glob(f"{t.path}/run=*"))
    # The last three go straight into the widest run.
    assert written == 90 + 60 + 90


def test_empty_topic_empty_batch_and_clashing_names(spark, tmp_path):
    t = topic(spark, tmp_path)
    assert held(compacted.read_topic(spark, t)) == [] == held(compacted.read_topic(spark, t, key=["a"]))
    compacted.write_delta(t, frame(spark, []), 0)
    assert held(compacted.read_topic(spark, t)) == [] and compacted.live_runs(spark, t) == [Run(0, 0)]
    with pytest.raises(ValueError):
        CompactedTopic("x", spark.createDataFrame([], "bucket int, at timestamp").schema, ("bucket",), "at")


def test_fed_by_a_stream(spark, tmp_path):
    t, rows = topic(spark, tmp_path), []
    for part in batches(4, 10):
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        rows += part
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # a restart finds nothing new
        compacted.start_compacted(stream, t, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
        assert held(compacted.read_topic(spark, t)) == plain(rows)
    assert compacted.live_runs(spark, t) == [Run(0, 2), Run(3, 3)]
