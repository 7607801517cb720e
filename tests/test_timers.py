"""Episodes, notifications and expiry by event-time timers."""

from __future__ import annotations

import random

import pytest
from conftest import EPOCH, at
from pyspark.sql import functions as F

from fieldpulse.plans import catalog
from fieldpulse.plans.views import load
from fieldpulse.session import scratch_dir
from fieldpulse.streaming import detectors, jobs, timers


def landed(spark, path, batches, schema):
    """One file, so one micro-batch, per list of rows."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(stream, tmp_path):
    """(written rows, state rows after each micro-batch)."""
    query = jobs.start_file_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp"), trigger={"availableNow": True})
    query.awaitTermination()
    rows = stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()
    return rows, [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]


def seconds(t):
    return (t - EPOCH).total_seconds()


def plain_episodes(samples, hold, stale, horizon):
    """Second by second rules over (series, second, held), in order."""
    out = []
    for key in {s for s, _, _ in samples}:
        instants = {}
        for s, t, h in samples:
            if s == key:
                instants[t] = instants.get(t, True) and bool(h)
        since = last = None
        runs = []
        for t, h in [*sorted(instants.items()), (float("inf"), False)]:
            if since is not None and (t - last > stale or not h):
                silent = t - last > stale
                runs.append((since, last + stale if silent else t, "silence" if silent else "sample"))
                since = None
            if h:
                since, last = t if since is None else since, t
        for begin, end, by in runs:
            if end - begin >= hold:
                out += [(key, "firing", begin, begin + hold, None)] if begin + hold < horizon else []
                out += [(key, "resolved", begin, end, by)] if end < horizon else []
    return sorted(out, key=str)


SAMPLES = "name string, ts timestamp, value double, extra string"


def test_episodes_equal_the_plain_rules(spark, tmp_path):
    rng = random.Random(5)
    rows, t = [], {}
    for _ in range(600):
        key = "hot" if rng.random() < 0.4 else rng.choice("abcdefghij")
        t[key] = t.get(key, 0) + rng.choice([0, 5, 10, 10, 10, 20, 70])
        rows.append((key, t[key], rng.choice([None, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0])))
    rows = sorted(rows, key=lambda r: r[1])
    # Out of order by up to 50 s, and across files.
    shuffled = sorted(rows, key=lambda r: r[1] + rng.random() * 50)
    batches = [[(k, at(s), v, "x") for k, s, v in shuffled[i : i + 120]] for i in range(0, 600, 120)]
    end = max(r[1] for r in rows) + 1000
    batches.append([("end", at(end), 0.0, None)])
    stream = landed(spark, str(tmp_path / "in"), batches, SAMPLES)
    found = timers.stream_episodes(stream, F.col("value") > 0, "30 seconds", "60 seconds", "60 seconds", ("name",))
    got, states = run(found, tmp_path)
    want = plain_episodes([(k, s, v) for k, s, v in rows], 30, 60, end - 60)
    assert sorted([(r.name, r.event, seconds(r.since), seconds(r["at"]), r.closed_by) for r in got], key=str) == want
    assert {r.closed_by for r in got} == {None, "sample", "silence"}
    assert states[-1] <= 5 < 15 < max(states)  # in the end, only the row that still waits and its timer


def test_fires_and_resolves_without_further_samples(spark, tmp_path):
    batches = [[("a", at(0), 1.0, None)], [("clock", at(500), 0.0, None)]]
    stream = landed(spark, str(tmp_path / "in"), batches, SAMPLES)
    got, _ = run(timers.stream_episodes(stream, F.col("value") > 0, "20 seconds", "50 seconds", "1 second", ("name",)), tmp_path)
    assert sorted((r.event, seconds(r["at"]), r.closed_by) for r in got) == [("firing", 20, None), ("resolved", 50, "silence")]


def plain_notices(rows, repeat, resolve, wait, horizon):
    out = []
    for key in {k for k, _ in rows}:
        sessions = []
        for s in sorted(s for k, s in rows if k == key):
            if sessions and s - sessions[-1][-1] <= resolve:
                sessions[-1].append(s)
            else:
                sessions.append([s])
        for times in sessions:
            for slot in {(s - times[0]) // repeat for s in times}:
                own = [s for s in times if (s - times[0]) // repeat == slot]
                out.append((key, "notified", times[0], slot, own[0] + wait, sum(s <= own[0] + wait for s in own)))
            out.append((key, "resolved", times[0], None, times[-1] + resolve, len(times)))
    return sorted([r for r in out if r[4] < horizon], key=str)


def test_notifications_equal_the_plain_rules(spark, tmp_path):
    rng = random.Random(8)
    rows, t = [], {}
    for _ in range(500):
        key = "hot" if rng.random() < 0.4 else rng.choice("abcdefgh")
        t[key] = t.get(key, 0) + rng.choice([0, 1, 3, 5, 8, 8, 45])
        rows.append((key, t[key]))
    shuffled = sorted(rows, key=lambda r: r[1] + rng.random() * 20)
    batches = [[(k, at(s)) for k, s in shuffled[i : i + 100]] for i in range(0, 500, 100)]
    end = max(s for _, s in rows) + 500
    batches.append([("end", at(end))])
    stream = landed(spark, str(tmp_path / "in"), batches, "name string, ts timestamp")
    found = timers.stream_notifications(stream, ("name",), "1 minute", "30 seconds", "10 seconds", "30 seconds", "ts")
    got, states = run(found, tmp_path)
    have = [(r.name, r.event, seconds(r.session_start), r.slot, seconds(r["at"]), r.alerts) for r in got]
    assert sorted(have, key=str) == plain_notices(rows, 60, 30, 10, end - 30)
    assert states[-1] <= 5 < 12 < max(states)
    with pytest.raises(ValueError):
        timers.stream_notifications(stream, ("name",), "1 minute", "5 seconds", "10 seconds", "30 seconds", "ts")


@pytest.mark.parametrize("mode", ["quiet_gap", "fixed"])
def test_expired_keys_change_no_result(spark, tmp_path, mode):
    schema = "alert_id string, sensor_id string, detected_at timestamp"
    rows = [(f"{i:03d}", f"s{i // 10}", at(i * 7 + (i % 3) * 400)) for i in range(100)]
    rows.sort(key=lambda r: r[2])
    batches = [rows[i : i + 20] for i in range(0, 100, 20)]
    batches.append([("end", "z", at(90_000))])
    stream = landed(spark, str(tmp_path / "in"), batches, schema)
    args = dict(keys=("sensor_id",), window="1 minute", mode=mode)
    kept, _ = run(detectors.stream_dedup_alerts(stream, **args), tmp_path / "all")
    got, states = run(detectors.stream_dedup_alerts(stream, **args, lateness="1 minute"), tmp_path / "expiring")
    assert sorted(got) == sorted(kept) and len(got) < 101
    assert states[-1] <= 5 < 9 < max(states)


def test_waiting_entries_are_few_values_and_come_back():
    entries = [(10**15 + k, k % 3 + 1, k % 2 == 0) for k in range(120_001)]
    values = timers.packed(entries)
    assert len(values) == 3 and timers.unpacked(iter(values)) == entries
    assert timers.packed([]) == [] and timers.unpacked(iter([])) == []


def test_micro_batches_do_not_grow_in_number_with_the_landed_files(spark):
    """Five weeks written by 1 or by 12 tasks each make the same two micro-batches."""
    views = load(spark, "unused")
    start = F.unix_seconds(F.lit(EPOCH)) + F.col("id") * 3600
    rows = spark.range(0, 24 * 33).select(F.timestamp_seconds(start).alias("time"), F.col("id").cast("string").alias("reading_id"))
    batches = []
    for tasks in (1, 12):
        stream = catalog._arriving(views, rows.repartition(tasks, "reading_id"), "time", "reading_id", "t-arriving")
        base = scratch_dir(spark, "t-arrived")
        job = jobs.start_file_sink(stream, f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True})
        job.awaitTermination()
        batches.append(sum(p["numInputRows"] > 0 for p in job.recentProgress))
        assert spark.read.parquet(f"{base}/out").count() == rows.count()
    assert batches == [2, 2]
