from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import at
from fieldpulse.operators.metrics import (
    METRIC_RULES,
    component_status,
    counter_rate,
    evaluate_rules,
    group_notifications,
    instant_values,
    sum_matching,
    sustained,
)
from fieldpulse.operators.sequence import sessions

SCHEMA = "ts timestamp, job string, instance string, metric string, component string, value double"


def samples(spark, rows):
    """Samples from (metric, component, seconds, value)."""
    return spark.createDataFrame(
        [(at(t), "flow", "n1", m, c, float(v)) for m, c, t, v in rows], SCHEMA
    )


@pytest.mark.parametrize("slice_width", ["10 minutes", "1 hour", "1 day"])
def test_counter_rate_equals_walk(spark, slice_width):
    rng = random.Random(5)
    rows = []
    for component in ("a", "b"):
        total, t = 0, 0
        for _ in range(400):
            t += rng.choice([15, 30, 200, 700])
            total = rng.randint(0, 5) if rng.random() < 0.05 else total + rng.randint(0, 90)
            rows.append(("out", component, t, total))
    series = defaultdict(list)
    for _, c, t, v in rows:
        series[c].append((t, v))
    got = counter_rate(samples(spark, rows), slice_width=slice_width).collect()
    assert len(got) == len(rows)
    for r in got:
        now = (r.ts - at(0)).total_seconds()
        inside = [(t, v) for t, v in series[r.component] if now - 300 <= t <= now]
        if len(inside) < 2:
            assert r.rate is None
            continue
        gained = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
        assert r.rate == pytest.approx(gained / (inside[-1][0] - inside[0][0]))


def test_span_wider_than_slice(spark):
    with pytest.raises(ValueError):
        counter_rate(samples(spark, [("m", "a", 0, 1)]), "2 hours", slice_width="1 hour")


@pytest.mark.parametrize("slice_width", ["1 minute", "10 minutes", "1 day"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sustained_equals_walk(spark, slice_width, seed):
    rng = random.Random(seed)
    rows, expected = [], set()
    for component in ("a", "b"):
        t, run = 0, []
        flip = 0.5 if component == "b" else 0.1
        on = False
        for _ in range(300):
            t += rng.choice([5, 30, 130])
            on = on ^ (rng.random() < flip)
            rows.append(("queue", component, t, 10 if on else 1))
            if on:
                run.append(t)
            if not on or _ == 299:
                if run and run[-1] - run[0] >= 120:
                    expected.add((component, run[0], run[-1], len(run)))
                run = []
    rng.shuffle(rows)
    got = sustained(samples(spark, rows), F.col("value") > 5, "2 minutes", slice_width=slice_width)
    found = {
        (r.component, (r.pending_since - at(0)).total_seconds(),
         (r.last_true_at - at(0)).total_seconds(), r.samples)
        for r in got.collect()
    }
    assert found == expected and expected


def test_sum_matching(spark):
    df = samples(spark, [("lag", "flow-1", 0, 3), ("lag", "flow-2", 0, 4), ("lag", "xflow", 0, 9)])
    row = sum_matching(df, "component", "flow.*").first()
    assert (row.value, row.series) == (7.0, 2)


def test_rules(spark):
    quiet = [("up", "x", t, 1) for t in range(0, 600, 30)]
    down = [("up", "y", t, 0) for t in range(0, 130, 30)]
    queue = [("items_queued", "z", t, 60000) for t in range(0, 400, 30)]
    lag = [("consumer_lag", c, t, 6000) for c in "pq" for t in range(0, 400, 30)]
    found = evaluate_rules(samples(spark, quiet + down + queue + lag)).collect()
    assert {(r.alertname, r.component) for r in found} == {
        ("FlowEngineDown", "y"), ("TargetDown", "y"), ("QueueBackpressure", "z"), ("ConsumerLag", "")
    }
    assert len(METRIC_RULES) == 7


def test_notifications(spark):
    times = [0, 60, 3599, 3600, 3601] + [4000 + 299 * i for i in range(12)] + [20000]
    df = spark.createDataFrame(
        [("Down", "critical", at(t)) for t in times], "alertname string, severity string, fired_at timestamp"
    )
    got = group_notifications(df).orderBy("notified_at").collect()
    result = [(r.session, r.slot, r.alerts, (r.notified_at - at(0)).total_seconds()) for r in got]
    # 60 -> 3599 is a pause of more than five minutes, so is 3601 -> 4000.
    assert result == [(1, 0, 2, 10.0), (2, 0, 3, 3609.0), (3, 0, 12, 4010.0), (4, 0, 1, 20010.0)]
    steady = spark.createDataFrame(
        [("Down", "critical", at(t)) for t in range(0, 7300, 100)],
        "alertname string, severity string, fired_at timestamp",
    )
    slots = group_notifications(steady).orderBy("slot").collect()
    assert [(r.session, r.slot, r.alerts) for r in slots] == [(1, 0, 36), (1, 1, 36), (1, 2, 1)]


def test_sessions_gap_edge(spark):
    df = spark.createDataFrame([("k", at(t)) for t in (0, 300, 600.001, 900)], "k string, t timestamp")
    got = sessions(df, ["k"], "t", "5 minutes").orderBy("session").collect()
    assert [r["rows"] for r in got] == [2, 2]


def test_component_status(spark):
    rows = [("items_input", "a", 0, 1), ("items_input", "a", 30, 2), ("items_output", "a", 0, 0),
            ("items_output", "a", 30, 60), ("items_queued", "b", 30, 7)]
    got = {r.component: r for r in component_status(samples(spark, rows)).collect()}
    assert (got["a"].items_in, got["a"].items_out_rate, got["a"].queue_size) == (2.0, 2.0, None)
    assert (got["b"].items_in, got["b"].items_out_rate, got["b"].queue_size) == (None, None, 7.0)
    assert instant_values(samples(spark, rows), "items_input", "other").count() == 0


def test_component_on_several_nodes_is_one_row(spark):
    rows = [(m, "a", t, v) for m, t, v in
            [("items_input", 30, 2), ("items_output", 0, 0), ("items_output", 30, 60), ("items_queued", 30, 7)]]
    nodes = samples(spark, rows).withColumn("instance", F.explode(F.array(F.lit("n1"), F.lit("n2"), F.lit("n3"))))
    got = component_status(nodes).collect()
    assert [(r.component, r.items_in, r.items_out_rate, r.queue_size) for r in got] == [("a", 6.0, 6.0, 21.0)]
