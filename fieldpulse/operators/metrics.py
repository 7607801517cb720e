"""Operators over metric samples (ts, job, instance, metric, component, value)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fieldpulse.functions.times import seconds_between, seconds_of
from fieldpulse.operators.joins import join_by_field
from fieldpulse.operators.rollup import latest
from fieldpulse.operators.routing import union_dlq
from fieldpulse.operators.sequence import bucket_sessions, time_slice, with_preceding_span

SERIES = ("job", "instance", "metric", "component")


def counter_rate(
    samples: DataFrame,
    span: str = "5 minutes",
    series: Sequence[str] = SERIES,
    slice_width: str = "1 hour",
) -> DataFrame:
    """Per-second increase of each counter over the span before every sample.

    A drop is a reset: the counter restarted from zero, so the new value is the increase. The
    rate is over the time between first and last sample in the span, without extrapolation,
    and null where the span holds one sample only.
    """
    back = seconds_of(span) * 1_000_000

    def add(frame: DataFrame, window: WindowSpec) -> DataFrame:
        before = F.lag("value").over(window)
        step = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
        inside = window.rangeBetween(-back, 0)
        stepped = frame.withColumn("_step", F.coalesce(step, F.lit(0.0)))
        first_step = F.first("_step").over(inside)
        seconds = (F.col("_us") - F.min("_us").over(inside)) / F.lit(1e6)
        gained = F.sum("_step").over(inside) - first_step
        return stepped.withColumn("rate", F.try_divide(gained, seconds)).drop("_step")

    return with_preceding_span(samples, series, "ts", span, add, slice_width)


def instant_values(samples: DataFrame, metric: str, job: str | None = None) -> DataFrame:
    """Newest sample of every series of a metric."""
    picked = samples.filter(F.col("metric") == metric)
    if job is not None:
        picked = picked.filter(F.col("job") == job)
    return latest(picked, SERIES, ts="ts")


def sum_matching(
    samples: DataFrame, label: str, regex: str, by: Sequence[str] = ("ts",)
) -> DataFrame:
    """Sum over all series whose label matches the whole regular expression."""
    return (
        samples.filter(F.col(label).rlike(f"^(?:{regex})$"))
        .groupBy(*by)
        .agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("series"))
    )


def sustained(
    samples: DataFrame,
    condition: Column,
    duration: str,
    series: Sequence[str] = SERIES,
    ts: str = "ts",
    slice_width: str = "1 hour",
) -> DataFrame:
    """Episodes in which a condition held at every sample of a series for at least ``duration``.

    Runs of equal state are found per (series, slice). Only the first and last run of a slice
    can go on in a neighbouring slice; those few are merged in a second step per series.
    """
    own = Window.partitionBy(*series, "_slice").orderBy(ts)
    state = F.coalesce(condition, F.lit(False))
    changed = F.coalesce(F.lag("_true").over(own) != F.col("_true"), F.lit(False))
    runs = (
        samples.select(*series, F.col(ts).alias("_ts"), state.alias("_true"))
        .withColumnRenamed("_ts", ts)
        .withColumn("_slice", time_slice(F.col(ts), slice_width))
        .withColumn("_changed", changed.cast("int"))
        .withColumn("_run", F.sum("_changed").over(own))
        .groupBy(*series, "_slice", "_run", "_true")
        .agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"), F.count(F.lit(1)).alias("_n"))
    )
    in_slice = Window.partitionBy(*series, "_slice")
    placed = runs.withColumn(
        "_border", (F.col("_run") == 0) | (F.col("_run") == F.max("_run").over(in_slice))
    )
    inner = placed.filter(~F.col("_border") & F.col("_true")).select(*series, "_from", "_to", "_n")
    along = Window.partitionBy(*series).orderBy("_from")
    merged = (
        placed.filter("_border")
        .withColumn(
            "_starts",
            F.coalesce(
                (F.lag("_true").over(along) != F.col("_true"))
                | (F.lag("_slice").over(along) == F.col("_slice")),
                F.lit(True),
            ).cast("int"),
        )
        .withColumn("_episode", F.sum("_starts").over(along))
        .groupBy(*series, "_episode", "_true")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_n").alias("_n"))
        .filter("_true")
        .select(*series, "_from", "_to", "_n")
    )
    held = seconds_between(F.col("_from"), F.col("_to"))
    return (
        inner.unionByName(merged)
        .filter(held >= seconds_of(duration))
        .select(
            *series,
            F.col("_from").alias("pending_since"),
            F.timestamp_micros(
                F.unix_micros("_from") + F.lit(seconds_of(duration) * 1_000_000)
            ).alias("fires_at"),
            F.col("_to").alias("last_true_at"),
            F.col("_n").alias("samples"),
        )
    )


@dataclass(frozen=True)
class MetricRule:
    """Condition on a metric that must hold for a while before it alerts.

    ``kind`` is ``value``, ``rate`` (of a counter over five minutes) or ``sum`` (over all
    series); ``test`` compares the resulting ``value`` with ``limit``.
    """

    name: str
    metric: str
    test: str
    limit: float
    hold: str
    severity: str
    kind: str = "value"
    job: str | None = None
    labels: dict[str, str] = field(default_factory=dict)


# The metric alert rules (limits, holding times and severities).
METRIC_RULES = (
    MetricRule("FlowEngineDown", "up", "eq", 0, "1 minute", "critical", job="flow"),
    MetricRule("BrokerExporterDown", "up", "eq", 0, "1 minute", "critical", job="broker"),
    MetricRule("QueueBackpressure", "items_queued", "gt", 50000, "5 minutes", "warning"),
    MetricRule("ConsumerLag", "consumer_lag", "gt", 10000, "5 minutes", "warning", kind="sum"),
    MetricRule("HighErrorRate", "items_removed", "gt", 10, "5 minutes", "warning", kind="rate"),
    MetricRule("ThreadsSaturated", "active_threads", "gt", 50, "5 minutes", "warning"),
    MetricRule("TargetDown", "up", "eq", 0, "2 minutes", "warning"),
)


def evaluate_rule(samples: DataFrame, rule: MetricRule, slice_width: str = "1 hour") -> DataFrame:
    picked = samples.filter(F.col("metric") == rule.metric)
    if rule.job is not None:
        picked = picked.filter(F.col("job") == rule.job)
    if rule.kind == "rate":
        picked = counter_rate(picked, slice_width=slice_width).withColumn("value", F.col("rate"))
    elif rule.kind == "sum":
        blanks = {c: F.lit("") for c in SERIES if c != "metric"}
        picked = (
            picked.groupBy("ts", "metric").agg(F.sum("value").alias("value")).withColumns(blanks)
        )
    value = F.col("value")
    condition = value == rule.limit if rule.test == "eq" else value > rule.limit
    return sustained(picked, condition, rule.hold, slice_width=slice_width).withColumns(
        {"alertname": F.lit(rule.name), "severity": F.lit(rule.severity)}
    )


def evaluate_rules(
    samples: DataFrame, rules: Sequence[MetricRule] = METRIC_RULES, slice_width: str = "1 hour"
) -> DataFrame:
    """Firing episodes of all rules."""
    return union_dlq(*[evaluate_rule(samples, rule, slice_width) for rule in rules])


def group_notifications(
    alerts: DataFrame,
    keys: Sequence[str] = ("alertname", "severity"),
    repeat: str = "1 hour",
    resolve_after: str = "5 minutes",
    wait: str = "10 seconds",
    ts: str = "fired_at",
) -> DataFrame:
    """Notifications sent for alert occurrences: one per group, session and repeat interval.

    A group stays open until it was silent for ``resolve_after``. Within a session the time is
    cut into intervals of ``repeat`` from its start, and every interval with an occurrence
    notifies once, ``wait`` after the interval's first one. Occurrences find their session by
    (group, time bucket), so a group holding most alerts is spread over its buckets.
    """
    keys = list(keys)
    buckets = bucket_sessions(alerts, keys, ts, resolve_after)
    starts = buckets.groupBy(*keys, "session").agg(F.min("_first").alias("session_start"))
    located = buckets.select(*keys, "_bucket", "session").join(starts, [*keys, "session"])
    slot = F.floor(
        (F.unix_micros(ts) - F.unix_micros("session_start")) / F.lit(seconds_of(repeat) * 1_000_000)
    )
    return (
        alerts.select(*keys, ts, time_slice(F.col(ts), resolve_after).alias("_bucket"))
        .join(located, [*keys, "_bucket"])
        .groupBy(*keys, "session", "session_start", slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("alerts"), F.min(ts).alias("_first"))
        .withColumn(
            "notified_at",
            F.timestamp_micros(F.unix_micros("_first") + F.lit(seconds_of(wait) * 1_000_000)),
        )
        .drop("_first")
    )


def component_status(
    samples: DataFrame,
    items_in: str = "items_input",
    items_out: str = "items_output",
    queue: str = "items_queued",
    span: str = "5 minutes",
    job: str | None = None,
    slice_width: str = "1 hour",
) -> DataFrame:
    """Items in, output rate and queue of every component, at its newest samples."""
    """One row per component; where it runs on several nodes, their newest values add up."""
    out = F.col("metric") == items_out
    if job is not None:
        out = out & (F.col("job") == job)
    rates = counter_rate(samples.filter(out), span, slice_width=slice_width)
    newest_rate = latest(rates, SERIES, ts="ts").withColumn("value", F.col("rate"))
    frames = {
        "items_in": instant_values(samples, items_in, job),
        "items_out_rate": newest_rate,
        "queue_size": instant_values(samples, queue, job),
    }
    whole = {n: f.groupBy("component").agg(F.sum("value").alias("value")) for n, f in frames.items()}
    return join_by_field(whole, "component")
