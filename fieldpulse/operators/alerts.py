"""Alert handling: de-duplication, correlation, escalation, storage and lifecycle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldpulse.functions.times import instant, seconds_between, seconds_of
from fieldpulse.operators.sequence import fold_buckets, time_slice
from fieldpulse.session import scratch_dir

DEDUP_KEYS = ("sensor_id", "anomaly_type")


def dedup_alerts(
    alerts: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    window: str = "30 minutes",
    mode: str = "quiet_gap",
    ts: str = "detected_at",
    tie: str = "alert_id",
    slice_width: str = "6 hours",
) -> DataFrame:
    """Alerts left after suppressing repeats of the same key.

    ``quiet_gap`` keeps an alert when its key was silent for longer than ``window`` before it;
    ``fixed`` keeps it when more than ``window`` has passed since the last alert kept.
    """
    if mode == "quiet_gap":
        return _dedup_quiet_gap(alerts, keys, window, ts, tie)
    if mode == "fixed":
        return _dedup_fixed(alerts, keys, window, ts, tie, slice_width)
    raise ValueError(f"mode must be quiet_gap or fixed, not {mode!r}")


def _dedup_quiet_gap(
    alerts: DataFrame, keys: Sequence[str], window: str, ts: str, tie: str
) -> DataFrame:
    """Alerts of a key in one bucket of the window's width are closer than the window, so only
    the first of them can be kept: buckets are reduced to that one before the shuffle."""
    first = F.min_by(F.struct(*alerts.columns), F.struct(ts, tie))
    folded = fold_buckets(alerts, keys, ts, window, {"_alert": first})
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))
    pause = seconds_between(before, F.col("_first"))
    return (
        folded.withColumn("_pause", pause)
        .filter(F.col("_pause").isNull() | (F.col("_pause") > seconds_of(window)))
        .select("_alert.*")
    )


def _last_reached(times: np.ndarray, window: int) -> np.ndarray:
    """For each alert, the index of the last alert kept if it is the first one kept."""
    step = np.searchsorted(times, times + window, side="right")
    reach = np.where(step < len(times), step, np.arange(len(times)))
    while True:
        further = reach[reach]
        if np.array_equal(further, reach):
            return reach
        reach = further


def _whole_runs(
    batches: Iterator[pd.DataFrame], by: list[str]
) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Sorted batches regrouped to hold whole runs of equal ``by``, with the runs' bounds."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if rows.empty:
            continue
        names = [rows[c].to_numpy() for c in by]
        change = np.logical_or.reduce([n[1:] != n[:-1] for n in names])
        bounds = np.concatenate([[0], np.flatnonzero(change) + 1])
        if len(bounds) > 1:
            yield rows.iloc[: bounds[-1]], bounds
        held = rows.iloc[bounds[-1] :].reset_index(drop=True)
    if held is not None:
        yield held, np.array([0, len(held)])


def _dedup_fixed(
    alerts: DataFrame, keys: Sequence[str], window: str, ts: str, tie: str, slice_width: str
) -> DataFrame:
    """Whether an alert is kept depends on all kept before it, so slices of a key are chained.

    Each (key, slice) is first reduced to a step table: for every alert that could be the first
    kept there, the time of the last one kept. Only alerts next to the slice's start can be
    first, and entries leading to the same end are merged. Per key the tables are then walked
    in order, which tells each slice the last time kept before it, and the slices are marked
    independently again. Python sees sorted partitions and holds one (key, slice) at a time.
    """
    span = seconds_of(window) * 1_000_000
    width = seconds_of(slice_width) * 1_000_000
    keys = list(keys)
    groups = [*keys, "_slice"]
    sliced = alerts.select(
        *keys, tie, F.unix_micros(ts).alias("_us"), time_slice(F.col(ts), slice_width).alias("_slice")
    )
    key_types = [f"`{n}` {t}" for n, t in sliced.select(*keys).dtypes]

    def step_tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, bounds in _whole_runs(batches, groups):
            us, slices = rows["_us"].to_numpy(), rows["_slice"].to_numpy()
            enter, leave = [], []
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                times = us[begin:end]
                border = int(slices[begin]) * width + span
                entries = min(int(np.searchsorted(times, border, side="left")) + 1, len(times))
                ends = times[_last_reached(times, span)][:entries]
                last_of_run = np.append(ends[1:] != ends[:-1], True)
                enter.append(times[:entries][last_of_run])
                leave.append(ends[last_of_run])
            out = rows[groups].iloc[bounds[:-1]].copy()
            out["_enter"], out["_exit"] = enter, leave
            yield out

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        series, kept = None, None
        for batch in batches:
            before = []
            names = batch[keys].itertuples(index=False, name=None)
            for name, enter, leave in zip(names, batch["_enter"], batch["_exit"], strict=True):
                if name != series:
                    series, kept = name, None
                before.append(kept)
                at = 0 if kept is None else int(np.searchsorted(enter, kept + span, side="right"))
                if at < len(enter):
                    kept = int(leave[at])
            out = batch[groups].copy()
            out["_before"] = pd.array(before, dtype="Int64")
            yield out

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, bounds in _whole_runs(batches, groups):
            us, before = rows["_us"].to_numpy(), rows["_before"].to_numpy("float64", na_value=np.nan)
            chosen = []
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                at, last = begin + 1, before[begin]
                if not np.isnan(last):
                    at += int(np.searchsorted(us[at:end], last + span, side="right"))
                while at < end:
                    chosen.append(at)
                    at += int(np.searchsorted(us[at:end], us[at] + span, side="right"))
            yield rows.iloc[chosen][[*keys, tie]]

    tables = (
        sliced.select(*groups, "_us")
        .repartition(*groups)
        .sortWithinPartitions(*groups, "_us")
        .mapInPandas(
            step_tables,
            ", ".join([*key_types, "_slice bigint", "_enter array<bigint>", "_exit array<bigint>"]),
        )
    )
    carried = (
        tables.repartition(*keys)
        .sortWithinPartitions(*groups)
        .mapInPandas(carry, ", ".join([*key_types, "_slice bigint", "_before bigint"]))
    )
    # The carried time of a slice sorts in front of its alerts.
    marked = (
        sliced.unionByName(carried, allowMissingColumns=True)
        .repartition(*groups)
        .sortWithinPartitions(*groups, F.asc_nulls_first("_us"), tie)
        .mapInPandas(
            mark,
            ", ".join([*key_types, f"`{tie}` {dict(sliced.dtypes)[tie]}"]),
        )
    )
    return alerts.join(marked, [*keys, tie], "left_semi").select(*alerts.columns)


def correlate(
    alerts: DataFrame,
    width: str = "5 minutes",
    k: int = 2,
    group: str = "equipment_id",
    ts: str = "detected_at",
) -> DataFrame:
    """Time buckets in which at least ``k`` sensors of one equipment (or platform) alarmed.

    Counting per sensor first keeps the second step's input to one row per sensor and bucket;
    both steps are plain aggregations, so the same definition runs on a stream.
    """
    per_sensor = alerts.groupBy(F.window(ts, width).alias("_w"), group, "sensor_id").agg(
        F.count(F.lit(1)).alias("_alerts"),
        F.max(F.when(F.col("severity") == "CRITICAL", 1).otherwise(0)).alias("_critical"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
    )
    return (
        per_sensor.groupBy("_w", group)
        .agg(
            F.count(F.lit(1)).alias("sensors"),
            F.sum("_alerts").alias("alerts"),
            F.max("_critical").alias("_critical"),
            F.min("_first").alias("first_at"),
            F.max("_last").alias("last_at"),
        )
        .filter(F.col("sensors") >= k)
        .select(
            F.col("_w.start").alias("bucket"),
            group,
            "sensors",
            "alerts",
            "first_at",
            "last_at",
            F.when(F.col("_critical") == 1, "CRITICAL").otherwise("WARNING").alias("severity"),
            F.lit("multi_sensor_correlation").alias("anomaly_type"),
        )
    )


def escalate(
    alerts: DataFrame,
    rules: DataFrame,
    as_of=None,
    each_attempt: bool = False,
) -> DataFrame:
    """One row per alert and enabled rule of its severity, with the time of notification.

    An alert acknowledged or resolved by then is not notified. ``as_of`` keeps what is due;
    ``each_attempt`` gives one row per allowed attempt.
    """
    active = rules.filter("enabled").select(
        "severity", "rule_id", "action_type", "target_endpoint", "delay_seconds", "max_retries"
    )
    notify_at = F.timestamp_micros(
        F.unix_micros("detected_at") + F.col("delay_seconds").cast("bigint") * 1_000_000
    )
    due = alerts.join(active, "severity").withColumn("notify_at", notify_at)
    for done in ("acknowledged_at", "resolved_at"):
        if done in alerts.columns:
            due = due.filter(F.col(done).isNull() | (F.col(done) > F.col("notify_at")))
    if as_of is not None:
        due = due.filter(F.col("notify_at") <= instant(as_of))
    if each_attempt:
        due = due.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.col("max_retries"))))
    return due


LIFECYCLE = {
    "acknowledged": ("boolean", False),
    "acknowledged_by": ("string", None),
    "acknowledged_at": ("timestamp", None),
    "resolved": ("boolean", False),
    "resolved_at": ("timestamp", None),
}


def with_lifecycle(alerts: DataFrame) -> DataFrame:
    """Acknowledgement and resolution columns, open where the input has none."""
    columns: dict[str, Column] = {}
    for name, (dtype, default) in LIFECYCLE.items():
        value = F.col(name).cast(dtype) if name in alerts.columns else F.lit(None).cast(dtype)
        columns[name] = value if default is None else F.coalesce(value, F.lit(default))
    return alerts.withColumns(columns)


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Append to the alert table, one folder per day."""
    rows = with_lifecycle(alerts).withColumn("date", F.to_date("detected_at"))
    if not rows.isStreaming:
        rows = rows.repartitionByRange("date", "sensor_id", "detected_at", "alert_id")
    rows.write.partitionBy("date").mode(mode).parquet(path)


def resolve(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """Alerts with acknowledgements applied: ``acks`` holds alert_id and any of
    acknowledged_by/acknowledged_at/resolved_at. The earliest of several entries counts."""
    latest = acks.groupBy("alert_id").agg(
        F.min_by("acknowledged_by", "acknowledged_at").alias("_by"),
        F.min("acknowledged_at").alias("_at"),
        F.min("resolved_at").alias("_resolved_at"),
    )
    base = with_lifecycle(alerts)
    joined = base.join(latest, "alert_id", "left")
    return joined.withColumns(
        {
            "acknowledged": F.col("acknowledged") | F.col("_at").isNotNull(),
            "acknowledged_by": F.coalesce("acknowledged_by", "_by"),
            "acknowledged_at": F.coalesce("acknowledged_at", "_at"),
            "resolved": F.col("resolved") | F.col("_resolved_at").isNotNull(),
            "resolved_at": F.coalesce("resolved_at", "_resolved_at"),
        }
    ).select(*base.columns)


def resolve_stored(spark: SparkSession, path: str, acks: DataFrame) -> None:
    """Apply acknowledgements to the alert table, rewriting only the days that hold such alerts.

    The new days are written to the shared scratch folder first: the rewrite then reads no
    folder that it replaces, and repeating it changes nothing.
    """
    stored = spark.read.parquet(path)
    days = stored.join(acks.select("alert_id"), "alert_id", "left_semi").select("date").distinct()
    staged = scratch_dir(spark, "alert-lifecycle")
    touched = stored.join(days, "date", "left_semi")
    resolve(touched, acks).write.partitionBy("date").parquet(staged)
    spark.read.schema(stored.schema).parquet(staged).write.partitionBy("date").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
