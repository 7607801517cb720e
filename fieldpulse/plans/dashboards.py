"""Dashboard queries. ``as_of`` stands for the current time, look-backs are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.labels import RESOLVED_LABELS, label_map
from fieldpulse.functions.times import seconds_between, seconds_of, since
from fieldpulse.operators.joins import platform_health
from fieldpulse.operators.rollup import readings_per_sec, rollup


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _sensor(df: DataFrame, platform_id: str, sensor_id: str) -> DataFrame:
    return df.filter((F.col("platform_id") == platform_id) & (F.col("sensor_id") == sensor_id))


def active_platforms(platforms: DataFrame) -> DataFrame:
    return _count(platforms.filter("status = 'ACTIVE'"), "active_platforms")


def sensors_online(sensors: DataFrame) -> DataFrame:
    return _count(sensors.filter("status = 'ACTIVE'"), "sensors_online")


def unresolved_alerts(alerts: DataFrame) -> DataFrame:
    return _count(alerts.filter(~F.col("resolved")), "unresolved_alerts")


def ingest_rate(readings: DataFrame, as_of, lookback: str = "1 minute") -> DataFrame:
    return readings_per_sec(readings, as_of, lookback)


def health_summary(platforms: DataFrame, sensors: DataFrame, alerts: DataFrame) -> DataFrame:
    return platform_health(platforms, sensors, alerts).orderBy(
        F.desc("alert_count"), "platform_id"
    )


def readings_per_platform(rollup_1m: DataFrame, as_of, lookback: str = "1 hour") -> DataFrame:
    return (
        since(rollup_1m, as_of, lookback, "bucket")
        .groupBy("bucket", "platform_id")
        .agg(F.sum("reading_count").alias("readings"))
        .orderBy("bucket", "platform_id")
    )


def raw_series(
    readings: DataFrame, platform_id: str, sensor_id: str, as_of, lookback: str = "30 minutes"
) -> DataFrame:
    rows = _sensor(since(readings, as_of, lookback), platform_id, sensor_id)
    return rows.select("time", F.col("value").alias("sensor_value")).orderBy("time")


def trend_band(
    rollup_1m: DataFrame, platform_id: str, sensor_id: str, as_of, lookback: str = "1 hour"
) -> DataFrame:
    rows = _sensor(since(rollup_1m, as_of, lookback, "bucket"), platform_id, sensor_id)
    return rows.select("bucket", "avg_value", "min_value", "max_value").orderBy("bucket")


def current_value(
    readings: DataFrame, platform_id: str, sensor_id: str, as_of, lookback: str = "5 minutes"
) -> DataFrame:
    rows = _sensor(since(readings, as_of, lookback), platform_id, sensor_id)
    newest = rows.orderBy(F.desc("time"), F.desc("reading_id")).limit(1)
    return newest.select(F.col("value").alias("current_value"))


def _statistic(readings, platform_id, sensor_id, as_of, lookback, column: Column) -> DataFrame:
    return _sensor(since(readings, as_of, lookback), platform_id, sensor_id).agg(column)


def min_value(
    readings: DataFrame, platform_id: str, sensor_id: str, as_of, lookback: str = "5 minutes"
) -> DataFrame:
    column = F.min("value").alias("min_value")
    return _statistic(readings, platform_id, sensor_id, as_of, lookback, column)


def max_value(
    readings: DataFrame, platform_id: str, sensor_id: str, as_of, lookback: str = "5 minutes"
) -> DataFrame:
    column = F.max("value").alias("max_value")
    return _statistic(readings, platform_id, sensor_id, as_of, lookback, column)


def avg_value(
    readings: DataFrame, platform_id: str, sensor_id: str, as_of, lookback: str = "5 minutes"
) -> DataFrame:
    """Mean rounded half up to two digits, as decimals round."""
    column = F.round(F.avg("value").cast("decimal(38,10)"), 2).alias("avg_value")
    return _statistic(readings, platform_id, sensor_id, as_of, lookback, column)


def _alert_rows(alerts: DataFrame, *lead: str) -> DataFrame:
    return alerts.select(
        "detected_at",
        *lead,
        "severity",
        "anomaly_type",
        "actual_value",
        "threshold_value",
        "description",
        label_map(F.col("resolved"), {}).alias("resolved"),
    )


def sensor_alerts(
    alerts: DataFrame, platform_id: str, sensor_id: str, limit: int = 20
) -> DataFrame:
    rows = _sensor(alerts, platform_id, sensor_id)
    return _alert_rows(rows.orderBy(F.desc("detected_at"), F.desc("alert_id")).limit(limit))


def platform_choices(platforms: DataFrame) -> DataFrame:
    return platforms.filter("status = 'ACTIVE'").select("platform_id").orderBy("platform_id")


def sensor_choices(sensors: DataFrame, platform_id: str) -> DataFrame:
    active = sensors.filter((F.col("platform_id") == platform_id) & (F.col("status") == "ACTIVE"))
    return active.select("sensor_id").orderBy("sensor_id")


def critical_alerts(alerts: DataFrame) -> DataFrame:
    open_critical = alerts.filter(~F.col("resolved") & (F.col("severity") == "CRITICAL"))
    return _count(open_critical, "critical_alerts")


def mean_resolution(alerts: DataFrame, as_of, lookback: str = "24 hours") -> DataFrame:
    minutes = seconds_between(F.col("detected_at"), F.col("resolved_at")) / 60.0
    mean = F.round(F.avg(minutes).cast("decimal(38,10)"), 1)
    done = since(alerts, as_of, lookback, "detected_at").filter("resolved")
    return done.agg(F.coalesce(mean, F.lit(0)).alias("avg_resolution_min"))


def alert_timeline(alerts: DataFrame, as_of, lookback: str = "24 hours") -> DataFrame:
    return (
        since(alerts, as_of, lookback, "detected_at")
        .groupBy(F.date_trunc("hour", "detected_at").alias("hour"), "severity")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy("hour", "severity")
    )


def severity_distribution(alerts: DataFrame, as_of, lookback: str = "24 hours") -> DataFrame:
    return (
        since(alerts, as_of, lookback, "detected_at")
        .groupBy("severity")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .orderBy(F.desc("alerts"), "severity")
    )


def top_sensors(
    alerts: DataFrame, as_of, lookback: str = "24 hours", limit: int = 10
) -> DataFrame:
    return (
        since(alerts, as_of, lookback, "detected_at")
        .groupBy("platform_id", "sensor_id")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("alert_count"), "platform_id", "sensor_id")
        .limit(limit)
        .select(F.concat("platform_id", F.lit(" / "), "sensor_id").alias("sensor"), "alert_count")
    )


def recent_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    newest = alerts.orderBy(F.desc("detected_at"), F.desc("alert_id")).limit(limit)
    return _alert_rows(newest, "platform_id", "sensor_id")


def with_resolved_label(rows: DataFrame) -> DataFrame:
    """The resolved column as it is displayed."""
    return rows.withColumn("resolved", label_map(F.col("resolved"), RESOLVED_LABELS))


def time_spread(readings: DataFrame, as_of, lookback: str = "60 seconds") -> DataFrame:
    spread = seconds_between(F.min("time"), F.max("time")).alias("time_spread_s")
    return since(readings, as_of, lookback).agg(spread)


def ingest_latency(readings: DataFrame, ingest: str = "ingested_at") -> DataFrame:
    """Mean and largest delay between event and ingestion, in seconds."""
    delay = seconds_between(F.col("time"), F.col(ingest))
    return readings.agg(F.avg(delay).alias("avg_latency_s"), F.max(delay).alias("max_latency_s"))


def write_rate(
    rollup_1m: DataFrame, as_of, lookback: str = "1 hour", width: str = "1 minute"
) -> DataFrame:
    per_second = F.sum("reading_count") / F.lit(float(seconds_of(width)))
    return (
        since(rollup_1m, as_of, lookback, "bucket")
        .groupBy("bucket")
        .agg(per_second.alias("writes_per_sec"))
        .orderBy("bucket")
    )


def readings_last_minute(readings: DataFrame, as_of, lookback: str = "1 minute") -> DataFrame:
    return _count(since(readings, as_of, lookback), "readings")


def minute_rollup(readings: DataFrame, as_of, lookback: str) -> DataFrame:
    """One-minute rollup of the look-back, for sites that keep no stored rollup."""
    return rollup(since(readings, as_of, lookback), "1 minute")
