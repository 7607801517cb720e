"""Equipment health, emissions and the failure audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.operators.sequence import extreme_rows
from fieldpulse.functions.times import instant, seconds_between, since

# Weights and bands of the health score: critical alerts count in full, warnings half.
CRITICAL_WEIGHT, WARNING_WEIGHT = 1.0, 0.5
HEALTH_BANDS = ((0.95, "HEALTHY"), (0.85, "DEGRADED"), (0.7, "WARNING"))


def equipment_health(
    readings: DataFrame,
    alerts: DataFrame,
    equipment: DataFrame,
    sensors: DataFrame,
    as_of,
    lookback: str = "24 hours",
) -> DataFrame:
    """Status and score of every piece of equipment over the look-back.

    Score = 1 - (critical + half of warnings) / readings, not below 0. Without a reading the
    equipment is OFFLINE with score 0. Readings and alerts are counted per sensor before they
    meet the sensor list, so no join sees more than one row per sensor.
    """
    seen = since(readings, as_of, lookback).groupBy("sensor_id").agg(F.count(F.lit(1)).alias("_n"))
    alarms = (
        since(alerts, as_of, lookback, "detected_at")
        .groupBy("sensor_id")
        .agg(
            F.count_if(F.col("severity") == "CRITICAL").alias("_crit"),
            F.count_if(F.col("severity") == "WARNING").alias("_warn"),
        )
    )
    per_equipment = (
        sensors.select("sensor_id", "equipment_id")
        .join(seen, "sensor_id", "left")
        .join(alarms, "sensor_id", "left")
        .groupBy("equipment_id")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
            F.coalesce(F.sum("_crit"), F.lit(0)).alias("_crit"),
            F.coalesce(F.sum("_warn"), F.lit(0)).alias("_warn"),
        )
    )
    n = F.coalesce(F.col("_n"), F.lit(0))
    burden = F.col("_crit") * CRITICAL_WEIGHT + F.col("_warn") * WARNING_WEIGHT
    score = F.when(n > 0, F.greatest(1.0 - F.try_divide(burden, n), F.lit(0.0))).otherwise(0.0)
    status = F.when(n == 0, "OFFLINE")
    for bound, name in HEALTH_BANDS:
        status = status.when(score >= bound, name)
    idle = seconds_between(F.col("last_maintenance"), instant(as_of)) / 3600.0
    return equipment.join(per_equipment, "equipment_id", "left").select(
        "equipment_id",
        "platform_id",
        "equipment_name",
        "equipment_type",
        status.otherwise("CRITICAL").alias("status"),
        score.alias("health_score"),
        "last_maintenance",
        idle.alias("hours_since_maintenance"),
        instant(as_of).alias("assessed_at"),
    )


def reporting_period(ts: Column) -> Column:
    """Quarter of a time as ``yyyy-Qn``."""
    return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))


def assess_emissions(df: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Add ``compliant`` and ``reporting_period``; ``limits`` gives limit_ppm per emission type."""
    if limits is not None:
        df = df.drop("limit_ppm").join(limits, "emission_type", "left")
    ok = F.col("value_ppm").isNotNull() & ~F.isnan("value_ppm")
    return df.withColumns(
        {
            "compliant": F.coalesce(ok & (F.col("value_ppm") <= F.col("limit_ppm")), F.lit(False)),
            "reporting_period": reporting_period(F.col("measured_at")),
        }
    )


def emission_summary(assessed: DataFrame) -> DataFrame:
    """Measurements, exceedances and compliance rate per platform, emission and period."""
    return (
        assessed.groupBy("platform_id", "emission_type", "reporting_period")
        .agg(
            F.count(F.lit(1)).alias("measurements"),
            F.count_if(~F.col("compliant")).alias("exceedances"),
            F.max("value_ppm").alias("max_ppm"),
            F.avg("value_ppm").alias("avg_ppm"),
        )
        .withColumn("compliance_rate", 1.0 - F.col("exceedances") / F.col("measurements"))
    )


def audit_failures(dlq: DataFrame, with_payload: bool = True) -> DataFrame:
    """Dead letters per stage and reason: count, first and last time, the newest as a sample."""
    keys = ["stage", "error_reason"]
    counts = dlq.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("failures"),
        F.countDistinct("sensor_id").alias("sensors"),
        F.min("failed_at").alias("first_at"),
        F.max("failed_at").alias("last_at"),
    )
    newest = extreme_rows(dlq.select(*keys, "failed_at", "body", "sensor_id", "platform_id"), keys, ["failed_at", "body"])
    sample = newest.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("sensor_id").alias("sample_sensor_id"),
        F.col("platform_id").alias("sample_platform_id"),
        *([F.col("body").alias("sample_body")] if with_payload else []),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return counts.join(sample, same).drop(*[f"_{k}" for k in keys])
