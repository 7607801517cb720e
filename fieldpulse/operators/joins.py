"""Reference joins: enrichment, health, sensor expansion, insert-if-absent, checks.

No join carries a broadcast hint. Reference tables are usually small and Catalyst broadcasts
them when their known size is below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is
shuffled, and adaptive execution splits the partitions of hot sensors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.operators.sequence import extreme_rows
from fieldpulse.functions.times import instant
from fieldpulse.sources.reference import DEFAULT_SIGNAL, FITTED_TYPES, SENSOR_TEMPLATES


def sensor_directory(
    sensors: DataFrame, equipment: DataFrame, platforms: DataFrame
) -> DataFrame:
    """Equipment and platform of every sensor, joined once so that facts join only once."""
    return (
        sensors.select("sensor_id", "equipment_id")
        .join(
            equipment.select(
                "equipment_id",
                "equipment_name",
                "equipment_type",
                F.col("platform_id").alias("_platform_id"),
            ),
            "equipment_id",
            "left",
        )
        .join(
            platforms.select(
                F.col("platform_id").alias("_platform_id"),
                "platform_name",
                "latitude",
                "longitude",
                "region",
            ),
            "_platform_id",
            "left",
        )
        .drop("_platform_id")
    )


def enrich(
    readings: DataFrame,
    sensors: DataFrame,
    equipment: DataFrame,
    platforms: DataFrame,
    at: Column | str | None = None,
) -> DataFrame:
    """Readings with equipment and platform data; unknown sensors stay, with null metadata.

    ``match_status`` tells how far the lookup got, ``equipment_metadata`` holds the lookup
    result as one struct beside the flat contract columns.
    """
    found = [
        "equipment_id",
        "equipment_name",
        "equipment_type",
        "platform_name",
        "latitude",
        "longitude",
        "region",
    ]
    directory = sensor_directory(sensors, equipment, platforms).withColumn("_known", F.lit(True))
    base = readings.drop(*found)
    status = (
        F.when(F.col("_known").isNull(), "sensor_unknown")
        .when(F.col("equipment_name").isNull(), "equipment_unknown")
        .when(F.col("platform_name").isNull(), "platform_unknown")
        .otherwise("matched")
    )
    when = F.col("time") if at is None else at if isinstance(at, Column) else instant(at)
    return (
        base.join(directory, "sensor_id", "left")
        .withColumns(
            {
                "match_status": status,
                "equipment_metadata": F.when(F.col("_known"), F.struct(*found)),
                "enriched_at": when,
            }
        )
        .drop("_known")
    )


def platform_health(platforms: DataFrame, sensors: DataFrame, alerts: DataFrame) -> DataFrame:
    """Active platforms with their active sensors, open alerts and newest alert.

    Each side is reduced to one row per platform before the joins; joined first, sensors and
    alerts of a platform would multiply.
    """
    online = (
        sensors.filter("status = 'ACTIVE'")
        .groupBy("platform_id")
        .agg(F.countDistinct("sensor_id").alias("_sensors"))
    )
    alarms = alerts.groupBy("platform_id").agg(
        F.countDistinct(F.when(~F.col("resolved"), F.col("alert_id"))).alias("_open"),
        F.max("detected_at").alias("latest_alert_time"),
    )
    return (
        platforms.filter("status = 'ACTIVE'")
        .join(online, "platform_id", "left")
        .join(alarms, "platform_id", "left")
        .select(
            "platform_id",
            "platform_name",
            "region",
            F.coalesce("_sensors", F.lit(0)).alias("sensor_count"),
            F.coalesce("_open", F.lit(0)).alias("alert_count"),
            "latest_alert_time",
        )
    )


def expand_sensors(
    equipment: DataFrame,
    templates: Sequence[tuple] = tuple(SENSOR_TEMPLATES),
    types: Sequence[str] = FITTED_TYPES,
) -> DataFrame:
    """The standard sensors of every piece of equipment of a fitted type.

    The few templates are an array literal, so this is a projection and not a cross join.
    """
    items = F.array(
        *[
            F.struct(
                F.lit(suffix).alias("suffix"),
                F.lit(kind).alias("sensor_type"),
                F.lit(unit).alias("unit"),
                F.lit(low).alias("min_range"),
                F.lit(high).alias("max_range"),
            )
            for suffix, kind, unit, low, high in templates
        ]
    )
    return (
        equipment.filter(F.col("equipment_type").isin(*types))
        .select("equipment_id", "platform_id", F.explode(items).alias("_t"))
        .select(
            F.concat("equipment_id", F.lit("-"), "_t.suffix").alias("sensor_id"),
            "equipment_id",
            "platform_id",
            "_t.sensor_type",
            "_t.unit",
            "_t.min_range",
            "_t.max_range",
        )
    )


def append_new(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """``existing`` plus the incoming rows whose key it does not hold yet.

    Of incoming rows sharing a key the first by ``order`` (else by all columns) is taken, see
    ``extreme_rows``; a much repeated key does not pile up.
    """
    rest = [c for c in incoming.columns if c not in keys and c not in order]
    chosen = extreme_rows(incoming, keys, [*order, *rest], newest=False)
    fresh = chosen.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*incoming.columns), allowMissingColumns=True)


def join_by_field(frames: dict[str, DataFrame], key: str, value: str = "value") -> DataFrame:
    """Full outer join of metric frames: the key and one column per frame, named after it."""
    narrow = [df.select(key, F.col(value).alias(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.join(b, key, "full"), narrow)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row, a null key included."""
    return child.join(parent.select(key), key, "left_anti")


def seasonal_residual(
    readings: DataFrame, signals: DataFrame, start=None, ts: str = "time"
) -> DataFrame:
    """Expected seasonal value of a reading, and its distance from it.

    ``expected = setpoint + amplitude * sin(2π * hours / period)``, hours counted from
    ``start`` (default the epoch). Readings without an entry use the default signal.
    """
    origin = F.unix_micros(instant(start)) if start is not None else F.lit(0)
    hours = (F.unix_micros(ts) - origin) / F.lit(3.6e9)
    table = signals.select(
        F.col("sensor_type").alias("_type"),
        F.col("subtype").alias("_subtype"),
        *[F.col(c).alias(f"_{c}") for c in DEFAULT_SIGNAL],
    )
    subtype = F.col("subtype") if "subtype" in readings.columns else F.lit(None).cast("string")
    picked = {n: F.coalesce(F.col(f"_{n}"), F.lit(d)) for n, d in DEFAULT_SIGNAL.items()}
    wave = F.sin(F.lit(2.0) * F.pi() * hours / picked["period_hours"])
    expected = picked["setpoint"] + F.when(picked["amplitude"] == 0.0, 0.0).otherwise(
        picked["amplitude"] * wave
    )
    return (
        readings.withColumns({"_t": F.lower("sensor_type"), "_s": subtype})
        .join(table, (F.col("_t") == F.col("_type")) & (F.col("_s") == F.col("_subtype")), "left")
        .withColumn("expected", expected)
        .withColumn("residual", F.col("value") - F.col("expected"))
        .select(*readings.columns, "expected", "residual")
    )
