"""The driver's tables seen as telemetry: platforms, equipment, sensors, readings, alerts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldpulse.config import DetectorConfig
from fieldpulse.functions.times import instant
from fieldpulse.operators.detect import threshold_detect
from fieldpulse.operators.parse import with_parsed
from fieldpulse.session import use_utc
from fieldpulse.sources.sinks import to_dlq

AS_OF = "2024-01-31 00:00:00"

# Limits under which every detector branch occurs in the driver's data.
FIXTURE = DetectorConfig(
    critical_high=200.0,
    warning_high=140.0,
    critical_low=1.0,
    warning_low=3.0,
    window_size=20,
    deviation_threshold=2.5,
    max_rate=0.005,
    rate_window_s=21_600,
)
RULE_FIXTURE = {"pressure_high": 150.0, "quality_low": 0.05}

SENSOR_KINDS = ["temperature", "pressure", "vibration", "flow_rate", "h2s_concentration"]
SENSOR_UNITS = ["celsius", "bar", "mm_s", "m3_h", "ppm"]
SENSOR_SUBTYPES = ["bearing_temp", "inlet_pressure", "axial_vibration", "flow_rate", "none"]
EQUIPMENT_KINDS = ["pump", "compressor", "turbine", "generator", "valve"]
EMISSION_OF_EVENT = {"view": "CO2", "click": "NOx", "signup": "SOx", "error": "CH4", "purchase": "VOC"}


def pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def lookup(mapping: dict[str, str], key: Column) -> Column:
    chosen = None
    for k, v in mapping.items():
        chosen = F.when(key == k, v) if chosen is None else chosen.when(key == k, v)
    return chosen


def sensor_columns(user: Column) -> dict[str, Column]:
    kind = (F.floor(user / 5) % 5).cast("int")
    place = user % 25
    subtype = F.when(user % 3 == 0, pick(SENSOR_SUBTYPES, kind)).when(user % 3 == 1, "custom")
    return {
        "sensor_id": F.concat(F.lit("S-"), user.cast("string")),
        "equipment_id": F.concat(F.lit("EQ-"), place.cast("string")),
        "platform_id": F.concat(F.lit("P"), (place % 5).cast("string")),
        "sensor_type": pick(SENSOR_KINDS, kind),
        "subtype": subtype,
        "unit": pick(SENSOR_UNITS, kind),
    }


def readings_of(events: DataFrame) -> DataFrame:
    """Readings of an events frame, batch or stream; a projection without a shuffle."""
    quality = F.when(F.col("event_type") == "error", "BAD").when(
        F.col("event_type") == "signup", "UNCERTAIN"
    )
    sensor = sensor_columns(F.col("user_id"))
    return events.select(
        F.col("ts").cast("timestamp").alias("time"),
        F.col("event_id").cast("string").alias("reading_id"),
        *[sensor[c].alias(c) for c in ("platform_id", "sensor_id", "sensor_type", "subtype")],
        "value",
        sensor["unit"].alias("unit"),
        quality.otherwise("GOOD").alias("quality_flag"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("quality_score"),
        sensor["equipment_id"].alias("equipment_id"),
        "event_id",
        "event_type",
    )


# Times no reading can have: too large for any unit, negative, far beyond the calendar, no number.
BAD_TIMES = ("9223372036854775807", "-9000000000000000000", "99999999999999999", '"n/a"')


def raw_of(readings: DataFrame) -> DataFrame:
    """Readings as JSON documents with the usual faults in some, and their topic."""
    event = F.col("event_id")
    quote = F.lit('"')

    def text(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":"'), value, quote)

    sensor = F.when(event % 79 == 0, "").otherwise(F.col("sensor_id"))
    number = F.when(event % 83 == 0, F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    value = F.when(event % 89 == 0, "").otherwise(F.concat(F.lit('"value":'), number, F.lit(",")))
    body = F.concat(
        F.lit("{"),
        text("reading_id", F.col("reading_id")),
        F.lit(","),
        text("platform_id", F.col("platform_id")),
        F.lit(","),
        text("sensor_id", sensor),
        F.lit(","),
        text("sensor_type", F.upper("sensor_type")),
        F.lit(","),
        value,
        text("unit", F.col("unit")),
        F.lit(',"timestamp":'),
        F.when(event % 73 == 0, F.element_at(F.array(*[F.lit(t) for t in BAD_TIMES]), (event % 4 + 1).cast("int"))).otherwise(
            F.unix_millis("time").cast("string")
        ),
        F.lit(","),
        text("quality_flag", F.col("quality_flag")),
        F.lit("}"),
    )
    return readings.select(
        F.when(event % 97 == 0, F.substring(body, 1, 40)).otherwise(body).alias("body"),
        F.concat(
            F.lit("sensors/"), F.col("platform_id"), F.lit("/"), F.col("sensor_id"), F.lit("/data")
        ).alias("topic"),
        "event_id",
        F.col("time").alias("received_at"),
    )


def alerts_of(readings: DataFrame) -> DataFrame:
    """Readings outside the fixed limits, a third of them resolved after up to three hours."""
    found = threshold_detect(readings, FIXTURE).filter(F.col("anomaly.severity") != "NORMAL")
    event = F.col("event_id")
    resolved_at = F.timestamp_micros(F.unix_micros("time") + (event % 180) * 60_000_000)
    return found.select(
        F.concat(F.lit("A-"), "reading_id").alias("alert_id"),
        "sensor_id",
        "platform_id",
        "equipment_id",
        F.col("anomaly.type").alias("anomaly_type"),
        F.col("anomaly.severity").alias("severity"),
        F.col("value").alias("actual_value"),
        F.col("anomaly.threshold_value").alias("threshold_value"),
        "sensor_type",
        "unit",
        F.col("anomaly.description").alias("description"),
        "reading_id",
        F.col("time").alias("detected_at"),
        (event % 3 == 0).alias("resolved"),
        F.when(event % 3 == 0, resolved_at).alias("resolved_at"),
        "event_id",
    )


@dataclass(frozen=True)
class Views:
    """Telemetry frames over one folder of driver tables, built when first used."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def stream_events(self) -> DataFrame:
        files = f"{self.folder}/events*.parquet"
        return self.spark.readStream.schema(self.events.schema).parquet(files)

    @cached_property
    def platforms(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.table("region").select(
            F.concat(F.lit("P"), key.cast("string")).alias("platform_id"),
            F.col("r_name").alias("platform_name"),
            (key * 10.0).alias("latitude"),
            (key * -10.0).alias("longitude"),
            F.col("r_name").alias("region"),
            F.lit("ACTIVE").alias("status"),
        )

    @cached_property
    def equipment(self) -> DataFrame:
        key = F.col("n_nationkey")
        since = F.unix_micros(instant(AS_OF)) - key * F.lit(400 * 3_600_000_000)
        return self.table("nation").select(
            F.concat(F.lit("EQ-"), key.cast("string")).alias("equipment_id"),
            F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("platform_id"),
            F.col("n_name").alias("equipment_name"),
            pick(EQUIPMENT_KINDS, (F.floor(key / 5) % 5).cast("int")).alias("equipment_type"),
            F.timestamp_micros(since.cast("bigint")).alias("last_maintenance"),
        )

    @cached_property
    def sensors(self) -> DataFrame:
        user = F.col("user_id")
        return self.events.select("user_id").distinct().select(
            *[c.alias(n) for n, c in sensor_columns(user).items()],
            F.lit(0.0).alias("min_range"),
            F.lit(300.0).alias("max_range"),
            F.when(user % 10 == 9, "INACTIVE").otherwise("ACTIVE").alias("status"),
            "user_id",
        )

    @cached_property
    def readings(self) -> DataFrame:
        return readings_of(self.events)

    @cached_property
    def raw(self) -> DataFrame:
        return raw_of(self.readings)

    @cached_property
    def alerts(self) -> DataFrame:
        return alerts_of(self.readings)

    @cached_property
    def emissions(self) -> DataFrame:
        return self.readings.filter("sensor_type = 'h2s_concentration'").select(
            F.col("reading_id").alias("measurement_id"),
            "platform_id",
            lookup(EMISSION_OF_EVENT, F.col("event_type")).alias("emission_type"),
            F.col("value").alias("value_ppm"),
            F.lit(100.0).alias("limit_ppm"),
            F.col("time").alias("measured_at"),
        )

    @cached_property
    def samples(self) -> DataFrame:
        """Hourly metric samples per event type: a counter restarting each midnight, a queue
        gauge and an up flag. The hourly counts are small, whatever the number of events."""
        hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
        counts = self.events.groupBy("event_type", hour.alias("ts")).agg(
            F.count(F.lit(1)).alias("n")
        )
        grid = counts.groupBy("event_type").agg(
            F.explode(F.sequence(F.min("ts"), F.max("ts"), F.expr("INTERVAL 1 HOUR"))).alias("ts")
        )
        hourly = grid.join(counts, ["event_type", "ts"], "left").fillna(0, ["n"])
        day = Window.partitionBy("event_type", F.to_date("ts")).orderBy("ts")
        running = F.sum("n").over(day.rowsBetween(Window.unboundedPreceding, 0))
        metrics = {
            "items_input": F.col("_running"),
            "items_output": F.col("_running") * 2,
            "items_queued": F.col("n") * 3,
            "up": F.when(F.col("n") > 0, 1).otherwise(0),
        }
        pairs = F.array(
            *[
                F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"))
                for m, v in metrics.items()
            ]
        )
        return (
            hourly.withColumn("_running", running)
            .select("ts", F.col("event_type").alias("component"), F.explode(pairs).alias("_m"))
            .select(
                "ts",
                F.lit("flow").alias("job"),
                F.lit("node-1").alias("instance"),
                F.col("_m.metric").alias("metric"),
                "component",
                F.col("_m.value").alias("value"),
            )
        )

    @cached_property
    def dlq(self) -> DataFrame:
        """Dead letters of two stages over the raw documents."""
        parsed = with_parsed(self.raw)
        unread = F.col("error_reason").isNotNull()
        low = ~unread & F.coalesce(F.col("quality_flag") == "BAD", F.lit(False))
        judged = parsed.filter(unread | low).withColumns(
            {
                "stage": F.when(unread, F.lit("parse")).otherwise(F.lit("quality")),
                "error_reason": F.coalesce("error_reason", F.lit("bad_quality")),
                "error_text": F.coalesce("error_text", F.lit("quality flag BAD")),
            }
        )
        return to_dlq(judged, F.col("stage"), F.col("received_at"))


def load(spark: SparkSession, folder: str) -> Views:
    return Views(use_utc(spark), folder)

