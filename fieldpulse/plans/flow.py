"""The ingest flow as one composed plan: parse, gate, validate, enrich, flag, route, store."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.config import DEV, DetectorConfig
from fieldpulse.operators.alerts import write_alerts
from fieldpulse.operators.detect import chain_to_alerts, detect_all, threshold_detect
from fieldpulse.operators.joins import enrich
from fieldpulse.operators.parse import split_errors, with_parsed
from fieldpulse.operators.routing import (
    compliance_events,
    route_severity,
    rule_anomalies,
)
from fieldpulse.operators.validate import gate_error, quality_gate, validate_range
from fieldpulse.session import scratch_dir
from fieldpulse.sources import publish
from fieldpulse.sources.contracts import normalize_vocabulary
from fieldpulse.sources.sinks import (
    archive_json,
    to_dlq,
    to_keyed_records,
    to_reading_rows,
    write_dlq,
    write_readings,
    write_records,
)


# Topics of the keyed outputs.
TOPICS = {
    "raw": "sensor.raw",
    "validated": "sensor.validated",
    "enriched": "sensor.enriched",
    "alert": "sensor.alert",
    "compliance": "sensor.compliance",
    "dlq": "sensor.dlq",
}


@dataclass(frozen=True)
class Dimensions:
    platforms: DataFrame
    equipment: DataFrame
    sensors: DataFrame


@dataclass(frozen=True)
class FlowConfig:
    detectors: DetectorConfig = DEV
    rule_limits: Mapping[str, float] = field(default_factory=dict)
    failed_at: Column | str | None = None
    archive_layout: str = "full"


def _staged(df: DataFrame, purpose: str) -> DataFrame:
    place = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def stage(
    fn: Callable[..., DataFrame], config: object | None = None, name: str | None = None, stored: bool = False
) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """A user-supplied transform as a stage with a success and a failure output.

    ``fn(df)`` or ``fn(df, config)`` returns a frame; rows it marks with an ``error_reason``
    leave through the failure output under the stage's name. With ``stored`` the result is written
    to the shared scratch folder first, so that ``fn`` runs once per row and not once per output.
    """
    label = name or fn.__name__

    def run(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        result = fn(df) if config is None else fn(df, config)
        if "error_reason" not in result.columns:
            return result, result.filter(F.lit(False))
        if stored:
            result = _staged(result, f"stage-{label}")
        failed = result.filter(F.col("error_reason").isNotNull())
        passed = result.filter(F.col("error_reason").isNull()).drop("error_reason", "error_text")
        return passed, failed.withColumn("stage", F.lit(label))

    return run


@dataclass(frozen=True)
class Stages:
    """Outputs of the stateless part of the flow, all derived from the parsed documents."""

    parsed: DataFrame
    dims: Dimensions
    config: FlowConfig

    def rebuild(self, parsed: DataFrame) -> Stages:
        return Stages(parsed, self.dims, self.config)

    @property
    def _good(self) -> DataFrame:
        return normalize_vocabulary(split_errors(self.parsed)[0])

    @property
    def gated(self) -> DataFrame:
        return quality_gate(self._good)[0]

    @property
    def validated(self) -> DataFrame:
        return validate_range(self.gated, self.dims.sensors)

    @property
    def enriched(self) -> DataFrame:
        return enrich(
            self.validated.drop("body", "value_text"),
            self.dims.sensors,
            self.dims.equipment,
            self.dims.platforms,
        )

    @property
    def reading_rows(self) -> DataFrame:
        return to_reading_rows(self.gated)

    @property
    def rule_hits(self) -> DataFrame:
        return rule_anomalies(self.gated, self.config.rule_limits)

    @property
    def rule_alerts(self) -> DataFrame:
        """The domain rules' hits in the layout of the detectors' alerts."""
        return self.rule_hits.select(
            F.sha2(F.concat_ws("|", "reading_id", "anomaly_type"), 256).alias("alert_id"),
            "sensor_id",
            "platform_id",
            "anomaly_type",
            "severity",
            F.col("value").alias("actual_value"),
            F.lit(None).cast("double").alias("threshold_value"),
            "sensor_type",
            "unit",
            F.lit(None).cast("string").alias("description"),
            "detected_at",
            "reading_id",
        )

    def routed(self, detected: DataFrame) -> DataFrame:
        """Detector and rule alerts with their channels."""
        return route_severity(detected.unionByName(self.rule_alerts))

    @property
    def alerts(self) -> DataFrame:
        """Stateless alerts: fixed limits and domain rules."""
        return self.routed(chain_to_alerts(threshold_detect(self.gated, self.config.detectors)))

    @property
    def compliance(self) -> DataFrame:
        return compliance_events(self.alerts)

    @property
    def dead_letters(self) -> DataFrame:
        """The four feeds in one pass: unread, gate, unknown sensor, value out of its range."""
        known = self.dims.sensors.select(
            F.col("sensor_id").alias("_sensor"), "min_range", "max_range"
        )
        rows = normalize_vocabulary(self.parsed)
        rows = rows.join(known, rows.sensor_id == known._sensor, "left")
        reason, text = gate_error()
        value = F.col("value")
        outside = ~F.isnan(value) & ((value < F.col("min_range")) | (value > F.col("max_range")))
        unread, gated = F.col("error_reason").isNotNull(), reason.isNotNull()
        unknown = F.col("_sensor").isNull()
        outside = F.coalesce(outside, F.lit(False))

        def first(*choices) -> Column:
            chosen = F.when(unread, choices[0]).when(gated, choices[1])
            return chosen.when(unknown, choices[2]).when(outside, choices[3])

        limits = F.concat_ws(" to ", F.col("min_range").cast("string"), F.col("max_range").cast("string"))
        judged = rows.withColumns(
            {
                "stage": first(F.lit("parse"), F.lit("validation"), F.lit("enrichment"), F.lit("range")),
                "error_reason": first(
                    F.col("error_reason"), reason, F.lit("unknown_sensor"), F.lit("out_of_range")
                ),
                "error_text": first(
                    F.col("error_text"), text, F.lit(None).cast("string"), F.concat(F.lit("outside "), limits)
                ),
            }
        )
        rejected = judged.filter(F.col("error_reason").isNotNull())
        return to_dlq(rejected, F.col("stage"), self.config.failed_at)


def stateless_stages(raw: DataFrame, dims: Dimensions, config: FlowConfig) -> Stages:
    return Stages(with_parsed(raw), dims, config)


OUTPUTS = ("readings", "alerts", "compliance", "archive", "dlq", "topics")


def run_batch(
    raw: DataFrame,
    dims: Dimensions,
    out: str,
    config: FlowConfig | None = None,
    run_id: str | None = None,
) -> dict[str, str]:
    """The whole flow over one set of documents; returns where each result was written.

    Outputs: facts, archive, routed alerts of detectors and rules, compliance events, dead letters
    of four feeds, and all of them as keyed topics. They are published together: a run that stops
    half-way shows in none of them, and a run repeated under its ``run_id`` replaces itself
    (``publish.read_published`` reads an output over all runs).

    Detectors that look back run over the gated readings of this call. Documents are read and
    parsed once into a table in the shared scratch folder, alerts and dead letters into two others;
    every sink reads the columns it needs from there, and a lost executor does not cost a second
    parse.
    """
    config = config or FlowConfig()
    spark = raw.sparkSession
    attempt = publish.begin(spark, out, run_id)
    paths = {n: attempt.path(n) for n in OUTPUTS}

    stages = Stages(_staged(with_parsed(raw), "flow-parsed"), dims, config)
    write_readings(stages.gated, paths["readings"])
    archive_json(stages.enriched, paths["archive"], layout=config.archive_layout)
    alerts = _staged(stages.routed(detect_all(stages.gated, config.detectors)), "flow-alerts")
    events = compliance_events(alerts)
    write_alerts(alerts, paths["alerts"])
    events.withColumn("date", F.to_date("detected_at")).write.mode("append").partitionBy("date").parquet(
        paths["compliance"]
    )
    dead = _staged(stages.dead_letters, "flow-dead")
    write_dlq(dead, paths["dlq"])
    for records in (
        to_keyed_records(stages.parsed.select("body"), [F.lit("raw")], TOPICS["raw"]),
        to_keyed_records(stages.validated.drop("body", "value_text"), ["sensor_id"], TOPICS["validated"]),
        to_keyed_records(stages.enriched, ["sensor_id"], TOPICS["enriched"]),
        to_keyed_records(alerts, ["sensor_id", "anomaly_type"], TOPICS["alert"]),
        to_keyed_records(events, ["platform_id", "report_type"], TOPICS["compliance"]),
        to_keyed_records(dead, ["stage"], TOPICS["dlq"]),
    ):
        write_records(records, paths["topics"])
    publish.commit(spark, attempt)
    return paths
