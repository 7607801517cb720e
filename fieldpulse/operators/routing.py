"""Routing: one row to every matching route, severity priorities, compliance filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.guards import above, below

UNMATCHED = "unmatched"

# Limits of the domain rules.
RULE_LIMITS = {
    "temperature_high": 150.0,
    "temperature_low": -40.0,
    "pressure_high": 5000.0,
    "pressure_low": 0.0,
    "flow_high": 10000.0,
    "quality_low": 0.5,
}

# What is stamped on an alert of each severity.
SEVERITY_ROUTES = {"CRITICAL": ("P1", "true", "pagerduty"), "WARNING": ("P2", "true", "slack")}

# Compliance filter and the framework its events are reported under.
EMISSION_SENSOR_TYPES = ("gas_emission", "h2s_concentration")
FRAMEWORK = "EPA-40CFR98"

# Fields of the published alert document.
ALERT_DOCUMENT = (
    "sensor_id",
    "platform_id",
    "sensor_type",
    "value",
    "unit",
    "anomaly.type",
    "anomaly.severity",
    "anomaly.timestamp",
    "alert.priority",
    "alert.channel",
)


def route_all(
    df: DataFrame,
    routes: Mapping[str, Column],
    col: str = "route",
    keep_unmatched: bool = True,
) -> DataFrame:
    """A copy of the row for every route whose predicate is true, else one ``unmatched``."""
    hits = F.array_compact(
        F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in routes.items()])
    )
    if keep_unmatched:
        hits = F.when(F.size(hits) == 0, F.array(F.lit(UNMATCHED))).otherwise(hits)
    return df.withColumn(col, F.explode(hits))


def route_if_all(df: DataFrame, predicates: Mapping[str, Column], col: str = "route") -> DataFrame:
    """``matched`` where every predicate is true, else ``unmatched``."""
    every = reduce(and_, (F.coalesce(p, F.lit(False)) for p in predicates.values()))
    return df.withColumn(col, F.when(every, "matched").otherwise(UNMATCHED))


def domain_rules(limits: Mapping[str, float] | None = None) -> dict[str, Column]:
    """Predicates over ``sensor_type``, ``value`` and ``quality_score``."""
    lim = {**RULE_LIMITS, **(limits or {})}
    kind, value = F.lower("sensor_type"), F.col("value")
    return {
        "temperature_anomaly": (kind == "temperature")
        & (above(value, lim["temperature_high"]) | below(value, lim["temperature_low"])),
        "pressure_anomaly": (kind == "pressure")
        & (above(value, lim["pressure_high"]) | below(value, lim["pressure_low"])),
        "flow_anomaly": (kind == "flow_rate") & above(value, lim["flow_high"]),
        "quality_anomaly": below(F.col("quality_score"), lim["quality_low"]),
    }


def rule_anomalies(
    df: DataFrame,
    limits: Mapping[str, float] | None = None,
    detected_at: Column | None = None,
    keep_normal: bool = False,
) -> DataFrame:
    """Rows breaking a domain rule, one per broken rule, all of severity WARNING."""
    routed = route_all(df, domain_rules(limits), "anomaly_type", keep_unmatched=keep_normal)
    hit = F.col("anomaly_type") != UNMATCHED
    return routed.withColumns(
        {
            "anomaly_detected": hit,
            "severity": F.when(hit, "WARNING"),
            "detected_at": F.when(hit, F.col("time") if detected_at is None else detected_at),
            "stage": F.when(hit, "anomaly-detected").otherwise("analyzed"),
        }
    )


def route_severity(df: DataFrame, col: str = "severity") -> DataFrame:
    """Route name, priority, notify flag and channel; INFO and others pass unstamped."""
    severity = F.col(col)
    route = F.when(severity.isin("CRITICAL", "WARNING", "INFO"), F.lower(severity))
    stamps: dict[str, Column] = {"severity_route": F.coalesce(route, F.lit(UNMATCHED))}
    for position, name in enumerate(("priority", "notify", "channel")):
        chosen = None
        for level, values in SEVERITY_ROUTES.items():
            test, value = severity == level, F.lit(values[position])
            chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
        stamps[name] = chosen
    return df.withColumns(stamps)


def alert_to_json(df: DataFrame, col: str = "document") -> DataFrame:
    """The ten published fields of an alert as one JSON document; absent ones are empty text."""
    source = {
        "anomaly.type": "anomaly_type",
        "anomaly.severity": "severity",
        "anomaly.timestamp": "detected_at",
        "alert.priority": "priority",
        "alert.channel": "channel",
    }
    fields = []
    for name in ALERT_DOCUMENT:
        value = F.col(source.get(name, name))
        if name == "anomaly.timestamp":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS")
        fields.append(F.coalesce(value.cast("string"), F.lit("")).alias(name))
    return df.withColumn(col, F.to_json(F.struct(*fields)))


def compliance_events(df: DataFrame, reported_at: Column | None = None) -> DataFrame:
    """Emission readings and safety-critical alerts; a row that is both appears twice."""
    kind = F.lower("sensor_type")
    routes = {
        "emission_event": kind.isin(*EMISSION_SENSOR_TYPES),
        "safety_event": F.col("severity") == "CRITICAL",
    }
    return route_all(df, routes, "report_type", keep_unmatched=False).withColumns(
        {
            "regulatory_framework": F.lit(FRAMEWORK),
            "reported_at": F.col("detected_at") if reported_at is None else reported_at,
            "stage": F.lit("compliance"),
        }
    )


def split_by(df: DataFrame, col: str, values: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per named value, the rest (and null) under ``unmatched``."""
    parts = {v: df.filter(F.col(col) == v) for v in values}
    parts[UNMATCHED] = df.filter(~F.coalesce(F.col(col).isin(*values), F.lit(False)))
    return parts


def union_dlq(*frames: DataFrame) -> DataFrame:
    """All rejects in one frame, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
