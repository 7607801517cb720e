"""The six record contracts and conformance to them."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.times import normalize_ts

# Enumerations of the contracts.
PLATFORM_CODES = ("ALPHA", "BRAVO", "CHARLIE", "DELTA", "ECHO")
SENSOR_TYPES = ("temperature", "pressure", "vibration", "flow_rate")
QUALITY_FLAGS = ("GOOD", "UNCERTAIN", "BAD")
VALIDATION_STATUSES = ("PASSED", "WARNING", "FAILED")
ANOMALY_TYPES = (
    "threshold_exceeded",
    "threshold_warning",
    "moving_average_deviation",
    "rate_of_change_spike",
    "multi_sensor_correlation",
)
SEVERITIES = ("INFO", "WARNING", "CRITICAL")
HEALTH_STATUSES = ("HEALTHY", "DEGRADED", "WARNING", "CRITICAL", "OFFLINE")
EMISSION_TYPES = ("CO2", "NOx", "SOx", "CH4", "VOC", "PM")

# Spellings of the simulated sensors and of the reference tables.
UNIT_ALIASES = {"degC": "celsius", "mm/s": "mm_s", "m3/h": "m3_h"}
QUALITY_ALIASES = {"SUSPECT": "UNCERTAIN"}


@dataclass(frozen=True)
class ContractField:
    name: str
    type: T.DataType
    enum: tuple[str, ...] | None = None
    default: Any = None
    nullable: bool = False


@dataclass(frozen=True)
class Contract:
    """Named record layout; ``topic`` is the keyed topic the records travel on."""

    name: str
    topic: str
    fields: tuple[ContractField, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, True) for f in self.fields])

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _text(name: str, **kw) -> ContractField:
    return ContractField(name, T.StringType(), **kw)


def _double(name: str, **kw) -> ContractField:
    return ContractField(name, T.DoubleType(), **kw)


def _time(name: str, **kw) -> ContractField:
    return ContractField(name, T.TimestampType(), **kw)


_READING = (
    _text("reading_id"),
    _text("platform_id"),
    _text("sensor_id"),
    _text("sensor_type"),
    _double("value"),
    _text("unit"),
    _time("timestamp"),
    _text("quality_flag", default="GOOD"),
)

READING = Contract(
    "reading",
    "sensor.raw",
    (
        _text("reading_id"),
        _text("platform_id", enum=PLATFORM_CODES),
        _text("sensor_id"),
        _text("sensor_type", enum=SENSOR_TYPES),
        _double("value"),
        _text("unit"),
        _time("timestamp"),
        _text("quality_flag", enum=QUALITY_FLAGS, default="GOOD"),
    ),
)
VALIDATED = Contract(
    "validated",
    "sensor.validated",
    _READING
    + (
        _text("validation_status", enum=VALIDATION_STATUSES),
        _time("validated_at"),
        ContractField("schema_version", T.IntegerType(), default=1),
    ),
)
ENRICHED = Contract(
    "enriched",
    "sensor.enriched",
    _READING
    + (
        _text("validation_status"),
        _time("validated_at"),
        ContractField("schema_version", T.IntegerType(), default=1),
        _text("equipment_name"),
        _text("equipment_type"),
        _text("platform_name"),
        _double("latitude"),
        _double("longitude"),
        _text("region"),
        _time("enriched_at"),
    ),
)
ALERT = Contract(
    "alert",
    "alerts.critical",
    (
        _text("alert_id"),
        _text("sensor_id"),
        _text("platform_id"),
        _text("anomaly_type", enum=ANOMALY_TYPES),
        _text("severity", enum=SEVERITIES),
        _double("actual_value"),
        _double("threshold_value"),
        _text("sensor_type"),
        _text("unit"),
        _text("description"),
        _time("detected_at"),
        _text("reading_id"),
    ),
)
EQUIPMENT_STATUS = Contract(
    "equipment_status",
    "equipment.status",
    (
        _text("equipment_id"),
        _text("platform_id"),
        _text("equipment_name"),
        _text("equipment_type"),
        _text("status", enum=HEALTH_STATUSES),
        _double("health_score"),
        _time("last_maintenance", nullable=True),
        _double("hours_since_maintenance"),
        _time("assessed_at"),
    ),
)
EMISSION = Contract(
    "emission",
    "compliance.emissions",
    (
        _text("measurement_id"),
        _text("platform_id"),
        _text("emission_type", enum=EMISSION_TYPES),
        _double("value_ppm"),
        _double("limit_ppm"),
        ContractField("compliant", T.BooleanType()),
        _time("measured_at"),
        _text("reporting_period"),
    ),
)
CONTRACTS = {
    c.name: c for c in (READING, VALIDATED, ENRICHED, ALERT, EQUIPMENT_STATUS, EMISSION)
}


def replace_aliases(value: Column, aliases: dict[str, str]) -> Column:
    chosen = None
    for old, new in aliases.items():
        chosen = (
            F.when(value == old, F.lit(new)) if chosen is None else chosen.when(value == old, new)
        )
    return chosen.otherwise(value)


def normalize_vocabulary(df: DataFrame) -> DataFrame:
    """Lower-case sensor types, canonical units, SUSPECT quality read as UNCERTAIN."""
    fixes = {}
    if "sensor_type" in df.columns:
        fixes["sensor_type"] = F.lower("sensor_type")
    if "unit" in df.columns:
        fixes["unit"] = replace_aliases(F.col("unit"), UNIT_ALIASES)
    if "quality_flag" in df.columns:
        fixes["quality_flag"] = replace_aliases(F.col("quality_flag"), QUALITY_ALIASES)
    return df.withColumns(fixes)


def _converted(df: DataFrame, field: ContractField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.type)
    source = df.schema[field.name].dataType
    if source == field.type:
        return F.col(field.name)
    if isinstance(field.type, T.TimestampType):
        if isinstance(source, T.TimestampNTZType):
            return F.col(field.name).cast("timestamp")
        return normalize_ts(F.col(field.name))
    return F.col(field.name).try_cast(field.type)


def conform(
    df: DataFrame,
    contract: Contract,
    enums: dict[str, tuple[str, ...] | None] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Contract columns in contract order plus ``violations``, a list of ``kind:field``.

    Extra input fields are ignored unless named in ``keep``; absent fields with a default
    take it. ``enums`` replaces (or, with ``None``, lifts) the value list of single fields,
    for sites with platform codes of their own.
    """
    enums = enums or {}
    columns, checks = [], []
    for field in contract.fields:
        value = _converted(df, field)
        if field.name in df.columns:
            present = F.col(field.name).isNotNull()
            checks.append(F.when(present & value.isNull(), F.lit(f"type:{field.name}")))
        else:
            present = F.lit(False)
        if field.default is not None:
            value = F.coalesce(value, F.lit(field.default).cast(field.type))
        elif not field.nullable:
            checks.append(F.when(~present, F.lit(f"missing:{field.name}")))
        allowed = enums.get(field.name, field.enum)
        if allowed:
            checks.append(
                F.when(value.isNotNull() & ~value.isin(*allowed), F.lit(f"enum:{field.name}"))
            )
        columns.append(value.alias(field.name))
    return df.select(
        *columns, *[F.col(k) for k in keep], F.array_compact(F.array(*checks)).alias("violations")
    )


def fill_defaults(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns of the contract from an older or wider table, absent ones defaulted or null."""
    columns = []
    for field in contract.fields:
        value = _converted(df, field)
        if field.default is not None:
            value = F.coalesce(value, F.lit(field.default).cast(field.type))
        columns.append(value.alias(field.name))
    return df.select(*columns)
