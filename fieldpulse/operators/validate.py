"""Stage stamps, schema and range validation, the quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.guards import is_filled
from fieldpulse.functions.times import instant
from fieldpulse.operators.routing import route_if_all
from fieldpulse.sources.contracts import READING, Contract, conform

REQUIRED = ("sensor_id", "platform_id", "value")


def stamp(df: DataFrame, stage: str, at: Column | str | None = None, **constants) -> DataFrame:
    """Mark rows with a stage name, its time and constants; ``at`` replaces the wall clock."""
    when = F.current_timestamp() if at is None else at if isinstance(at, Column) else instant(at)
    return df.withColumns(
        {
            **{name: F.lit(value) for name, value in constants.items()},
            "stage": F.lit(stage),
            f"{stage}_at": when,
        }
    )


def schema_outcome(
    df: DataFrame, contract: Contract = READING, keep: tuple[str, ...] = (), **options
) -> DataFrame:
    """Contract columns with ``violations``, and the reason and text of a failure or null.

    One pass; :func:`validate_schema` gives the two sides apart.
    """
    checked = conform(df, contract, keep=keep, **options)
    bad = F.size("violations") > 0
    return checked.withColumns(
        {
            "error_reason": F.when(bad, F.lit("schema_violation")),
            "error_text": F.when(bad, F.concat_ws(", ", "violations")),
        }
    )


def validate_schema(
    df: DataFrame, contract: Contract = READING, keep: tuple[str, ...] = (), **options
) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) against a contract; the invalid side lists its violations."""
    checked = schema_outcome(df, contract, keep, **options)
    valid = checked.filter(F.col("error_reason").isNull())
    return valid.drop("violations", "error_reason", "error_text"), checked.filter(
        F.col("error_reason").isNotNull()
    )


def gate_error(required: tuple[str, ...] = REQUIRED) -> tuple[Column, Column]:
    """(reason, text) where a required field holds nothing, else null."""
    gaps = F.array_compact(F.array(*[F.when(~is_filled(F.col(c)), F.lit(c)) for c in required]))
    empty = F.size(gaps) > 0
    return F.when(empty, F.lit("quality_gate")), F.when(
        empty, F.concat(F.lit("Empty: "), F.concat_ws(", ", gaps))
    )


def gate_outcome(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """All rows with ``error_reason`` and ``error_text`` of the gate, null where it lets pass."""
    reason, text = gate_error(required)
    return df.withColumns({"error_reason": reason, "error_text": text})


def quality_gate(
    df: DataFrame, required: tuple[str, ...] = REQUIRED
) -> tuple[DataFrame, DataFrame]:
    """(passed, failed): all required fields must hold something."""
    judged = gate_outcome(df, required)
    passed = judged.filter(F.col("error_reason").isNull()).drop("error_reason", "error_text")
    return passed, judged.filter(F.col("error_reason").isNotNull())


def validate_range(
    df: DataFrame,
    sensors: DataFrame,
    at: Column | str | None = None,
    schema_version: int = 1,
) -> DataFrame:
    """PASSED inside the sensor's physical range, FAILED outside it or without a value,
    WARNING for NaN and for sensors without a known range."""
    ranges = sensors.select("sensor_id", "min_range", "max_range")
    value, low, high = F.col("value"), F.col("min_range"), F.col("max_range")
    status = (
        F.when(value.isNull(), "FAILED")
        .when(F.isnan(value), "WARNING")
        .when(low.isNull() & high.isNull(), "WARNING")
        .when((value < low) | (value > high), "FAILED")
        .otherwise("PASSED")
    )
    when = F.col("time") if at is None else at if isinstance(at, Column) else instant(at)
    return (
        df.join(ranges, "sensor_id", "left")
        .withColumns(
            {
                "validation_status": status,
                "validated_at": when,
                "schema_version": F.lit(schema_version),
            }
        )
        .drop("min_range", "max_range")
    )
