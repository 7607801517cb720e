"""Typed parsing with the failures kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.times import either_millis, iso_to_millis, once, scaled_millis
from fieldpulse.sources.readers import with_document

FIELDS = (
    "reading_id",
    "platform_id",
    "sensor_id",
    "sensor_type",
    "value",
    "unit",
    "timestamp",
    "quality_flag",
    "quality_score",
)

# Fixed value: what counts as a number written as text, single underscores between digits allowed.
NUMBER = (
    r"(?i)^\s*[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?"
    r"|inf(inity)?|nan)\s*$"
)


def _bared(raw: Column) -> Column:
    return F.trim(F.btrim(raw, F.lit('"')))


def _number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), F.regexp_replace(text, "_", "").try_cast("double"))


def to_number(raw: Column) -> Column:
    """Double from text; null for anything that is not wholly a number."""
    return _number(_bared(raw))


def _bare(body: Column, field: str, literal: str) -> Column:
    """The document holds this field as an unquoted literal."""
    return body.rlike(rf'"{field}"\s*:\s*{literal}\s*[,}}]')


def with_parsed(
    df: DataFrame, col: str = "body", require_sensor: bool = True, require_time: bool = True
) -> DataFrame:
    """Typed reading columns next to the document, and ``error_reason``/``error_text``.

    The checks run in order - unreadable document, sensor id missing (empty text, 0 and false
    count as missing), value missing, value not a number, time unreadable - and the first
    failure names the row. JSON booleans are numbers, numbers may be written as text.

    Numbers, time and the test of the sensor id are computed in steps of their own (``once``), like
    the document itself: each is evaluated once however many filters and outputs ask for the
    reason, which only looks at their results.
    """
    body = F.col(col)
    doc = with_document(df, FIELDS, col)
    field = {name: F.col("_doc")[name] for name in FIELDS}

    value_text, time_text = field["value"], field["timestamp"]
    is_bool = value_text.isin("true", "false") & _bare(body, "value", "(true|false)")

    sensor_text = field["sensor_id"]
    falsy = sensor_text.isin("0", "0.0", "-0", "false") & _bare(
        body, "sensor_id", r"(-?0(\.0+)?|false)"
    )
    empty = sensor_text.isin("", "[]", "{}")

    read = {
        "value": _bared(value_text),
        "quality_score": _bared(field["quality_score"]),
        "time": time_text.try_cast("double"),
        "unnamed": sensor_text.isNull() | empty | falsy,
    }
    doc = once(doc, "_read", read)
    read = {name: F.col("_read")[name] for name in read}
    numbers = {
        "value": F.when(is_bool, (value_text == "true").cast("double")).otherwise(_number(read["value"])),
        "quality_score": _number(read["quality_score"]),
        "scaled": scaled_millis(read["time"]),
        "iso": iso_to_millis(time_text, read["time"]),
    }
    doc = once(doc, "_numbers", numbers)
    numbers = {name: F.col("_numbers")[name] for name in numbers}
    doc = once(doc, "_at", {"time": F.timestamp_millis(either_millis(numbers["scaled"], numbers["iso"]))})
    typed = {
        "value": numbers["value"],
        "time": F.col("_at")["time"],
        "quality_score": numbers["quality_score"],
        "unnamed": read["unnamed"],
    }
    checks: list[tuple[Column, str, Column]] = [
        (F.col("_doc").isNull(), "invalid_json", F.lit("not a JSON object"))
    ]
    if require_sensor:
        checks.append((typed["unnamed"], "missing_sensor_id", F.lit("no sensor_id")))
    checks += [
        (value_text.isNull(), "missing_value", F.lit("no value")),
        (
            typed["value"].isNull(),
            "non_numeric_value",
            F.concat(F.lit("not a number: "), value_text),
        ),
    ]
    if require_time:
        checks.append(
            (
                typed["time"].isNull(),
                "bad_timestamp",
                F.concat(F.lit("no time: "), F.coalesce(time_text, F.lit(""))),
            )
        )
    return doc.withColumns(
        {
            **{n: field[n] for n in FIELDS if n not in ("value", "timestamp", "quality_score")},
            "value": typed["value"],
            "value_text": value_text,
            "time": typed["time"],
            "quality_score": typed["quality_score"],
            "error_reason": first_match(checks, 1),
            "error_text": first_match(checks, 2),
        }
    ).withColumn(
        "severity", F.when(F.col("error_reason").isNotNull(), F.lit("UNKNOWN"))
    ).drop("_doc", "_read", "_numbers", "_at")


def first_match(checks, position: int) -> Column:
    chosen = None
    for check in checks:
        result = check[position]
        result = result if isinstance(result, Column) else F.lit(result)
        chosen = F.when(check[0], result) if chosen is None else chosen.when(check[0], result)
    return chosen


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by ``error_reason``; the good side loses the error columns."""
    good = df.filter(F.col("error_reason").isNull()).drop("error_reason", "error_text", "severity")
    return good, df.filter(F.col("error_reason").isNotNull())


def parse_reading(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(readings, rejects) of raw documents; see :func:`with_parsed`."""
    return split_errors(with_parsed(df, **options))
