"""Timestamp parsing and bucketing."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Numbers below this are epoch seconds, others epoch milliseconds (fixed value).
SECONDS_BELOW = 1e12

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def once(df: DataFrame, name: str, columns: dict[str, Column]) -> DataFrame:
    """Add a struct of columns that are computed once per row, in compiled code of their own.

    It sits behind a one-element ``explode``: the optimiser copies no expression across it, and each
    such step becomes a method of the generated code. One method above 8,000 bytes is never compiled
    by the JVM but interpreted, for every row; many long expressions are therefore split over steps.
    """
    struct = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.explode(F.array(struct)).alias(name))


def seconds_of(width: str) -> int:
    """Length of a width such as ``'15 minutes'`` in seconds."""
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", width)
    if not match:
        raise ValueError(f"not a width: {width!r}")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)]


# Times that a table may hold, in epoch milliseconds: the years 1 to 9999.
EARLIEST, LATEST = -62_135_596_800_000, 253_402_300_799_999


def _held(millis: Column) -> Column:
    return F.when(millis.between(EARLIEST, LATEST), millis)


def scaled_millis(number: Column) -> Column:
    """Epoch milliseconds from a number of seconds or milliseconds, null outside the years 1 to 9999."""
    seconds = F.when(number.between(EARLIEST / 1000, LATEST / 1000), number.try_cast("bigint"))
    millis = F.when(number.between(EARLIEST, LATEST), number.try_cast("bigint"))
    return F.when(number < SECONDS_BELOW, F.try_multiply(seconds, F.lit(1000))).otherwise(millis)


def iso_to_millis(text: Column, number: Column) -> Column:
    """Epoch milliseconds from a text that is no number."""
    return F.when(number.isNull(), F.unix_millis(F.try_to_timestamp(text)))


def either_millis(scaled: Column, iso: Column) -> Column:
    """The time of a number (within bounds already) or of an ISO-8601 text."""
    return F.coalesce(scaled, _held(iso))


def epoch_millis(raw: Column) -> Column:
    """Epoch milliseconds from text holding seconds, milliseconds or an ISO-8601 instant.

    Fractions are cut off before scaling. Anything else, and any time outside the years 1 to
    9999, is null, never an error and never the wall clock.
    """
    text = raw.cast("string")
    number = text.try_cast("double")
    return either_millis(scaled_millis(number), iso_to_millis(text, number))


def normalize_ts(raw: Column) -> Column:
    """Timestamp from a raw text or numeric time; null when it cannot be read."""
    return F.timestamp_millis(epoch_millis(raw))


def iso_millis(ts: Column) -> Column:
    """ISO-8601 text with milliseconds; relies on the UTC session time zone."""
    return F.date_format(ts, ISO_MILLIS)


def epoch_to_iso(df: DataFrame, source: str = "timestamp", target: str = "time") -> DataFrame:
    """Replace an epoch-milliseconds column by its ISO-8601 UTC text; null if it is no such time."""
    text = iso_millis(F.timestamp_millis(_held(F.col(source).try_cast("bigint"))))
    return df.withColumn(target, text).drop(source)


def rewrite_epoch_in_text(body: Column) -> Column:
    """The same on a JSON document kept as text: ``"timestamp": 1700…`` → ``"time":"2023-…Z"``."""
    digits = F.regexp_extract(body, r'"timestamp"\s*:\s*(\d+)', 1)
    iso = iso_millis(F.timestamp_millis(_held(digits.try_cast("bigint"))))
    replacement = F.concat(F.lit('"time":"'), iso, F.lit('"'))
    return F.when(
        iso.isNotNull(), F.regexp_replace(body, F.lit(r'"timestamp"\s*:\s*\d+'), replacement)
    ).otherwise(body)


def instant(as_of: str | dt.datetime) -> Column:
    """Literal timestamp for an ``as_of`` argument."""
    return F.lit(as_of).cast("timestamp")


def seconds_between(start: Column, end: Column) -> Column:
    """Difference in seconds as a double with microsecond precision."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def since(df: DataFrame, as_of, lookback: str, ts: str = "time") -> DataFrame:
    """Rows not older than ``as_of - lookback``.

    Where the table is partitioned by ``date`` the same bound is repeated on that column,
    so that whole partitions are skipped before any file is opened.
    """
    bound = instant(as_of) - F.expr(f"INTERVAL {lookback}")
    kept = df.filter(F.col(ts) >= bound)
    if "date" in df.columns:
        kept = kept.filter(F.col("date") >= bound.cast("date"))
    return kept
