"""Sinks: fact table, archives, keyed topics, dead letters, CSV."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.times import instant
from fieldpulse.sources.contracts import Contract, fill_defaults

# Columns of the reading table.
READING_COLUMNS = {
    "time": "timestamp",
    "reading_id": "string",
    "platform_id": "string",
    "sensor_id": "string",
    "sensor_type": "string",
    "value": "double",
    "unit": "string",
    "quality_flag": "string",
}


@dataclass(frozen=True)
class Topic:
    name: str
    partitions: int
    retention_days: int
    compacted: bool = False


# Topics with their partition counts and retention.
TOPICS = {
    t.name: t
    for t in (
        Topic("sensor.raw", 5, 7),
        Topic("sensor.validated", 5, 3),
        Topic("sensor.enriched", 5, 3),
        Topic("sensor.aggregated", 3, 30),
        Topic("alerts.critical", 1, 90),
        Topic("equipment.status", 5, 30, compacted=True),
        Topic("compliance.emissions", 3, 365, compacted=True),
        Topic("sensor.dlq", 5, 7),
    )
}


def to_reading_rows(df: DataFrame, truncate: str | None = None) -> DataFrame:
    """Columns of the reading table plus its ``date`` partition; other fields are dropped.

    ``truncate='second'`` drops the milliseconds of the event time.
    """
    columns = []
    for name, dtype in READING_COLUMNS.items():
        value = F.col(name) if name in df.columns else F.lit(None)
        value = value.cast(dtype)
        if name == "quality_flag":
            value = F.coalesce(value, F.lit("GOOD"))
        if name == "time" and truncate:
            value = F.date_trunc(truncate, value)
        columns.append(value.alias(name))
    rows = df.select(*columns)
    return rows.withColumn("date", F.to_date("time"))


def _spread(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows range-partitioned and sorted, so that each output folder gets few, sorted files.

    Ranges over partition column, key and time cut a hot day or a hot key into as many tasks
    as it needs, where hashing on the folder alone would give it to one.
    """
    if df.isStreaming:
        return df
    return df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)


def write_readings(
    df: DataFrame, path: str, mode: str = "append", truncate: str | None = None
) -> None:
    """Append to the fact table, partitioned by day and sorted by sensor and time in files."""
    rows = to_reading_rows(df, truncate)
    _spread(rows, ["date"], ["sensor_id", "time"]).write.partitionBy("date").mode(mode).parquet(
        path
    )


def write_csv_readings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Back-fill files with a header; time as epoch milliseconds."""
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.unix_millis("time"))
    df.select(
        "reading_id",
        "platform_id",
        "sensor_id",
        "sensor_type",
        "value",
        "unit",
        F.col("timestamp").cast("bigint").alias("timestamp"),
        "quality_flag",
    ).write.mode(mode).option("header", True).csv(path)


ARCHIVE_FOLDERS = ["platform", "type", "year", "month", "day", "hour"]
PARQUET_FOLDERS = ["platform", "year", "month", "day"]

# JSON files keep microseconds; the writer's default would cut them to milliseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def with_archive_folders(df: DataFrame, ts: str = "time") -> DataFrame:
    return df.withColumns(
        {
            "platform": F.col("platform_id"),
            "type": F.col("sensor_type"),
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
            "hour": F.date_format(ts, "HH"),
        }
    )


def archive_json(
    df: DataFrame, path: str, ts: str = "time", mode: str = "append", layout: str = "full"
) -> None:
    """One JSON document per reading below ``sensors/platform/type/yyyy/MM/dd/HH``.

    ``layout='date'`` leaves out platform and type.
    """
    folders = ARCHIVE_FOLDERS if layout == "full" else ARCHIVE_FOLDERS[2:]
    rows = with_archive_folders(df, ts).drop(*set(ARCHIVE_FOLDERS) - set(folders))
    _spread(rows, folders, ["sensor_id", ts]).write.partitionBy(*folders).mode(mode).options(
        **JSON_OPTIONS
    ).json(f"{path}/sensors")


def archive_parquet(df: DataFrame, path: str, ts: str = "time", mode: str = "append") -> None:
    """The same as Parquet, below ``sensors/platform/yyyy/MM/dd``: columnar files want to be
    larger than one sensor type and hour, so these are the sort order instead of folders."""
    rows = with_archive_folders(df, ts).drop("type", "hour")
    _spread(rows, PARQUET_FOLDERS, ["sensor_type", "sensor_id", ts]).write.partitionBy(
        *PARQUET_FOLDERS
    ).mode(mode).parquet(f"{path}/sensors")


def to_keyed_records(
    df: DataFrame, key: Sequence[str | Column], topic: str | None = None, keep_nulls: bool = True
) -> DataFrame:
    """``key`` (parts joined by a dash) and ``value`` (the row as JSON), for a keyed topic."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    columns = [
        F.concat_ws("-", *parts).alias("key"),
        F.to_json(F.struct(*df.columns), options).alias("value"),
    ]
    if topic:
        columns.append(F.lit(topic).alias("topic"))
    return df.select(*columns)


def write_records(
    records: DataFrame, target: str, fmt: str = "parquet", mode: str = "append", **options: str
) -> None:
    """Keyed records to files below ``topic=…`` or, with its package present, to Kafka."""
    if fmt == "kafka":
        records.write.format("kafka").option("kafka.bootstrap.servers", target).options(
            **options
        ).save()
        return
    writer = records.write.mode(mode).options(**options)
    if "topic" in records.columns:
        writer = writer.partitionBy("topic")
    writer.format(fmt).save(target)


def convert(
    df: DataFrame, contract: Contract, path: str, fmt: str = "json", mode: str = "overwrite"
) -> None:
    """Rows in the layout of a contract, written as JSON, Parquet or (package present) Avro."""
    writer = fill_defaults(df, contract).write.mode(mode)
    if fmt == "json":
        writer = writer.options(**JSON_OPTIONS)
    writer.format(fmt).save(path)


DLQ_COLUMNS = ("stage", "error_reason", "error_text", "sensor_id", "platform_id", "body")


ARRIVAL_TIMES = ("received_at", "ingested_at", "time", "detected_at")


def to_dlq(
    df: DataFrame, stage: Column | str, failed_at: Column | str | None = None
) -> DataFrame:
    """Rejected rows in the common dead-letter layout.

    ``body`` is the original document where there is one, else the row as JSON. ``failed_at``
    is a column, a literal time or, left out, the row's arrival or event time, so that a
    repeated batch writes to the same folders; null where a row has none.
    """
    if failed_at is None:
        known = [F.col(c).cast("timestamp") for c in ARRIVAL_TIMES if c in df.columns]
        failed_at = F.coalesce(*known) if known else F.lit(None)
    at = failed_at if isinstance(failed_at, Column) else instant(failed_at)
    body = F.col("body") if "body" in df.columns else F.to_json(F.struct(*df.columns))
    columns = {"stage": stage if isinstance(stage, Column) else F.lit(stage), "body": body}
    for name in DLQ_COLUMNS:
        if name not in columns:
            columns[name] = F.col(name) if name in df.columns else F.lit(None)
    return df.select(
        *[columns[n].cast("string").alias(n) for n in DLQ_COLUMNS],
        at.cast("timestamp").alias("failed_at"),
    )


def write_dlq(df: DataFrame, path: str, mode: str = "append") -> None:
    """Dead letters as JSON below ``dlq/stage=…/date=…``."""
    rows = df.withColumn("date", F.to_date("failed_at"))
    _spread(rows, ["stage", "date"], [F.xxhash64("body")]).write.partitionBy("stage", "date").mode(
        mode
    ).options(**JSON_OPTIONS).json(f"{path}/dlq")


def fan_out(df: DataFrame, writers: Sequence) -> None:
    """Run several writers over one frame, computing it once."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in writers:
            write(held)
    finally:
        held.unpersist()
