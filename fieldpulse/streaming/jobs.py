"""Streaming jobs: rollups with watermarks, the ingest flow with its fan-out, sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.functions.times import seconds_of
from fieldpulse.operators.alerts import correlate, with_lifecycle
from fieldpulse.operators.rollup import (
    SERIES,
    compact_latest,
    refresh_rollup_table,
    rollup,
    write_rollup,
)
from fieldpulse.plans.flow import Dimensions, FlowConfig, stateless_stages
from fieldpulse.session import file_system, scratch_dir
from fieldpulse.sources.readers import explode_batch, read_readings
from fieldpulse.sources.reference import REFRESH_POLICIES
from fieldpulse.sources.sinks import (
    ARCHIVE_FOLDERS,
    JSON_OPTIONS,
    to_keyed_records,
    to_reading_rows,
    with_archive_folders,
)

# Micro-batching of the aggregating stage (fixed value).
MERGE_TRIGGER = "5 seconds"


def stream_rollup(
    stream: DataFrame, width: str = "1 minute", lateness: str | None = None, ts: str = "time"
) -> DataFrame:
    """The batch rollup on a stream. A bucket comes out once, when the watermark has passed it.

    By default a reading may be as late as the width's refresh policy looks back.
    """
    if lateness is None:
        lateness = next(
            (start for w, start, _, _ in REFRESH_POLICIES.values() if w == width), "1 day"
        )
    return rollup(stream.withWatermark(ts, lateness), width, ts)


def complete_rollup(
    spark: SparkSession,
    facts: DataFrame,
    streamed: DataFrame,
    path: str,
    width: str = "1 minute",
    ts: str = "time",
    by: Sequence[str] = SERIES,
) -> int:
    """Store a stream's rollup at ``path`` and fill in what its watermark held back or dropped.

    Buckets whose number of readings differs from the facts' bound the range that is refreshed.
    Gives the number of readings that the stream's buckets lacked.
    """
    own = rollup(facts, width, ts, by).select("bucket", *by, F.col("reading_count").alias("n"))
    seen = streamed.select("bucket", *by, (-F.col("reading_count")).alias("n"))
    lacking = own.unionByName(seen).groupBy("bucket", *by).agg(F.sum("n").alias("n")).filter("n <> 0")
    second = F.unix_seconds("bucket")
    found = lacking.agg(F.min(second).alias("low"), F.max(second).alias("high"), F.sum("n").alias("n")).first()
    if found.low is None or not streamed.isEmpty():
        write_rollup(streamed, path)
    if found.low is None:
        return 0
    end = found.high + seconds_of(width)
    policy = (width, f"{end - found.low} seconds", "0 seconds", width)
    as_of = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=end)
    refresh_rollup_table(spark, facts, path, policy, as_of, ts, by)
    return found.n


def start_logged_facts(
    stream: DataFrame,
    facts: str,
    log: str,
    checkpoint: str,
    width: str = "1 minute",
    ts: str = "time",
    trigger: dict | None = None,
) -> StreamingQuery:
    """The fact table fed by a stream, with a log of the rollup buckets that each micro-batch touches.

    Facts lie in ``date`` folders, log entries (date, bucket) in one folder per micro-batch. Both
    are replaced when a micro-batch is repeated, the log first: a bucket may be listed without new
    rows, but no row comes in without its bucket being listed. However late a row is, it only lists
    its own bucket.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            touched = held.select(F.window(ts, width)["start"].alias("bucket")).distinct()
            touched = touched.withColumns({"date": F.to_date("bucket"), "batch_id": F.lit(batch_id)})
            touched.write.partitionBy("batch_id").mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).parquet(log)
            _replace_batch(held.drop("date"), facts, batch_id, F.to_date(ts), "parquet")
        finally:
            held.unpersist()

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": MERGE_TRIGGER}))
        .start()
    )


def refresh_logged(
    spark: SparkSession,
    facts: str,
    log: str,
    path: str,
    width: str = "1 minute",
    ts: str = "time",
    by: Sequence[str] = SERIES,
) -> list[dt.date]:
    """Bring a stored rollup up to date with the log: recompute the listed buckets and rewrite the
    days that hold them, no others. Gives these days.

    Micro-batches that a refresh has dealt with are noted in ``{log}-done`` after the rewrite, so a
    refresh that was interrupted is repeated, with the same result. The days, not the buckets, go
    through the driver; as literals they prune the folders of facts and rollup.
    """
    done = f"{log}-done"
    listed = spark.read.parquet(log)
    store, noted = file_system(spark, done)
    if store.exists(noted):
        listed = listed.join(spark.read.parquet(done), "batch_id", "left_anti")
    staged = scratch_dir(spark, "rollup-listed")
    listed.write.parquet(f"{staged}/log")  # what this refresh deals with, whatever arrives meanwhile
    listed = spark.read.schema(listed.schema).parquet(f"{staged}/log")
    days = sorted(row.date for row in listed.select("date").distinct().collect())
    if not days:
        return []
    buckets = listed.select("bucket").distinct()
    own = F.col("date").isin(days)
    # A bucket lies within one day of facts, as widths divide a day.
    rows = spark.read.parquet(facts).filter(own).withColumn("_bucket", F.window(ts, width)["start"])
    rows = rows.join(buckets.withColumnRenamed("bucket", "_bucket"), "_bucket", "left_semi")
    fresh = rollup(rows, width, ts, by)
    store, target = file_system(spark, path)
    if store.exists(target):
        stored = spark.read.parquet(path).filter(own).drop("date")
        fresh = stored.join(buckets, "bucket", "left_anti").select(fresh.columns).unionByName(fresh)
    write_rollup(fresh, f"{staged}/rollup")
    spark.read.parquet(f"{staged}/rollup").write.partitionBy("date").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
    listed.select("batch_id").distinct().write.mode("append").parquet(done)
    return days


def aggregate_stream(stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """One-minute aggregates as keyed records for the aggregation topic."""
    return to_keyed_records(
        stream_rollup(stream, "1 minute", lateness), ["sensor_id"], "sensor.aggregated"
    )


def stream_correlate(alerts: DataFrame, lateness: str = "1 hour", **options) -> DataFrame:
    """The batch correlation on a stream of alerts."""
    return correlate(alerts.withWatermark("detected_at", lateness), **options)


def start_file_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Exactly-once append to files; ``trigger`` defaults to the 5-second merge interval."""
    writer = stream.writeStream.format(fmt).outputMode("append")
    if fmt == "json":
        writer = writer.options(**JSON_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": MERGE_TRIGGER}))
        .start()
    )


def start_readings_sink(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """The fact table fed by a stream of readings."""
    return start_file_sink(
        to_reading_rows(stream), path, checkpoint, partition_by=("date",), **options
    )


def start_archive_sink(
    stream: DataFrame, path: str, checkpoint: str, ts: str = "time", **options
) -> StreamingQuery:
    """The JSON archive fed by a stream, in the batch archive's folders."""
    return start_file_sink(
        with_archive_folders(stream, ts),
        f"{path}/sensors",
        checkpoint,
        fmt="json",
        partition_by=tuple(ARCHIVE_FOLDERS),
        **options,
    )


def start_dlq_sink(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Dead letters (see ``to_dlq``) fed by a stream."""
    return start_file_sink(
        stream.withColumn("date", F.to_date("failed_at")),
        f"{path}/dlq",
        checkpoint,
        fmt="json",
        partition_by=("stage", "date"),
        **options,
    )


def start_alert_sink(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """The alert table fed by a stream of alerts."""
    rows = with_lifecycle(stream).withColumn("date", F.to_date("detected_at"))
    return start_file_sink(rows, path, checkpoint, partition_by=("date",), **options)


def start_records_sink(
    stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet", **options
) -> StreamingQuery:
    """Keyed records to topic folders or, with its package present, to Kafka.

    ``trigger`` holds for both; Kafka takes no other option.
    """
    if fmt != "kafka":
        return start_file_sink(
            stream, target, checkpoint, fmt=fmt, partition_by=("topic",), **options
        )
    unknown = set(options) - {"trigger"}
    if unknown:
        raise ValueError(f"options without effect on Kafka: {sorted(unknown)}")
    return (
        stream.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(options.pop("trigger", None) or {"processingTime": MERGE_TRIGGER}))
        .start()
    )


def read_compacted(
    spark: SparkSession, path: str, keys: tuple[str, ...], ts: str, tie: tuple[str, ...] = ()
) -> DataFrame:
    """A change log written by a file sink, reduced to the newest row of every key on reading."""
    return compact_latest(spark.read.parquet(path), keys, ts, tie)


def compact_log(
    spark: SparkSession, path: str, target: str, keys: tuple[str, ...], ts: str
) -> None:
    """Write the compacted state of a change log, for readers to start from."""
    read_compacted(spark, path, keys, ts).write.mode("overwrite").parquet(target)


def drain(spark: SparkSession, stream: DataFrame, purpose: str, fmt: str = "parquet") -> DataFrame:
    """Run a stream over what its source holds now and give the written rows as a batch frame."""
    base = scratch_dir(spark, purpose)
    query = start_file_sink(
        stream, f"{base}/out", f"{base}/checkpoint", fmt, trigger={"availableNow": True}
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).format(fmt).load(f"{base}/out")


@dataclass(frozen=True)
class FlowPaths:
    base: str

    def of(self, name: str) -> str:
        return f"{self.base}/{name}"


def _replace_batch(df: DataFrame, path: str, batch_id: int, day: Column, fmt: str) -> None:
    """Write one micro-batch so that repeating it after a failure replaces its own rows."""
    (
        df.withColumns({"date": day, "batch_id": F.lit(batch_id)})
        .write.partitionBy("date", "batch_id")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .save(path)
    )


def fan_out_batch(
    spark: SparkSession, dims: Dimensions, paths: FlowPaths, config: FlowConfig
) -> Callable[[DataFrame, int], None]:
    """What the ingest flow does with one micro-batch: run the stateless stages once and write
    readings, alerts, compliance events and dead letters from them."""

    def process(batch: DataFrame, batch_id: int) -> None:
        stages = stateless_stages(batch, dims, config)
        held = [stages.parsed.persist()]
        stages = stages.rebuild(held[0])
        try:
            _replace_batch(
                stages.reading_rows.drop("date"),
                paths.of("readings"),
                batch_id,
                F.to_date("time"),
                "parquet",
            )
            _replace_batch(
                stages.alerts, paths.of("alerts"), batch_id, F.to_date("detected_at"), "parquet"
            )
            _replace_batch(
                stages.compliance,
                paths.of("compliance"),
                batch_id,
                F.to_date("detected_at"),
                "parquet",
            )
            _replace_batch(
                stages.dead_letters, paths.of("dlq"), batch_id, F.to_date("failed_at"), "json"
            )
        finally:
            for frame in held:
                frame.unpersist()

    return process


def start_flow(
    spark: SparkSession,
    source: str,
    dims: Dimensions,
    out: str,
    checkpoint: str,
    config: FlowConfig | None = None,
    max_files: int | None = 100,
    trigger: dict | None = None,
    max_bytes: str | None = None,
) -> StreamingQuery:
    """The ingest flow as a stream over landed JSON files."""
    config = config or FlowConfig()
    source_rows = read_readings(spark, source, streaming=True, max_files=max_files, max_bytes=max_bytes)
    raw = explode_batch(source_rows)
    return (
        raw.writeStream.foreachBatch(fan_out_batch(spark, dims, FlowPaths(out), config))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": MERGE_TRIGGER}))
        .start()
    )
