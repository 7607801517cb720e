"""Time-bucket rollups, their incremental refresh, retention and rates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldpulse.functions.times import instant, seconds_between, seconds_of, since
from fieldpulse.operators.sequence import extreme_rows
from fieldpulse.session import file_system, scratch_dir
from fieldpulse.sources.reference import REFRESH_POLICIES

SERIES = ("platform_id", "sensor_id", "sensor_type")
MEASURES = ("avg_value", "min_value", "max_value", "reading_count", "stddev_value")


def rollup(
    df: DataFrame, width: str = "1 minute", ts: str = "time", by: Sequence[str] = SERIES
) -> DataFrame:
    """Average, extremes, count and sample deviation per time bucket and series.

    All measures merge, so rows are combined before the shuffle. On a stream, set the
    watermark first.
    """
    return (
        df.groupBy(F.window(ts, width).alias("_w"), *by)
        .agg(
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.count(F.lit(1)).alias("reading_count"),
            F.stddev_samp("value").alias("stddev_value"),
        )
        .select(F.col("_w.start").alias("bucket"), *by, *MEASURES)
    )


def rollup_of_rollup(agg: DataFrame, width: str, by: Sequence[str] = SERIES) -> DataFrame:
    """A coarser rollup computed from a finer one, without going back to the readings.

    The squared deviations of the parts add up with the spread of their means. Means are taken
    relative to the smallest value of the coarse bucket before they are squared, so that large
    values lose no digits of a small spread. Both steps share one partitioning by bucket and
    series; the second only runs over the finer buckets of each coarse one.
    """
    n = F.col("reading_count")
    own = F.coalesce(F.col("stddev_value"), F.lit(0.0))
    together = Window.partitionBy("_w", *by)
    near = F.col("avg_value") - F.min("min_value").over(together)
    parts = agg.withColumn("_w", F.window("bucket", width)).withColumn("_near", near)
    merged = parts.groupBy("_w", *by).agg(
        F.sum(n).alias("reading_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum(F.col("_near") * n).alias("_sum"),
        F.sum(own * own * (n - 1)).alias("_m2"),
        F.sum(F.col("_near") * F.col("_near") * n).alias("_mean_sq"),
    )
    total = F.col("reading_count")
    spread = F.col("_m2") + F.col("_mean_sq") - F.col("_sum") * F.col("_sum") / total
    # Only rounding, far below the spread itself, can make the difference negative.
    flat = F.col("min_value") == F.col("max_value")
    return merged.withColumns(
        {
            "bucket": F.col("_w.start"),
            "avg_value": F.col("min_value") + F.col("_sum") / total,
            "stddev_value": F.when(
                total > 1, F.when(flat, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(F.abs(spread), total - 1)))
            ),
        }
    ).select("bucket", *by, *MEASURES)


def refresh_range(as_of, width: str, start: str, end: str) -> tuple[dt.datetime, dt.datetime]:
    """Whole buckets inside ``[as_of - start, as_of - end)``, as naive UTC times."""
    step = dt.timedelta(seconds=seconds_of(width))
    epoch = dt.datetime(1970, 1, 1)
    now = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    low = now - dt.timedelta(seconds=seconds_of(start)) - epoch
    high = now - dt.timedelta(seconds=seconds_of(end)) - epoch
    return epoch - (-low // step) * step, epoch + (high // step) * step


def _inside(column: Column, low: dt.datetime, high: dt.datetime) -> Column:
    return (column >= instant(str(low))) & (column < instant(str(high)))


def _facts_between(facts: DataFrame, low: dt.datetime, high: dt.datetime, ts: str) -> DataFrame:
    kept = facts.filter(_inside(F.col(ts), low, high))
    if "date" in facts.columns:
        kept = kept.filter(F.col("date").between(F.lit(low.date()), F.lit(high.date())))
    return kept


def refresh_rollup(
    facts: DataFrame,
    agg: DataFrame,
    width: str,
    start: str,
    end: str,
    as_of,
    ts: str = "time",
    by: Sequence[str] = SERIES,
) -> DataFrame:
    """The rollup after one refresh: buckets in range recomputed, all others left as they are."""
    low, high = refresh_range(as_of, width, start, end)
    fresh = rollup(_facts_between(facts, low, high, ts), width, ts, by)
    kept = agg.filter(~_inside(F.col("bucket"), low, high)).select("bucket", *by, *MEASURES)
    return kept.unionByName(fresh)


def write_rollup(agg: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A rollup as Parquet, one folder per day of its buckets."""
    agg.withColumn("date", F.to_date("bucket")).repartitionByRange(
        "date", "sensor_id", "bucket"
    ).write.partitionBy("date").mode(mode).parquet(path)


def refresh_rollup_table(
    spark: SparkSession,
    facts: DataFrame,
    path: str,
    policy: str | tuple[str, str, str, str],
    as_of,
    ts: str = "time",
    by: Sequence[str] = SERIES,
) -> None:
    """Refresh a stored rollup by one run of its policy, rewriting only the days in range.

    The new rows are first written to the shared scratch folder: the rewrite then reads no
    folder it replaces, and a lost executor only repeats its own tasks.
    """
    width, start, end, _ = REFRESH_POLICIES[policy] if isinstance(policy, str) else policy
    low, high = refresh_range(as_of, width, start, end)
    days = F.col("date").between(F.lit(low.date()), F.lit((high - dt.timedelta(seconds=1)).date()))
    store, target = file_system(spark, path)
    if store.exists(target):
        stored = spark.read.parquet(path).filter(days)
    else:  # the first run
        stored = rollup(facts.limit(0), width, ts, by).withColumn("date", F.to_date("bucket"))
    staged = scratch_dir(spark, "rollup-refresh")
    write_rollup(refresh_rollup(facts, stored, width, start, end, as_of, ts, by), staged)
    spark.read.parquet(staged).write.partitionBy("date").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def apply_retention(df: DataFrame, ts: str, days: int | None, as_of) -> DataFrame:
    """Rows young enough to keep; ``None`` keeps all."""
    return df if days is None else since(df, as_of, f"{days} days", ts)


def drop_expired_partitions(spark: SparkSession, table: str, days: int, as_of) -> list[str]:
    """Drop the day partitions of a catalogue table that lie wholly before the cut-off."""
    now = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    cutoff = now - dt.timedelta(days=days)
    expired = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        day = row[0].split("=", 1)[1]
        if dt.datetime.fromisoformat(day) + dt.timedelta(days=1) <= cutoff:
            expired.append(day)
    if expired:
        specs = ", ".join(f"PARTITION (date = DATE '{d}')" for d in expired)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return expired


def drop_expired_days(spark: SparkSession, path: str, days: int, as_of) -> list[str]:
    """The same for a table that is kept by path: deletes its old ``date=…`` folders."""
    now = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    cutoff = now - dt.timedelta(days=days)
    store, target = file_system(spark, path)
    expired = []
    for status in store.listStatus(target) if store.exists(target) else []:
        name, _, day = status.getPath().getName().partition("=")
        if name == "date" and day[:4].isdigit():
            if dt.datetime.fromisoformat(day) + dt.timedelta(days=1) <= cutoff:
                store.delete(status.getPath(), True)
                expired.append(day)
    return sorted(expired)


def readings_per_sec(df: DataFrame, as_of, lookback: str = "1 minute", ts: str = "time") -> DataFrame:
    """Readings in the look-back over the seconds they span, at least one second."""
    span = seconds_between(F.min(ts), F.max(ts))
    rate = F.count(F.lit(1)).cast("double") / F.greatest(span, F.lit(1.0))
    return since(df, as_of, lookback, ts).agg(rate.alias("readings_per_sec"))


def ingest_stats(
    df: DataFrame, width: str = "30 seconds", ts: str = "time", anomaly: Column | None = None
) -> DataFrame:
    """Readings, anomalous readings and readings per second in each interval.

    A reading counts as anomalous when its quality is not GOOD, unless told otherwise.
    """
    hit = F.col("quality_flag") != "GOOD" if anomaly is None else anomaly
    return (
        df.groupBy(F.window(ts, width).alias("_w"))
        .agg(F.count(F.lit(1)).alias("readings"), F.count_if(hit).alias("anomalies"))
        .select(
            F.col("_w.start").alias("bucket"),
            "readings",
            "anomalies",
            (F.col("readings") / F.lit(float(seconds_of(width)))).alias("readings_per_sec"),
        )
    )


def latest(
    df: DataFrame,
    keys: Sequence[str],
    as_of=None,
    lookback: str | None = None,
    ts: str = "time",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Newest row of every key, optionally only of keys seen within the look-back."""
    rows = df if lookback is None else since(df, as_of, lookback, ts)
    return extreme_rows(rows, keys, [ts, *tie])


def compact_latest(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()
) -> DataFrame:
    """What a compacted topic holds: the newest row of every key."""
    return latest(df, keys, ts=ts, tie=tie)
