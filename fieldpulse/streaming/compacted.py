"""Compacted topics fed by streams: sorted runs per micro-batch, folded as they pile up.

A run holds the newest row of every key that some micro-batches brought, tombstones included. Each
micro-batch writes one run of its own rows; ``fan`` neighbouring runs are folded into one, ``fan`` of
these into a wider one and so on, so a row is rewritten once per level and the work of a micro-batch
follows its rows, not the topic's size. Readers merge the widest complete runs.

A run's folder is named after the first and last micro-batch it covers, and is complete once Spark's
committer has put its ``_SUCCESS`` there. Complete wider runs hide the narrower ones inside them, so
a reader sees either the old runs or the folded one, and an interrupted write or fold is invisible
and simply repeated. Hidden runs stay for readers that began earlier, until ``drop_hidden``.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.functions.times import since
from fieldpulse.operators.sequence import extreme_rows
from fieldpulse.session import file_system


@dataclass(frozen=True)
class CompactedTopic:
    """A topic that keeps the newest row of every key, by ``ts``, then ``tie``, then row digest.

    ``deleted`` is an SQL condition on a row: where a key's newest row meets it, the key is gone.
    With ``retention_days`` rows older than that go as well, the ``delete`` half of a policy
    "compact and delete"; reading such a topic takes a time. ``buckets`` folders of hashed keys let
    a look-up of single keys skip the others. Topic and stream checkpoint belong together.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    ts: str
    tie: tuple[str, ...] = ()
    deleted: str | None = None
    retention_days: int | None = None
    buckets: int = 16
    fan: int = 8

    def __post_init__(self) -> None:
        if taken := {"run", "bucket"} & set(self.schema.fieldNames()):
            raise ValueError(f"columns named like the topic's folders: {sorted(taken)}")


@dataclass(frozen=True, order=True)
class Run:
    first: int
    last: int

    def folder(self, topic: CompactedTopic) -> str:
        return f"{topic.path}/run={self.first}-{self.last}"


def complete_runs(spark: SparkSession, topic: CompactedTopic) -> dict[Run, float]:
    """All complete runs with the time at which they were completed, in seconds."""
    store, base = file_system(spark, topic.path)
    found = {}
    for status in store.listStatus(base) if store.exists(base) else []:
        name, _, span = status.getPath().getName().partition("=")
        _, mark = file_system(spark, f"{status.getPath()}/_SUCCESS")
        if name == "run" and store.exists(mark):
            first, _, last = span.partition("-")
            found[Run(int(first), int(last))] = store.getFileStatus(mark).getModificationTime() / 1000
    return found


def _widest(runs: Sequence[Run]) -> list[Run]:
    """Runs that no other one covers. Ranges are aligned, so two are disjoint or nested."""
    kept: list[Run] = []
    for run in sorted(runs, key=lambda r: (r.first, -r.last)):
        if not kept or run.first > kept[-1].last:
            kept.append(run)
    return kept


def live_runs(spark: SparkSession, topic: CompactedTopic) -> list[Run]:
    """The runs that a reader merges, in the order of their micro-batches."""
    return _widest(list(complete_runs(spark, topic)))


def _rows(spark: SparkSession, topic: CompactedTopic, runs: Sequence[Run]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], topic.schema)
    layout = T.StructType([*topic.schema.fields, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])
    frame = spark.read.schema(layout).option("basePath", topic.path)
    return frame.parquet(*[run.folder(topic) for run in runs])


def _bucket(topic: CompactedTopic):
    return F.pmod(F.xxhash64(*topic.keys), F.lit(topic.buckets)).cast("int")


def _newest(topic: CompactedTopic, rows: DataFrame) -> DataFrame:
    columns = topic.schema.fieldNames()
    return extreme_rows(rows.select(*columns), topic.keys, [topic.ts, *topic.tie])


def _kept(topic: CompactedTopic, rows: DataFrame, as_of) -> DataFrame:
    """Rows within the retention. Whatever an expired tombstone hides is older and expired too."""
    if topic.retention_days is None or as_of is None:
        return rows
    return since(rows, as_of, f"{topic.retention_days} days", topic.ts)


def _write_run(topic: CompactedTopic, rows: DataFrame, run: Run) -> None:
    # Ranges over bucket and keys: a large bucket is cut into as many tasks as it needs.
    spread = rows.withColumn("bucket", _bucket(topic)).repartitionByRange("bucket", *topic.keys)
    spread.sortWithinPartitions("bucket", *topic.keys).write.partitionBy("bucket").mode(
        "overwrite"
    ).parquet(run.folder(topic))


def write_delta(topic: CompactedTopic, batch: DataFrame, batch_id: int) -> bool:
    """The run of one micro-batch; false, and nothing is written, where it is in already."""
    if any(r.first <= batch_id <= r.last for r in live_runs(batch.sparkSession, topic)):
        return False
    _write_run(topic, _newest(topic, batch), Run(batch_id, batch_id))
    return True


def _due(live: Sequence[Run], fan: int) -> tuple[Run, list[Run]] | None:
    """The widest aligned range that is complete and still lies in several runs."""
    found, width = None, fan
    while live and width <= live[-1].last + 1:
        groups: dict[int, list[Run]] = {}
        for run in live:
            if run.first // width == run.last // width:
                groups.setdefault(run.first // width, []).append(run)
        for place, members in groups.items():
            span = Run(place * width, (place + 1) * width - 1)
            if span.last <= live[-1].last and len(members) > 1:
                found = span, members
        width *= fan
    return found


def fold(spark: SparkSession, topic: CompactedTopic, as_of=None) -> list[Run]:
    """Fold all runs that are due; gives the new ones. May run beside the stream and its readers,
    but only one at a time.

    With ``as_of``, rows that the retention no longer keeps at that time are left out; readers must
    then not ask for an earlier time.
    """
    made = []
    while (due := _due(live_runs(spark, topic), topic.fan)) is not None:
        span, members = due
        _write_run(topic, _newest(topic, _kept(topic, _rows(spark, topic, members), as_of)), span)
        made.append(span)
    return made


def drop_hidden(spark: SparkSession, topic: CompactedTopic, grace_s: float) -> list[Run]:
    """Delete runs that a wider one has hidden for longer than readers take."""
    runs = complete_runs(spark, topic)
    live = _widest(list(runs))
    dropped = []
    for run in sorted(set(runs) - set(live)):
        cover = next(r for r in live if r.first <= run.first and run.last <= r.last)
        if runs[cover] + grace_s <= time.time():
            store, folder = file_system(spark, run.folder(topic))
            store.delete(folder, True)
            dropped.append(run)
    return dropped


def read_topic(
    spark: SparkSession, topic: CompactedTopic, as_of=None, key: Sequence | None = None
) -> DataFrame:
    """The newest row of every key that is neither deleted nor expired.

    With ``key``, one value per key column, only this key's row: its bucket and, as files are
    sorted by key, hardly any other rows are read.
    """
    if topic.retention_days is not None and as_of is None:
        raise ValueError("a topic with a retention is read as of a time")
    rows = _rows(spark, topic, live_runs(spark, topic))
    if key is not None and "bucket" in rows.columns:
        one = spark.range(1).select(
            *[F.lit(k).cast(topic.schema[c].dataType).alias(c) for c, k in zip(topic.keys, key, strict=True)]
        )
        rows = rows.filter(F.col("bucket") == one.select(_bucket(topic).alias("b")).first().b)
    for c, k in zip(topic.keys, key or (), strict=False):
        rows = rows.filter(F.col(c).eqNullSafe(F.lit(k)))
    newest = _newest(topic, _kept(topic, rows, as_of))
    if topic.deleted is None:
        return newest
    return newest.filter(~F.coalesce(F.expr(topic.deleted), F.lit(False)))


def start_compacted(
    stream: DataFrame,
    topic: CompactedTopic,
    checkpoint: str,
    trigger: dict | None = None,
    folding: bool = True,
) -> StreamingQuery:
    """A compacted topic fed by a stream; ``folding=False`` leaves ``fold`` to another job."""

    def process(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            write_delta(topic, held, batch_id)
        finally:
            held.unpersist()
        if folding:
            fold(batch.sparkSession, topic)

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
