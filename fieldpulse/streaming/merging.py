"""Records of a stream merged into batches, by count or by time (AG9).

A batch leaves as soon as enough records of its bin are there, and what is there leaves once its
oldest record has waited long enough, also when nothing else arrives: a timer on the processing time
releases it. What waits lies in the state store, fewer than ``min_records`` records per bin and lane,
so a restart neither loses nor repeats a record.

A bin may hold most of the stream; its records are dealt over lanes by a hash of key and value. A
task goes through its share in pieces and holds at most one batch of it.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fieldpulse.functions.times import seconds_of
from fieldpulse.session import file_system
from fieldpulse.streaming.detectors import use_rocksdb

# The aggregating stage waits for this many records or this long.
MIN_RECORDS = 100
MAX_WAIT = "5 seconds"

_RECORD = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
_PLACE = T.StructType([T.StructField("batch", T.LongType()), T.StructField("due_ms", T.LongType())])


class MergeState(StatefulProcessor):
    """The waiting records of one bin and lane, the number of its next batch, and its timer."""

    def __init__(self, by: list[str], min_records: int, max_records: int, wait_ms: int) -> None:
        self.by, self.wait_ms = by, wait_ms
        self.min_records, self.max_records = min_records, max_records

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _RECORD)
        self.place = handle.getValueState("place", _PLACE)

    def _batch(self, key: tuple, number: int, records: list[tuple], closed_by: str) -> pd.DataFrame:
        out = pd.DataFrame([list(key)], columns=[*self.by, "lane"])
        out["batch"], out["records"], out["closed_by"] = number, len(records), closed_by
        out["keys"] = [[r[0] for r in records]]
        out["values"] = [[r[1] for r in records]]
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        number, due = self.place.get() if self.place.exists() else (0, None)
        waiting = [tuple(r) for r in self.held.get()] if due is not None else []
        released = False
        for piece in rows:
            waiting += zip(piece["key"], piece["value"], strict=True)
            at = 0
            while len(waiting) - at >= self.max_records:
                yield self._batch(key, number, waiting[at : at + self.max_records], "count")
                at += self.max_records
                number, released = number + 1, True
            waiting = waiting[at:]
        if len(waiting) >= self.min_records:
            yield self._batch(key, number, waiting, "count")
            number, released, waiting = number + 1, True, []
        if due is not None and released:  # whoever waited longest has left
            self.handle.deleteTimer(due)
            due = None
        if waiting:
            self.held.put(waiting)
            if due is None:
                due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
                self.handle.registerTimer(due)
        else:
            self.held.clear()
        self.place.update((number, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, due = self.place.get()
        if due is None:
            return
        yield self._batch(key, number, [tuple(r) for r in self.held.get()], "time")
        self.held.clear()
        self.place.update((number + 1, None))

    def close(self) -> None:
        pass


def merge_records(
    records: DataFrame,
    by: tuple[str, ...] = ("topic",),
    min_records: int = MIN_RECORDS,
    max_records: int = 1_000,
    max_wait: str = MAX_WAIT,
    lanes: int = 8,
) -> DataFrame:
    """Keyed records (see ``to_keyed_records``) of a stream merged into batches per bin.

    A batch holds ``min_records`` to ``max_records`` records, or fewer when ``closed_by`` is "time".
    ``batch`` counts within bin and lane. To be run with a repeating trigger: one that stops at the
    end of its input leaves what still waits in the state, for the next start to release.
    """
    if not 0 < min_records <= max_records:
        raise ValueError("a batch holds min_records to max_records records, at least one")
    use_rocksdb(records.sparkSession)
    lane = F.pmod(F.xxhash64("key", "value"), F.lit(lanes)).cast("int")
    dealt = records.select(*by, lane.alias("lane"), F.col("key").cast("string"), F.col("value").cast("string"))
    schema = T.StructType(
        [dealt.schema[c] for c in (*by, "lane")]
        + T.StructType.fromDDL(
            "batch bigint, records int, closed_by string, keys array<string>, `values` array<string>"
        ).fields
    )
    state = MergeState(list(by), min_records, max_records, seconds_of(max_wait) * 1_000)
    return dealt.groupBy(*by, "lane").transformWithStateInPandas(state, schema, "append", "processingTime")


def await_records(
    spark: SparkSession,
    query: StreamingQuery,
    path: str,
    schema: T.StructType,
    expected: int,
    timeout_s: float = 300.0,
) -> DataFrame:
    """Wait until a sink of merged batches below ``path`` holds that many records, then stop the
    query and give the batches; an error where the time does not suffice."""
    end = time.monotonic() + timeout_s
    try:
        # With timers pending a query always has a next micro-batch, so it is never "all processed".
        store, log = file_system(spark, f"{path}/_spark_metadata/0")
        total = 0
        while time.monotonic() < end and query.exception() is None:
            if store.exists(log):
                merged = spark.read.schema(schema).parquet(path)
                total = merged.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).first().n
                if total >= expected:
                    return merged
            time.sleep(0.5)
        raise query.exception() or TimeoutError(f"{total} of {expected} records merged")
    finally:
        query.stop()
