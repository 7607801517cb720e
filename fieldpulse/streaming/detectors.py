"""Detectors and de-duplication on streams, with the batch column definitions on top.

Row frames and ``lag`` do not exist on streaming frames, so a stateful operator supplies what
they would: the baseline statistics and the previous reading of every row. Everything after
that - severities, descriptions, alert layout - is the code the batch detectors use.

State per sensor is a ring of N values and one time. Readings of a sensor are sorted by event
time within a micro-batch, and arrive in micro-batch order across them; a reading older than
the previous one of its sensor is a non-positive step, as in arrival order. What one task
holds is a sensor's share of one micro-batch, which the source's rate limit bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldpulse.config import DEV, DetectorConfig
from fieldpulse.functions.times import seconds_of
from fieldpulse.operators.detect import alerts_of_history, results_of
from fieldpulse.session import ROCKSDB_PROVIDER


# Columns of a reading that its alerts show.
ALERT_SOURCE = ("time", "reading_id", "platform_id", "sensor_id", "sensor_type", "value", "unit")


def use_rocksdb(spark: SparkSession) -> None:
    """State stores that spill to disk and checkpoint changes only."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


SERIES_STATE = T.StructType(
    [
        T.StructField("values", T.ArrayType(T.DoubleType())),
        T.StructField("last_us", T.LongType()),
    ]
)
ADDED = T.StructType(
    [
        T.StructField("_n", T.LongType()),
        T.StructField("_mean", T.DoubleType()),
        T.StructField("_std", T.DoubleType()),
        T.StructField("_seen", T.IntegerType()),
        T.StructField("_prev_value", T.DoubleType()),
        T.StructField("_prev_us", T.LongType()),
    ]
)


def rolling(values: np.ndarray, start: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and population deviation of the last ``size`` values at ``start`` and after.

    Works through the rows in pieces, so that the frames held at a time stay small.
    """
    counts = np.minimum(np.arange(start, len(values)) + 1, size)
    padded = np.concatenate([np.full(size - 1, np.nan), values])
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[start:]
    means, stds = np.empty(len(counts)), np.empty(len(counts))
    piece = max(1, 2_000_000 // size)
    for at in range(0, len(counts), piece):
        part, n = frames[at : at + piece], counts[at : at + piece]
        used = np.arange(size) >= (size - n)[:, None]
        mean = np.sum(part, axis=1, where=used) / n
        squares = np.square(part - mean[:, None])
        means[at : at + piece] = mean
        stds[at : at + piece] = np.sqrt(np.sum(squares, axis=1, where=used) / n)
    return counts, means, stds


def in_order(pieces: list[pd.DataFrame], tie: str) -> pd.DataFrame:
    """Rows by ``at_us``, those of one instant by ``tie``; most arrive so and are not moved."""
    pdf = pieces[0] if len(pieces) == 1 else pd.concat(pieces, ignore_index=True)
    if (np.diff(pdf["at_us"].to_numpy("int64")) > 0).all():
        return pdf
    return pdf.sort_values(["at_us", tie], kind="stable", ignore_index=True)


class SeriesState(StatefulProcessor):
    """Appends each row's baseline statistics and previous reading."""

    def __init__(self, window_size: int, columns: list[str], tie: str) -> None:
        self.window_size, self.columns, self.tie = window_size, columns, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("series", SERIES_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(list(rows), self.tie)
        held, last_us = [], None
        if self.state.exists():
            stored = self.state.get()
            held, last_us = list(stored[0]), stored[1]
        start = len(held)
        values = np.concatenate([np.array(held, dtype="float64"), pdf["value"].to_numpy("float64")])
        counts, means, stds = rolling(values, start, self.window_size)
        times = pdf["at_us"].to_numpy("int64")
        # The first row of a series has nothing before it.
        first = np.zeros(len(times), dtype=bool)
        first[0] = last_us is None
        before = np.concatenate([[last_us or 0], times[:-1]]).astype("int64")
        # One frame from finished columns: adding them one by one costs more than all the rest.
        out = pd.DataFrame(
            {
                **{name: pdf[name] for name in self.columns},
                "_n": counts.astype("int64"),
                "_mean": means,
                "_std": stds,
                "_seen": pd.arrays.IntegerArray(np.ones(len(times), dtype="int32"), first),
                "_prev_value": np.concatenate([[values[start - 1] if start else np.nan], values[start:-1]]),
                "_prev_us": pd.arrays.IntegerArray(before, first.copy()),
            }
        )
        keep = max(self.window_size, 1)
        self.state.update((values[-keep:].tolist(), int(times[-1])))
        yield out

    def close(self) -> None:
        pass


def _with_history(stream: DataFrame, config: DetectorConfig, tie: str) -> DataFrame:
    use_rocksdb(stream.sparkSession)
    # The time goes to Python and back as a number: made into objects row by row it costs the most.
    passed = [f for f in stream.schema.fields if f.name != "time"] + [T.StructField("at_us", T.LongType())]
    keyed = stream.withColumn("at_us", F.unix_micros("time")).drop("time")
    schema = T.StructType(passed + ADDED.fields)
    stated = keyed.groupBy("sensor_id").transformWithStateInPandas(
        SeriesState(config.window_size, [f.name for f in passed], "at_us" if tie == "time" else tie), schema, "append", "none"
    )
    timed = stated.withColumns({"time": F.timestamp_micros("at_us"), "_prev_time": F.timestamp_micros("_prev_us")})
    return timed.select(*stream.columns, *[n for n in ADDED.names if n != "_prev_us"], "_prev_time")


def stream_detector_chain(
    stream: DataFrame,
    config: DetectorConfig = DEV,
    tie: str = "reading_id",
    detected_at: Column | None = None,
) -> DataFrame:
    """All three detector results on every reading of a stream; see the batch chain."""
    return results_of(_with_history(stream, config, tie), config, detected_at)


def stream_detect_all(
    stream: DataFrame,
    config: DetectorConfig = DEV,
    tie: str = "reading_id",
    detected_at: Column | None = None,
) -> DataFrame:
    """Alerts of the whole chain on a stream."""
    if detected_at is None:  # only what alerts are made of goes through the state's Python workers
        stream = stream.select(*[c for c in stream.columns if c in ALERT_SOURCE or c == tie])
    return alerts_of_history(_with_history(stream, config, tie), config, detected_at)


class RepeatState(StatefulProcessor):
    """Lets an alert through after a quiet gap, or a fixed time after the last one let through."""

    def __init__(self, window_us: int, mode: str, columns: list[str], tie: str, expires: bool = False) -> None:
        self.window_us, self.mode, self.columns, self.tie = window_us, mode, columns, tie
        self.expires = expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "last", T.StructType([T.StructField("us", T.LongType())])
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(list(rows), self.tie)
        times = pdf["at_us"].to_numpy("int64")
        last = before = int(self.state.get()[0]) if self.state.exists() else None
        if self.mode == "quiet_gap":
            first_ok = last is None or times[0] - last > self.window_us
            chosen = np.flatnonzero(np.concatenate([[first_ok], np.diff(times) > self.window_us]))
            last = int(times[-1]) if last is None else max(last, int(times[-1]))
        else:
            chosen = []
            at = 0 if last is None else int(np.searchsorted(times, last + self.window_us, "right"))
            while at < len(times):
                chosen.append(at)
                last = int(times[at])
                at = int(np.searchsorted(times, last + self.window_us, "right"))
        self.state.update((last,))
        if self.expires and last != before:
            if before is not None:
                self.handle.deleteTimer(self._over_ms(before))
            self.handle.registerTimer(self._over_ms(last))
        yield pdf.iloc[chosen][self.columns]

    def _over_ms(self, last: int) -> int:
        """From here on the state changes no result: any alert is let through."""
        return (last + self.window_us) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_dedup_alerts(
    alerts: DataFrame,
    keys: tuple[str, ...] = ("sensor_id", "anomaly_type"),
    window: str = "30 minutes",
    mode: str = "quiet_gap",
    ts: str = "detected_at",
    tie: str = "alert_id",
    lateness: str | None = None,
) -> DataFrame:
    """Alert de-duplication on a stream, by explicit times held in state.

    With ``lateness`` alerts later than that are dropped, and a key leaves the state once the
    watermark has passed its window; without, all keys ever seen stay.
    """
    use_rocksdb(alerts.sparkSession)
    if lateness is not None:
        alerts = alerts.withWatermark(ts, lateness)
    keyed = alerts.withColumn("at_us", F.unix_micros(ts))
    processor = RepeatState(seconds_of(window) * 1_000_000, mode, alerts.columns, tie, lateness is not None)
    return keyed.groupBy(*keys).transformWithStateInPandas(
        processor, alerts.schema, "append", "none" if lateness is None else "eventTime"
    )


class HoldState(StatefulProcessor):
    """Follows how long a condition has held in a series and reports each episode once."""

    def __init__(self, hold_us: int, series: list[str]) -> None:
        self.hold_us, self.series = hold_us, series

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType(
            [T.StructField("since", T.LongType()), T.StructField("fired", T.BooleanType())]
        )
        self.state = handle.getValueState("episode", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("at_us", kind="stable")
        since, fired = self.state.get() if self.state.exists() else (None, False)
        us, held = pdf["at_us"].to_numpy(np.int64), pdf["held"].to_numpy(bool)
        # Run 0 continues the stored episode, the others start where the condition sets in.
        before = np.concatenate(([since is not None], held[:-1]))
        starts = np.flatnonzero(held & ~before)
        run = np.searchsorted(starts, np.arange(len(us)), "right")
        begun = np.concatenate(([us[0] if since is None else since], us[starts]))[run]
        due = held & (us - begun >= self.hold_us)
        if fired:
            due &= run > 0
        runs, first = np.unique(run[due], return_index=True)
        at = np.flatnonzero(due)[first]
        if held[-1]:
            self.state.update((int(begun[-1]), bool(run[-1] in runs or (fired and run[-1] == 0))))
        else:
            self.state.update((None, False))
        if len(at):
            out = pd.DataFrame([list(key)] * len(at), columns=self.series)
            out["since_us"], out["fired_us"] = begun[at], us[at]
            yield out

    def close(self) -> None:
        pass


def stream_sustained(
    samples: DataFrame,
    condition: Column,
    duration: str,
    series: tuple[str, ...] = ("job", "instance", "metric", "component"),
    ts: str = "ts",
) -> DataFrame:
    """Start and time of firing of every episode, once its condition has held long enough."""
    use_rocksdb(samples.sparkSession)
    marked = samples.select(
        *series,
        F.unix_micros(ts).alias("at_us"),
        F.coalesce(condition, F.lit(False)).alias("held"),
    )
    schema = T.StructType(
        [samples.schema[c] for c in series]
        + [T.StructField("since_us", T.LongType()), T.StructField("fired_us", T.LongType())]
    )
    processor = HoldState(seconds_of(duration) * 1_000_000, list(series))
    episodes = marked.groupBy(*series).transformWithStateInPandas(
        processor, schema, "append", "none"
    )
    return episodes.select(
        *series,
        F.timestamp_micros("since_us").alias("pending_since"),
        F.timestamp_micros("fired_us").alias("fired_at"),
    )
