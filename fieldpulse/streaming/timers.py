"""Conditions and notifications on streams that change by silence as well as by rows (MX4, MX5).

Rows of a series wait in the state until the watermark has passed them and are then taken in order of
time, so results do not depend on the order of arrival; rows later than the watermark are dropped by
Spark. One event-time timer per series wakes it for its next waiting row or for what time alone brings
about: a condition has held long enough, a series has fallen silent. A series that is over and has
nothing waiting leaves no state behind.

What waits is one entry per series and instant, as many as the lateness allows for; one task holds a
series' share of a micro-batch, which the source's rate limit bounds. Times are to be checked before
(see ``parse_reading``): one far in the future moves the watermark for all series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldpulse.functions.times import seconds_of
from fieldpulse.streaming.detectors import use_rocksdb



def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


_ENTRIES = T.StructType([T.StructField("packed", T.BinaryType())])
_PACKED = 50_000  # entries in one value of the state, 1.2 MB
_TIMER = T.StructType(_longs("due_ms"))
_NOTICE = T.StructType(_longs("slot", "first", "n"))


def merged_entries(entries: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    """One entry per instant, in order: rows counted, held only if all of them hold."""
    out: list[tuple[int, int, bool]] = []
    for us, n, held in sorted(entries):
        if out and out[-1][0] == us:
            out[-1] = (us, out[-1][1] + n, out[-1][2] and held)
        else:
            out.append((us, n, held))
    return out


def packed(entries: list[tuple[int, int, bool]]) -> list[tuple[bytes]]:
    """Entries as few values of the state: each value costs calls and conversions of its own."""
    pieces = (entries[at : at + _PACKED] for at in range(0, len(entries), _PACKED))
    return [(np.array(piece, dtype="<i8").tobytes(),) for piece in pieces]


def unpacked(values: Iterator[tuple[bytes]]) -> list[tuple[int, int, bool]]:
    out: list[tuple[int, int, bool]] = []
    for (piece,) in values:
        us, n, held = np.frombuffer(bytes(piece), dtype="<i8").reshape(-1, 3).T
        out += zip(us.tolist(), n.tolist(), held.astype(bool).tolist(), strict=True)
    return out


class OrderedState(StatefulProcessor):
    """Hands the rows of a series on in order of time, once the watermark has passed them.

    Subclasses give ``SCHEMA`` (of their state), ``OUT`` (columns of an event) and three methods:
    ``step`` takes one entry, ``settle`` what time alone brings about before the horizon, both
    appending events; ``due`` tells when time alone will act next, or None where the state is idle.
    """

    SCHEMA: T.StructType
    OUT: list[str]

    def __init__(self, series: list[str]) -> None:
        self.series = series

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _ENTRIES)
        self.state = handle.getValueState("state", self.SCHEMA)
        self.timer = handle.getValueState("timer", _TIMER)

    def step(self, state, us: int, n: int, held: bool, events: list):
        raise NotImplementedError

    def settle(self, state, horizon: int, events: list):
        raise NotImplementedError

    def due(self, state) -> int | None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        entries: list[tuple[int, int, bool]] = []
        for piece in rows:
            held = piece["held"].astype(bool).tolist()
            entries += zip(piece["at_us"].tolist(), [1] * len(held), held, strict=True)
        entries = merged_entries(entries)
        self.waiting.appendList(packed(entries))
        due, set_for = entries[0][0] // 1000, self.timer.get()[0] if self.timer.exists() else None
        if set_for is None or due < set_for:
            if set_for is not None:
                self.handle.deleteTimer(set_for)
            self.handle.registerTimer(due)
            self.timer.update((due,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        horizon = timerValues.getCurrentWatermarkInMs() * 1000
        entries = unpacked(self.waiting.get()) if self.waiting.exists() else []
        later = [e for e in entries if e[0] >= horizon]
        state = self.state.get() if self.state.exists() else None
        events: list[tuple] = []
        for us, n, held in merged_entries([e for e in entries if e[0] < horizon]):
            state = self.step(state, us, n, held, events)
        state = self.settle(state, horizon, events)
        own = self.due(state)
        if state is None:
            self.state.clear()
        else:
            self.state.update(state)
        if later:
            self.waiting.put(packed(later))
        else:
            self.waiting.clear()
        nexts = [min(e[0] for e in later)] if later else []
        nexts += [own] if own is not None else []
        if nexts:
            due = min(nexts) // 1000
            self.handle.registerTimer(due)
            self.timer.update((due,))
        else:
            self.timer.clear()
        if events:
            columns = {name: [value] * len(events) for name, value in zip(self.series, key, strict=True)}
            for name, values in zip(self.OUT, zip(*events, strict=True), strict=True):
                texts = name in ("event", "closed_by")
                columns[name] = list(values) if texts else pd.array(values, dtype="Int64")
            yield pd.DataFrame(columns)

    def close(self) -> None:
        pass


class EpisodeState(OrderedState):
    """(since, last true, fired) of the episode that is open, if any."""

    SCHEMA = T.StructType([*_longs("since", "last"), T.StructField("fired", T.BooleanType())])
    OUT = ["event", "since_us", "at_us", "closed_by"]

    def __init__(self, series: list[str], hold_us: int, stale_us: int) -> None:
        super().__init__(series)
        self.hold_us, self.stale_us = hold_us, stale_us

    def _fires(self, since: int, fired: bool, events: list) -> None:
        if not fired:
            events.append(("firing", since, since + self.hold_us, None))

    def _closed(self, state, until: int, by: str, events: list) -> None:
        since, _, fired = state
        if until - since >= self.hold_us:
            self._fires(since, fired, events)
            events.append(("resolved", since, until, by))

    def step(self, state, us, n, held, events):
        if state is not None and us - state[1] > self.stale_us:
            self._closed(state, state[1] + self.stale_us, "silence", events)
            state = None
        if held:
            return (us, us, False) if state is None else (state[0], us, state[2])
        if state is not None:
            self._closed(state, us, "sample", events)
        return None

    def settle(self, state, horizon, events):
        if state is None:
            return None
        since, last, fired = state
        if last + self.stale_us < horizon:
            self._closed(state, last + self.stale_us, "silence", events)
            return None
        # Every row before the horizon is in, so nothing has ended the episode until here.
        if since + self.hold_us < horizon:
            self._fires(since, fired, events)
            fired = True
        return since, last, fired

    def due(self, state):
        if state is None:
            return None
        since, last, fired = state
        ends = last + self.stale_us
        return ends if fired else min(ends, since + self.hold_us)


def stream_episodes(
    samples: DataFrame,
    condition: Column,
    duration: str,
    stale: str = "5 minutes",
    lateness: str = "1 minute",
    series: tuple[str, ...] = ("job", "instance", "metric", "component"),
    ts: str = "ts",
) -> DataFrame:
    """Episodes of a condition as two events, ``firing`` and ``resolved``.

    A sample counts until the next one of its series, for ``stale`` at most. An episode fires once
    the condition has held for ``duration``, also when no further sample tells so, and is resolved by
    the first sample at which the condition does not hold, or by silence, ``stale`` after the last one.
    Shorter episodes give no event. Of samples at one instant all must hold; an unknown condition does
    not hold. Rows: the series, event, since, at, closed_by ("sample", "silence"; null when firing).
    """
    use_rocksdb(samples.sparkSession)
    marked = samples.withWatermark(ts, lateness).select(
        *series, ts, F.unix_micros(ts).alias("at_us"), F.coalesce(condition, F.lit(False)).alias("held")
    )
    state = EpisodeState(list(series), seconds_of(duration) * 1_000_000, seconds_of(stale) * 1_000_000)
    schema = T.StructType(
        [samples.schema[c] for c in series]
        + T.StructType.fromDDL("event string, since_us bigint, at_us bigint, closed_by string").fields
    )
    found = marked.groupBy(*series).transformWithStateInPandas(state, schema, "append", "eventTime")
    return found.select(
        *series,
        "event",
        F.timestamp_micros("since_us").alias("since"),
        F.timestamp_micros("at_us").alias("at"),
        "closed_by",
    )


class NoticeState(OrderedState):
    """The open session of a group: its first and last occurrence, their number, the slot that runs,
    and the notifications that are still to go out."""

    SCHEMA = T.StructType(
        [*_longs("start", "last", "total", "slot"), T.StructField("pending", T.ArrayType(_NOTICE))]
    )
    OUT = ["event", "start_us", "slot", "at_us", "alerts"]

    def __init__(self, series: list[str], repeat_us: int, resolve_us: int, wait_us: int) -> None:
        super().__init__(series)
        self.repeat_us, self.resolve_us, self.wait_us = repeat_us, resolve_us, wait_us

    def _sent(self, start: int, pending: list, horizon: int | None, events: list) -> list:
        """Notifications due before the horizon leave; the others are given back."""
        kept = []
        for slot, first, n in pending:
            if horizon is None or first + self.wait_us < horizon:
                events.append(("notified", start, slot, first + self.wait_us, n))
            else:
                kept.append((slot, first, n))
        return kept

    def _resolved(self, state, events: list) -> None:
        start, last, total, _, pending = state
        self._sent(start, pending, None, events)
        events.append(("resolved", start, None, last + self.resolve_us, total))

    def step(self, state, us, n, held, events):
        if state is not None and us - state[1] > self.resolve_us:
            self._resolved(state, events)
            state = None
        if state is None:
            return us, us, n, 0, [(0, us, n)]
        start, _, total, slot, pending = state
        pending = self._sent(start, [tuple(p) for p in pending], us, events)
        now = (us - start) // self.repeat_us
        if now != slot:
            pending.append((now, us, n))
        elif pending and pending[-1][0] == now:
            pending[-1] = (now, pending[-1][1], pending[-1][2] + n)
        return start, us, total + n, now, pending

    def settle(self, state, horizon, events):
        if state is None:
            return None
        if state[1] + self.resolve_us < horizon:
            self._resolved(state, events)
            return None
        start, last, total, slot, pending = state
        return start, last, total, slot, self._sent(start, [tuple(p) for p in pending], horizon, events)

    def due(self, state):
        if state is None:
            return None
        return min([state[1] + self.resolve_us] + [p[1] + self.wait_us for p in state[4]])


def stream_notifications(
    alerts: DataFrame,
    keys: tuple[str, ...] = ("alertname", "severity"),
    repeat: str = "1 hour",
    resolve_after: str = "5 minutes",
    wait: str = "10 seconds",
    lateness: str = "1 minute",
    ts: str = "fired_at",
) -> DataFrame:
    """Notifications of a stream of alert occurrences: ``notified`` and ``resolved`` per group.

    Sessions and intervals as in ``group_notifications``. A notification goes out ``wait`` after the
    first occurrence of its interval and counts the interval's occurrences up to then; silence for
    ``resolve_after`` closes the session with the number of all its occurrences.
    Rows: the keys, event, session_start, slot (null when resolved), at, alerts.
    """
    repeat_us, resolve_us, wait_us = (seconds_of(x) * 1_000_000 for x in (repeat, resolve_after, wait))
    if not 0 <= wait_us <= min(repeat_us, resolve_us):
        raise ValueError("wait is to be no longer than repeat and resolve_after")
    use_rocksdb(alerts.sparkSession)
    marked = alerts.withWatermark(ts, lateness).select(
        *keys, ts, F.unix_micros(ts).alias("at_us"), F.lit(True).alias("held")
    )
    schema = T.StructType(
        [alerts.schema[c] for c in keys]
        + T.StructType.fromDDL("event string, start_us bigint, slot bigint, at_us bigint, alerts bigint").fields
    )
    state = NoticeState(list(keys), repeat_us, resolve_us, wait_us)
    found = marked.groupBy(*keys).transformWithStateInPandas(state, schema, "append", "eventTime")
    return found.select(
        *keys,
        "event",
        F.timestamp_micros("start_us").alias("session_start"),
        "slot",
        F.timestamp_micros("at_us").alias("at"),
        "alerts",
    )
