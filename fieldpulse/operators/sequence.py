"""Ordered per-key computations that do not put a whole series into one task.

A plain ``Window.partitionBy(sensor).orderBy(time)`` sends every reading of a sensor to one
task, and one sensor may hold a third of all readings. The helpers here cut each series into
time slices, work on (key, slice), and then repair only the rows at the slice borders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.times import seconds_between, seconds_of


def time_slice(ts: Column, width: str) -> Column:
    """Number of the slice a time falls into; grows with time."""
    return _whole_steps(F.unix_micros(ts), seconds_of(width) * 1_000_000)


def _whole_steps(us: Column, width: int) -> Column:
    """Whole widths below a number of microseconds, free of rounding."""
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("bigint")


def with_preceding_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    slice_by: Column | None,
) -> DataFrame:
    """Apply ``add``, which may look back up to ``depth`` rows in its key's order.

    ``add(frame, window)`` adds window columns over ``window``. It runs first over (key,
    slice). A row with ``depth`` predecessors in its own slice is right after that. The others
    are the first ``depth`` rows of a slice; they are computed again over the first and last
    ``depth`` rows of all slices of the key. No row is missing between such a row and its
    predecessors there, so the result is the same as over the whole series, while that second
    pass holds at most ``2 * depth`` rows per slice.

    ``slice_by`` must not decrease along ``order``; ``None`` runs one window per key.
    """
    if slice_by is None:
        return add(df, Window.partitionBy(*keys).orderBy(*order))
    own = Window.partitionBy(*keys, "_slice").orderBy(*order)
    flagged = df.withColumn("_slice", slice_by).withColumns(
        {
            "_head": F.lag(F.lit(1), depth).over(own).isNull(),
            "_tail": F.lead(F.lit(1), depth).over(own).isNull(),
        }
    )
    helpers = ("_slice", "_head", "_tail")
    body = add(flagged, own).filter(~F.col("_head")).drop(*helpers)
    edges = flagged.filter(F.col("_head") | F.col("_tail"))
    heads = (
        add(edges, Window.partitionBy(*keys).orderBy(*order)).filter(F.col("_head")).drop(*helpers)
    )
    return body.unionByName(heads)


ROWS_PER_DEPTH = 20  # rows of a slice for each row of look-back
MERGED = 64  # slices that one slice of the next pass takes in
PASSES = 3
COARSE, FINE = 60_000_000, 1_000  # microseconds: a minute, and the resolution of the readings


def row_slices(df: DataFrame, keys: Sequence[str], ts: str, size: int) -> DataFrame:
    """``df`` with ``_slice``, which cuts each key's time into runs of ``size`` to ``2 * size`` rows,
    and ``_last``, the highest number that a slice of the key can have.

    A histogram of rows per key and minute is counted map-side; running sums over it number the
    rows before each minute, and a minute belongs to the slice of its first row. A minute with more
    than ``size`` rows is counted again by milliseconds. So a burst is cut, a reading far off in
    time costs one bucket, and a key is one window row for each minute in which it has any reading.
    Only rows of one millisecond stay together however many they are. A null time comes first.
    """
    us = F.unix_micros(ts)
    marked = df.withColumns({"_coarse": _whole_steps(us, COARSE), "_fine": _whole_steps(us, FINE)})
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    own = list(names.values())

    def named(frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(k).alias(n) for k, n in names.items()], *[c for c in frame.columns if c not in names])

    def before(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    counts = named(marked.groupBy(*keys, "_coarse").agg(F.count(F.lit(1)).alias("_n")))
    key = Window.partitionBy(*own)
    minutes = counts.withColumns(
        {"_before": before(key.orderBy("_coarse")), "_last": F.floor((F.sum("_n").over(key) - 1) / size)}
    ).withColumnRenamed("_coarse", "_minute")
    here = [*same, F.col("_coarse").eqNullSafe(F.col("_minute"))]
    crowded = minutes.filter(F.col("_n") > size).select(*own, "_minute", "_before")
    inside = marked.select(*keys, "_coarse", "_fine").join(crowded, here).groupBy(*own, "_minute", "_fine")
    inside = inside.agg(F.count(F.lit(1)).alias("_n"), F.first("_before").alias("_start"))
    inside = inside.select(
        *own,
        F.col("_fine").alias("_instant"),
        (F.col("_start") + before(Window.partitionBy(*own, "_minute").orderBy("_fine"))).alias("_within"),
    )
    found = marked.join(minutes.drop("_n"), here).drop("_minute", "_coarse")
    found = found.withColumnsRenamed({n: f"{n}_" for n in own})
    found = found.join(inside, [*same, F.col("_fine").eqNullSafe(F.col("_instant"))], "left")
    found = found.withColumn("_slice", F.floor(F.coalesce("_within", "_before") / size))
    return found.drop(*own, *[f"{n}_" for n in own], "_fine", "_instant", "_within", "_before")


def with_preceding_rows_sized(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    rows_per_slice: int | None = None,
    merged: int = MERGED,
) -> DataFrame:
    """As :func:`with_preceding_rows`, with slices sized by the rows of each key (``row_slices``).

    A sparse series is one slice and needs no second pass. The borders of dense series, a tenth of
    their rows, are repaired over ``merged`` slices at a time, the borders of that pass over
    ``merged`` times as many, and so on: no pass holds a whole series in one window until a
    series has more than ``merged ** PASSES`` slices.

    ``order[0]`` must be a timestamp.
    """
    sliced = row_slices(df, keys, order[0], rows_per_slice or ROWS_PER_DEPTH * max(depth, 1))
    return _repaired(sliced, keys, order, depth, add, merged, PASSES).drop("_slice", "_last")


def _repaired(frame, keys, order, depth, add, merged: int, passes: int) -> DataFrame:
    if not passes:
        return add(frame, Window.partitionBy(*keys).orderBy(*order))
    own = Window.partitionBy(*keys, "_slice").orderBy(*order)
    head, tail = f"_head{passes}", f"_tail{passes}"
    flagged = frame.withColumns(
        {
            head: F.lag(F.lit(1), depth).over(own).isNull() & (F.col("_slice") > 0),
            tail: F.lead(F.lit(1), depth).over(own).isNull() & (F.col("_slice") < F.col("_last")),
        }
    )
    body = add(flagged, own).filter(~F.col(head)).drop(head, tail)
    edges = flagged.filter(F.col(head) | F.col(tail)).withColumns(
        {"_slice": F.floor(F.col("_slice") / merged), "_last": F.floor(F.col("_last") / merged)}
    )
    again = _repaired(edges, keys, order, depth, add, merged, passes - 1)
    return body.unionByName(again.filter(F.col(head)).drop(head, tail))


def with_preceding_span(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    span: str,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    slice_width: str = "1 hour",
) -> DataFrame:
    """Apply ``add``, which may look back over ``span`` of time in its key's series.

    Rows in the last ``span`` of a slice are handed to the next slice as context too, so one
    shuffle on (key, slice) is enough. The window is ordered by epoch microseconds (``_us``),
    for ``rangeBetween(-span, 0)``.
    """
    width, back = seconds_of(slice_width) * 1_000_000, seconds_of(span) * 1_000_000
    if back > width:
        raise ValueError("the slice must be at least as wide as the span")
    us = F.unix_micros(ts)
    home = _whole_steps(us, width)
    copies = F.when(_whole_steps(us + back, width) > home, F.array(home, home + 1)).otherwise(
        F.array(home)
    )
    spread = df.withColumns({"_us": us, "_slice": F.explode(copies)})
    window = Window.partitionBy(*keys, "_slice").orderBy("_us")
    kept = add(spread, window).filter(F.col("_slice") == _whole_steps(F.col("_us"), width))
    return kept.drop("_us", "_slice")


def fold_buckets(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    width: str,
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """First and last time and row count (and ``aggregates``) per key and time bucket."""
    extra = [column.alias(name) for name, column in (aggregates or {}).items()]
    return df.groupBy(*keys, time_slice(F.col(ts), width).alias("_bucket")).agg(
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("_rows"),
        *extra,
    )


def bucket_sessions(df: DataFrame, keys: Sequence[str], ts: str, gap: str) -> DataFrame:
    """Time buckets of each key with the number of the session they belong to.

    A session ends where a key pauses for longer than ``gap``. Buckets are as wide as the gap,
    so no such pause can hide inside one: comparing neighbouring buckets finds them all, and a
    key costs one row per bucket however many rows it has.
    """
    ordered = Window.partitionBy(*keys).orderBy("_bucket")
    pause = seconds_between(F.lag("_last").over(ordered), F.col("_first"))
    starts = F.when(pause.isNull() | (pause > seconds_of(gap)), 1).otherwise(0)
    return (
        fold_buckets(df, keys, ts, gap)
        .withColumn("_starts", starts)
        .withColumn("session", F.sum("_starts").over(ordered).cast("bigint"))
        .drop("_starts")
    )


def sessions(df: DataFrame, keys: Sequence[str], ts: str, gap: str) -> DataFrame:
    """Start, end and row count of every session of a key; see :func:`bucket_sessions`."""
    return (
        bucket_sessions(df, keys, ts, gap)
        .groupBy(*keys, "session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_rows").alias("rows"),
        )
    )


_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _digestible(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _digestible(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_digestible(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def extreme_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool = True
) -> DataFrame:
    """Of each key the row that comes last by ``order`` (first, unless ``newest``), in two steps.

    The extreme of ``order[0]`` is a number or a time, so a hash aggregate finds it without moving
    or sorting any row; only rows that reach it are then ranked by the rest of ``order`` and a
    digest of the whole row, each partition handing on one row per key. Null keys form a group; null
    values are the smallest. Where ``order[0]`` is a text, all rows are ranked. Of repeated rows
    one stays.
    """
    rows = df
    if order and isinstance(df.schema[order[0]].dataType, _FIXED_WIDTH):
        c = F.col(order[0])
        # Nulls are the smallest values; max and min leave them out.
        best = F.max(c) if newest else F.when(F.count(F.lit(1)) == F.count(c), F.min(c))
        top = df.groupBy(*keys).agg(best.alias("_best"))
        top = top.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_best")
        same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
        rows = df.join(top, [*same, c.eqNullSafe(F.col("_best"))], "left_semi")
    digest = F.xxhash64(*[f.name for f in df.schema.fields if _digestible(f.dataType)])
    ranked = [*(F.col(o) for o in order), digest]
    window = Window.partitionBy(*keys).orderBy(*[x.desc() if newest else x.asc() for x in ranked])
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
