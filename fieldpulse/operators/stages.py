"""User-supplied record functions with checked properties and failures kept apart (UD1)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

STAGE_ERROR = "stage_error"
LIKELY = 2  # failing records expected in a part from which on it is not tried as a whole
_ADDED = T.StructType([T.StructField("error_reason", T.StringType()), T.StructField("error_text", T.StringType())])

RecordFunction = Callable[[pd.DataFrame, Mapping[str, object]], pd.DataFrame]


@dataclass(frozen=True)
class Property:
    """A setting of a stage. Texts are read as ``kind``; bounds and choices hold for its value."""

    name: str
    kind: type = str
    default: object = None
    required: bool = False
    low: float | None = None
    high: float | None = None
    choices: tuple = ()


_BOOLEANS = {"true": True, "false": False}


def _read(prop: Property, value: object) -> object:
    try:
        if prop.kind is bool and isinstance(value, str):
            return _BOOLEANS[value.strip().lower()]
        return prop.kind(value)
    except (KeyError, TypeError, ValueError):
        raise ValueError(f"{prop.name}: {value!r} is no {prop.kind.__name__}") from None


def settings(properties: Sequence[Property], given: Mapping[str, object]) -> dict[str, object]:
    """The stage's settings, checked before any task runs; all faults are named at once."""
    faults = [f"{n}: not a property" for n in sorted(set(given) - {p.name for p in properties})]
    found = {}
    for prop in properties:
        value = given.get(prop.name, prop.default)
        if value is None:
            if prop.required:
                faults.append(f"{prop.name}: required")
            found[prop.name] = None
            continue
        try:
            value = found[prop.name] = _read(prop, value)
        except ValueError as e:
            faults.append(str(e))
            continue
        if prop.low is not None and not value >= prop.low:
            faults.append(f"{prop.name}: {value!r} is below {prop.low!r}")
        if prop.high is not None and not value <= prop.high:
            faults.append(f"{prop.name}: {value!r} is above {prop.high!r}")
        if prop.choices and value not in prop.choices:
            faults.append(f"{prop.name}: {value!r} is none of {prop.choices!r}")
    if faults:
        raise ValueError("; ".join(faults))
    return found


def _applied(fn: RecordFunction, rows: pd.DataFrame, config: dict, added: pa.Schema) -> list[pa.Array]:
    """The function's columns for these rows, in their declared types."""
    n = len(rows)
    result = fn(rows, config)
    if len(result) != n:
        raise ValueError(f"{len(result)} rows returned for {n}")
    return [pa.Array.from_pandas(result[f.name], type=f.type) for f in added]


def _frames(rows: pa.RecordBatch) -> Callable[[int, int], pd.DataFrame]:
    """Rows from one place to another as a frame of their own, as if converted alone.

    Where no type depends on which rows are converted together, all are converted once.
    """
    for column in rows.columns:
        counted = pa.types.is_integer(column.type) or pa.types.is_boolean(column.type)
        if pa.types.is_nested(column.type) or (counted and column.null_count):
            return lambda start, stop: rows.slice(start, stop - start).to_pandas()
    whole = rows.to_pandas()

    def part(start: int, stop: int) -> pd.DataFrame:
        own = whole.iloc[start:stop].copy()  # the function may write into it
        own.index = pd.RangeIndex(stop - start)
        return own

    return part


def isolated(
    fn: RecordFunction,
    adds: str | T.StructType,
    properties: Sequence[Property] = (),
    given: Mapping[str, object] | None = None,
) -> Callable[[DataFrame], DataFrame]:
    """A record function as a transform for ``plans.flow.stage``.

    ``fn`` takes a pandas frame of any number of records and the settings, and gives the columns
    ``adds`` for them, in their order; records are independent of each other. Where it raises, or
    its result does not fit, the batch is halved until the records that fail stand alone, so k bad
    records of n cost about k·log n calls. Once one has failed, a part is halved without a call if it
    is bound to fail, as the half before it passed, or likely to, by the share of failing records so
    far. Failing records have null columns, ``error_reason``
    "stage_error" and the error as ``error_text``; all others are as if the bad ones were not there.
    """
    config = settings(properties, given or {})

    def run(df: DataFrame) -> DataFrame:
        new = adds if isinstance(adds, T.StructType) else T.StructType.fromDDL(adds)
        taken = {f.name for f in (*new.fields, *_ADDED.fields)} & set(df.columns)
        if taken:
            raise ValueError(f"columns that the stage adds are there already: {sorted(taken)}")
        schema = T.StructType([*df.schema.fields, *new.fields, *_ADDED.fields])
        added = to_arrow_schema(new)

        def judged(rows: pa.RecordBatch) -> pa.RecordBatch:
            frame = _frames(rows)
            found: list[list[pa.Array]] = []
            reasons, texts = [None] * rows.num_rows, [None] * rows.num_rows
            failures = 0
            # Parts in their order: from, to, whether the other half of a failed part follows, and
            # whether the part is bound to fail, as the half before it passed.
            todo = [(0, rows.num_rows, False, False)]
            while todo:
                start, stop, followed, bound = todo.pop()
                single = stop - start == 1
                columns = None
                likely = failures * (stop - start) > LIKELY * start  # by the rows before, all judged
                if single or not (likely or (bound and failures)):
                    try:
                        columns = _applied(fn, frame(start, stop), config, added)
                    except Exception as e:  # whatever a user's function raises
                        if single:
                            columns = [pa.nulls(1, f.type) for f in added]
                            reasons[start], texts[start] = STAGE_ERROR, f"{type(e).__name__}: {e}"
                            failures, followed = failures + 1, False
                if columns is None:
                    half = (start + stop) // 2
                    todo += [(half, stop, False, False), (start, half, True, False)]
                    continue
                found.append(columns)
                if followed:
                    todo.append((*todo.pop()[:3], True))
            new_columns = [pa.concat_arrays(pieces) for pieces in zip(*found, strict=True)]
            marks = [pa.array(x, pa.string()) for x in (reasons, texts)]
            return pa.RecordBatch.from_arrays([*rows.columns, *new_columns, *marks], names=schema.fieldNames())

        def all_judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield judged(batch)

        return df.mapInArrow(all_judged, schema)

    return run
