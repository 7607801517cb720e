"""Versions of a contract: which ones a reader can read, and reading their files side by side (IO15).

A reader's contract resolves a writer's field by field: numbers are widened, never narrowed; a field
that the writer lacks takes its default or, where the reader allows it, null; a code that the reader
does not list becomes the reader's fallback; fields that the reader lacks are skipped. Whatever does
not resolve is a reason to reject the version as a whole, found from the contracts alone, before any
file is opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.sources.contracts import Contract, ContractField

# Types in order; each may be read as any later one of its line.
_WIDENING = (
    (T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampType()),
)


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if old == new:
        return True
    return any(old in line and new in line and line.index(old) < line.index(new) for line in _WIDENING)


def _field_reasons(old: ContractField | None, new: ContractField, fallback: str | None) -> list[str]:
    if old is None:
        return [] if new.nullable or new.default is not None else [f"missing:{new.name}"]
    reasons = []
    if not _widens(old.type, new.type):
        reasons.append(f"type:{new.name}:{old.type.simpleString()}->{new.type.simpleString()}")
    if old.nullable and not new.nullable and new.default is None:
        reasons.append(f"nullable:{new.name}")
    if new.enum and fallback is None:
        unknown = ["any text"] if not old.enum else sorted(set(old.enum) - set(new.enum))
        if unknown:
            reasons.append(f"enum:{new.name}:{','.join(unknown)}")
    if fallback is not None and fallback not in (new.enum or ()):
        reasons.append(f"fallback:{new.name}:{fallback}")
    return reasons


def backward_reasons(
    writer: Contract, reader: Contract, fallbacks: Mapping[str, str] | None = None
) -> list[str]:
    """Why the reader cannot read what the writer wrote, in the reader's order; empty if it can.

    A field that may be null for the writer only is read where the reader has a default for it.
    """
    fallbacks = fallbacks or {}
    written = {f.name: f for f in writer.fields}
    return [r for f in reader.fields for r in _field_reasons(written.get(f.name), f, fallbacks.get(f.name))]


def transitive_reasons(
    versions: Sequence[Contract], fallbacks: Mapping[str, str] | None = None
) -> dict[tuple[int, int], list[str]]:
    """The same for every pair (older, newer) of a contract's history that does not resolve."""
    pairs = ((i, j) for j in range(len(versions)) for i in range(j))
    found = {(i, j): backward_reasons(versions[i], versions[j], fallbacks) for i, j in pairs}
    return {pair: reasons for pair, reasons in found.items() if reasons}


def resolve(
    df: DataFrame, writer: Contract, reader: Contract, fallbacks: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows of the writer's contract in the reader's columns; an error where it does not resolve."""
    fallbacks = fallbacks or {}
    if reasons := backward_reasons(writer, reader, fallbacks):
        raise ValueError(f"{reader.name} cannot read {writer.name}: {'; '.join(reasons)}")
    written = set(writer.names)

    def value(field: ContractField) -> Column:
        column = F.col(f"`{field.name}`") if field.name in written else F.lit(None)
        if field.name in fallbacks and field.name in written:
            known = column.isNull() | column.isin(*field.enum)
            column = F.when(known, column).otherwise(F.lit(fallbacks[field.name]))
        column = column.cast(field.type)
        if field.default is not None:
            column = F.coalesce(column, F.lit(field.default).cast(field.type))
        return column.alias(field.name)

    return df.select(*[value(f) for f in reader.fields])


def read_versions(
    spark: SparkSession,
    files: Mapping[str, tuple[Contract, Sequence[str]]],
    reader: Contract,
    fallbacks: Mapping[str, str] | None = None,
    version: str = "version",
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Files of several versions as the reader's rows, and the rejected versions with their reasons.

    ``files`` names each version's contract and paths. Each group is read with its writer's schema,
    so nothing is inferred from footers, and only columns that the reader has are read.
    """
    frames, rejected = [], {}
    for name, (writer, paths) in files.items():
        if reasons := backward_reasons(writer, reader, fallbacks):
            rejected[name] = reasons
            continue
        rows = spark.read.schema(writer.schema).parquet(*paths)
        frames.append(resolve(rows, writer, reader, fallbacks).withColumn(version, F.lit(name)))
    if not frames:
        empty = T.StructType([*reader.schema.fields, T.StructField(version, T.StringType())])
        return spark.createDataFrame([], empty), rejected
    return reduce(DataFrame.unionByName, frames), rejected
