"""All-or-nothing publishing of a run that writes several outputs.

Every attempt at a run writes its outputs into folders of its own, ``{base}/{output}/run=…/attempt=…``.
One empty file below ``{base}/_runs``, created last, makes the attempt the run's result in all outputs
at once: a single object either exists or not in any store, so no reader sees half a run. A run that
is repeated, after a failure or to replace it, becomes a new attempt and takes the place of the one
before. Readers resolve the commits, so what an attempt left behind is never read.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.session import file_system

_COMMITS = "_runs"
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


@dataclass(frozen=True)
class Attempt:
    """One attempt at a run; ``number`` is above those of the run's earlier commits."""

    base: str
    run_id: str
    number: int
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def path(self, output: str) -> str:
        return f"{self.base}/{output}/run={self.run_id}/attempt={self.name}"

    @property
    def commit_file(self) -> str:
        return f"{self.base}/{_COMMITS}/{self.run_id}/{self.number:08d}-{self.name}"


def _commits_of(spark: SparkSession, base: str, run_id: str) -> list[tuple[int, str]]:
    store, folder = file_system(spark, f"{base}/{_COMMITS}/{run_id}")
    found = []
    for status in store.listStatus(folder) if store.exists(folder) else []:
        number, _, name = status.getPath().getName().partition("-")
        if number.isdigit() and name:
            found.append((int(number), name))
    return sorted(found)


def begin(spark: SparkSession, base: str, run_id: str | None = None) -> Attempt:
    """A new attempt at the run; without an id the run is a new one of its own."""
    run_id = run_id or uuid.uuid4().hex
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id is made of letters, digits, '_', '.' and '-': {run_id!r}")
    before = _commits_of(spark, base, run_id)
    return Attempt(base, run_id, before[-1][0] + 1 if before else 1)


def commit(spark: SparkSession, attempt: Attempt) -> None:
    """Make the attempt the run's result. Nothing of it is visible before, all of it after."""
    store, path = file_system(spark, attempt.commit_file)
    store.create(path, False).close()


def committed(spark: SparkSession, base: str) -> list[Attempt]:
    """The attempt that counts of every run: the last one committed."""
    store, folder = file_system(spark, f"{base}/{_COMMITS}")
    found = []
    for status in store.listStatus(folder) if store.exists(folder) else []:
        run_id = status.getPath().getName()
        if commits := _commits_of(spark, base, run_id):
            found.append(Attempt(base, run_id, *commits[-1]))
    return sorted(found, key=lambda a: a.run_id)


def _from_path(name: str, dtype: T.DataType) -> Column:
    """The value of a folder ``name=…`` above a row's file; null for the writers' null folder.

    The path is a URI, and folder names escape special characters once more.
    """
    value = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(name)}=([^/]*)/", 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value).cast(dtype)


def read_published(
    spark: SparkSession,
    base: str,
    output: str,
    schema: T.StructType | str,
    folders: T.StructType | str = "",
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """The rows of one output over all committed runs, in one scan, each with its ``run``.

    ``schema`` holds the columns in the files, ``folders`` those that the writer made folders of, at
    whatever depth.
    """
    own, above = (T.StructType.fromDDL(x) if isinstance(x, str) else x for x in (schema, folders or T.StructType()))
    places = []
    for attempt in committed(spark, base):
        store, path = file_system(spark, attempt.path(output))
        if store.exists(path):
            places.append(attempt.path(output))
    layout = T.StructType([*own.fields, *above.fields, T.StructField("run", T.StringType())])
    if not places:
        return spark.createDataFrame([], layout)
    rows = spark.read.schema(own).options(recursiveFileLookup="true", **options).format(fmt).load(places)
    found = [_from_path(f.name, f.dataType).alias(f.name) for f in layout.fields[len(own.fields) :]]
    return rows.select(*own.fieldNames(), *found)


def drop_superseded(spark: SparkSession, base: str, outputs: list[str]) -> int:
    """Delete the folders of attempts that failed or were replaced; gives their number.

    To be called while no run of this base is being written and no reader holds replaced results.
    """
    kept = {a.path(o) for a in committed(spark, base) for o in outputs}
    dropped = 0
    for output in outputs:
        store, folder = file_system(spark, f"{base}/{output}")
        for run in store.listStatus(folder) if store.exists(folder) else []:
            for attempt in store.listStatus(run.getPath()):
                path = f"{base}/{output}/{run.getPath().getName()}/{attempt.getPath().getName()}"
                if path not in kept:
                    dropped += store.delete(attempt.getPath(), True)
    return dropped
