"""Input tables and intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.session import file_system, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the folder that all executors share.

    Cuts the lineage, fixes values such as generated ids, and outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that ``written`` gave, once no frame reads it any more."""
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        store, folder = file_system(spark, files[0].rsplit("/", 1)[0])
        store.delete(folder, True)


def unused(columns: list[str], name: str) -> str:
    """``name``, or the first of it with underscores behind that is no column yet."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id) -> F.Column:
    """True for the third of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def pieces(batches, most_bytes: int, column: str | int = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``most_bytes`` of text each, of lists so many entries.

    A longer text makes a run of its own, so memory follows the longest text.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(batch.schema.get_field_index(column) if isinstance(column, str) else column)
        measure = pc.list_value_length if pa.types.is_list(sizes.type) else pc.binary_length
        lengths = pc.fill_null(measure(sizes), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if i > start and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def matched(rows: DataFrame, classes: DataFrame, key: str, times: str, most: int = 4096) -> DataFrame:
    """``rows`` joined with ``classes`` on ``key``, where ``times`` tells how many rows a class has.

    Classes with more than one in ``most`` of all rows are fewer than ``most``, so they are sent to
    all tasks; the others are joined by a shuffle, and no task gets a popular key's rows.
    """
    total = classes.agg(F.sum(times)).first()[0] or 0
    hot = classes.where(F.col(times) * most > total)
    marks = F.broadcast(hot.select(key))
    cold = classes.join(marks, key, "left_anti")
    popular = rows.join(F.broadcast(hot), key)
    return popular.unionByName(rows.join(marks, key, "left_anti").join(cold, key))
