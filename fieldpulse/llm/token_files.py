"""Token ids in compressed files.

Documents are encoded once, their ids are counted, sorted by document id over ranges, and
written as frames (``rans``): each row of the files holds one frame with the ids of some whole
documents, in order. Rows are in the container format of Spark's own writer, so any store that
Spark reaches will do and a lost task leaves nothing behind. A reader needs a frame and the
frequency table only; checkpoints inside let it start at any block.

Layout of a folder: ``ids/`` with part, frame, first (tokens before it in the part), doc_ids,
sizes, body; ``table/`` with the counts of the ids. Parts follow the ids' order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import rans
from fieldpulse.llm.tables import pieces, table, written
from fieldpulse.llm.word_tokens import default_path, tokenizer
from fieldpulse.session import scratch_dir

KIND = np.dtype("<u4")
PART = 1 << 24
FRAME = 1 << 20
SENT_PARTS = 100_000
PIECE = 1 << 21

_FRAMES = "part int, frame int, first long, doc_ids array<long>, sizes array<long>, body binary"


def token_ids(
    docs: DataFrame, path: str, end: int | None = 1, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """doc_id and ids of each row's whole text, packed as the tokenizer does (``kind``).

    A null text is an empty one.
    """

    def run(batches):
        own = tokenizer(path)
        tail = b"" if end is None else np.array([end], own.kind).tobytes()
        for batch in pieces(batches, PIECE):
            ids = [x + tail for x in own.packed([t.as_py() or b"" for t in batch.column(1)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return plain.mapInArrow(run, "doc_id long, ids binary")


def _counted(kind: np.dtype):
    """(id, times) for all batches of a task."""

    def run(batches):
        counts = np.zeros(1, np.int64)
        for batch in batches:
            for part in pieces([batch], PIECE, "ids"):
                found = np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), kind))
                if len(found) > len(counts):
                    counts = np.pad(counts, (0, len(found) - len(counts)))
                counts[: len(found)] += found
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "times"])

    return run


def _lists(values: list[list]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def _framed(counts: np.ndarray, frame_tokens: int, kind: np.dtype):
    def run(batches):
        freq = rans.Frequencies(counts)
        part = TaskContext.get().partitionId()
        number = first = size = 0
        ids: list[bytes] = []
        names: list[int | None] = []

        def frame():
            tokens = np.frombuffer(b"".join(ids), kind)
            body = rans.encode(tokens, freq)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([first], pa.int64()),
                    _lists([names]),
                    _lists([[len(x) // kind.itemsize for x in ids]]),
                    pa.array([body], pa.binary()),
                ],
                names=["part", "frame", "first", "doc_ids", "sizes", "body"],
            )

        for batch in batches:
            for doc_id, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = row.as_py()
                ids.append(own)
                names.append(doc_id)
                size += len(own) // kind.itemsize
                if size >= frame_tokens:
                    yield frame()
                    number, first, size, ids, names = number + 1, first + size, 0, [], []
        if ids:
            yield frame()

    return run


def write_tokens(
    tokens: DataFrame, folder: str, kind: np.dtype = KIND, part: int = PART, frame: int = FRAME
) -> str:
    """Writes doc_id, ids (packed numbers of ``kind``) in ascending order of doc_id, nulls first."""
    tokens = written(tokens, "token-ids")
    counts = tokens.select("ids").mapInArrow(_counted(kind), "id long, times long").groupBy("id").agg(F.sum("times").alias("times"))
    counts.coalesce(1).write.parquet(f"{folder}/table")
    table_counts = _counts(tokens.sparkSession, folder)
    parts = max(1, -(-int(table_counts.sum()) // part))
    ordered = tokens.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(_framed(table_counts, frame, kind), _FRAMES).write.parquet(f"{folder}/ids")
    return folder


def _counts(spark: SparkSession, folder: str) -> np.ndarray:
    """Counts by id: no more rows than the vocabulary has ids."""
    rows = spark.read.parquet(f"{folder}/table").collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.times
    return counts


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the packed ids) and, on demand, the packed ids."""
    counts = _counts(spark, folder)

    def run(batches):
        freq = rans.Frequencies(counts)
        for batch in batches:
            for i in range(batch.num_rows):
                names, sizes = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                body = rans.decode(batch.column(5)[i].as_py(), freq).astype(KIND, copy=False).tobytes()
                edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                if edges[-1] * KIND.itemsize != len(body):
                    raise rans.Damaged("sizes of the documents")
                cuts = (edges * KIND.itemsize).tolist()
                ids = [body[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                columns = [
                    pa.array([batch.column(0)[i].as_py()] * len(names), pa.int32()),
                    pa.array(names, pa.int64()),
                    pa.array(edges[:-1] + batch.column(2)[i].as_py()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names_out)

    names_out = ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    frames = spark.read.schema(_FRAMES).parquet(f"{folder}/ids")
    # One row for each part, which stands for PART tokens: the tokens of the parts before it.
    sizes = frames.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = sizes.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS before")
    highest = frames.agg(F.max("part")).first()[0] or 0
    # Sent to all executors up to a proven size; more parts are joined by a shuffle.
    before = F.broadcast(before) if highest < SENT_PARTS else before
    rows = frames.mapInArrow(run, schema).join(before, "part")
    return rows.withColumn("start", F.col("start") + F.col("before")).select(*names_out[1:])


def op4_rans_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or default_path()
    tokens = token_ids(table(spark, sf_dir, "documents"), path)
    folder = write_tokens(tokens, scratch_dir(spark, "token-files"), tokenizer(path).kind)
    return read_tokens(spark, folder, with_ids=False)
