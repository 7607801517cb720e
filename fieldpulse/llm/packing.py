"""Sequences in length buckets with the least padding, batched by token budget.

The histogram of all sequence lengths is global; dynamic programming over it chooses at most
``BUCKETS`` bucket lengths with the least total padding. Inside each bucket, sequences are
numbered in a random but fixed order and as many as the token budget allows form a batch.

A text longer than ``LONGEST`` tokens gives several sequences; nothing is cut off. So the
histogram has at most ``LONGEST`` entries, whatever the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm.tables import pieces, table, written
from fieldpulse.llm.word_tokens import default_path, tokenizer

LONGEST = 2048
BUCKETS = 16
BUDGET = 65_536  # tokens of a batch, padding included
PIECE = 1 << 21
PER_SLOT = 2000
SLOTS = 65_536

_SEQUENCES = "doc_id long, digest long, chunk int, start long, n_tokens int, ids binary"


def optimal_lengths(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` bucket lengths that give the least padding; the last is the largest.

    ``lengths`` ascend. Each sequence goes to the shortest bucket that holds it.
    """
    m = len(lengths)
    if not m:
        return []
    count = np.concatenate(([0], np.cumsum(counts))).astype(np.float64)
    tokens = np.concatenate(([0], np.cumsum(lengths * counts))).astype(np.float64)
    best = np.full(m + 1, np.inf)
    best[0] = 0.0
    choice = []
    for _ in range(min(buckets, m)):
        new, back = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        new[0] = 0.0
        for start in range(1, m + 1, 256):
            j = np.arange(start, min(start + 256, m + 1))
            i = np.arange(j[-1])
            cost = lengths[j - 1][None, :] * (count[j][None, :] - count[i][:, None]) - (tokens[j][None, :] - tokens[i][:, None])
            total = np.where(i[:, None] < j[None, :], best[i][:, None] + cost, np.inf)
            back[j] = total.argmin(axis=0)
            new[j] = total.min(axis=0)
        choice.append(back)
        best = new
    ends, j = [], m
    for back in reversed(choice):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = int(back[j])
    return ends[::-1]


def sequences(
    docs: DataFrame, path: str, longest: int = LONGEST, with_ids: bool = False, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """One row per run of at most ``longest`` tokens; a text without tokens gives one of none."""

    def run(batches):
        own = tokenizer(path)
        size = own.kind.itemsize
        for batch in pieces(batches, PIECE):
            rows: list[list] = [[], [], [], [], [], []]
            doc_ids, digests, texts = (batch.column(i).to_pylist() for i in range(3))
            encoded = own.packed([t or b"" for t in texts])
            for doc_id, digest, ids in zip(doc_ids, digests, encoded, strict=True):
                total = len(ids) // size
                for chunk, start in enumerate(range(0, max(total, 1), longest)):
                    n = min(longest, total - start)
                    part = ids[start * size : (start + n) * size] if with_ids else None
                    for column, value in zip(rows, (doc_id, digest, chunk, start, n, part), strict=True):
                        column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
                names=["doc_id", "digest", "chunk", "start", "n_tokens", "ids"],
            )

    plain = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("digest"),
        F.col(text).cast("binary").alias("text"),
    )
    return plain.mapInArrow(run, _SEQUENCES)


def packed(
    docs: DataFrame,
    path: str,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    with_ids: bool = False,
    text: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per sequence: doc_id, chunk, start, n_tokens, bucket_length, batch, place.

    ``batch`` counts over all buckets, ``place`` within the batch; only the last batch of a
    bucket may be short. A sequence without tokens is in no batch (nulls). ``with_ids`` adds the
    ids, packed as the tokenizer does (``kind``). Repeated rows are packed as often as they occur.
    """
    found = written(sequences(docs, path, longest, with_ids, text, id_column), "sequences")
    histogram = sorted((r.n_tokens, r.n) for r in found.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    histogram = [x for x in histogram if x[0] > 0]  # no more entries than the longest sequence has tokens
    lengths, counts = np.array([x[0] for x in histogram], np.int64), np.array([x[1] for x in histogram], np.int64)
    ends = optimal_lengths(lengths, counts, buckets)
    names = ["doc_id", "chunk", "start", "n_tokens", "bucket_length", "batch", "place"] + ["ids"] * with_ids
    empty = found.where("n_tokens = 0").selectExpr(
        "*", "CAST(NULL AS INT) AS bucket_length", "CAST(NULL AS BIGINT) AS batch", "CAST(NULL AS BIGINT) AS place"
    )
    if not ends:
        return empty.select(*names)
    of = np.searchsorted(ends, lengths)
    held = np.bincount(of, counts, len(ends)).astype(np.int64)
    room = [max(1, budget // e) for e in ends]
    first = np.concatenate(([0], np.cumsum([-(-int(h) // r) for h, r in zip(held, room, strict=True)])))
    slots = int(min(SLOTS, max(1, -(-int(counts.sum()) // PER_SLOT))))
    bucket_length, start_batch, capacity = F.lit(ends[-1]), F.lit(int(first[len(ends) - 1])), F.lit(room[-1])
    for k in range(len(ends) - 2, -1, -1):
        inside = F.col("n_tokens") <= ends[k]
        bucket_length = F.when(inside, ends[k]).otherwise(bucket_length)
        start_batch = F.when(inside, int(first[k])).otherwise(start_batch)
        capacity = F.when(inside, room[k]).otherwise(capacity)
    placed = found.where("n_tokens > 0").withColumns(
        {"bucket_length": bucket_length, "mixed": F.xxhash64("doc_id", "digest", "chunk")}
    )
    placed = placed.withColumn("slot", F.pmod("mixed", F.lit(slots)))
    before = placed.groupBy("bucket_length", "slot").agg(F.count("*").alias("n")).selectExpr(
        "bucket_length", "slot", "sum(n) OVER (PARTITION BY bucket_length ORDER BY slot) - n AS before"
    )
    numbered = placed.selectExpr(
        "*", "row_number() OVER (PARTITION BY bucket_length, slot ORDER BY mixed, doc_id, digest, chunk) - 1 AS k"
    ).join(before, ["bucket_length", "slot"])
    place = F.col("before") + F.col("k")
    numbered = numbered.withColumns(
        {
            "batch": (start_batch + F.floor(place / capacity)).cast("long"),
            "place": F.pmod(place, capacity).cast("long"),
        }
    )
    return numbered.select(*names).unionByName(empty.select(*names))


def op7_length_buckets(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), path or default_path(), with_ids=True)
