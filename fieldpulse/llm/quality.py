"""Document quality by an additive model over features of the whole text.

Null and empty texts count as empty and are scored; a null doc_id is never learned from. Repeated
rows each get their score; where labelled rows repeat a doc_id, the one with the least features is
learned from. Without labelled rows all scores are 0.5. Other columns are handed through, whatever
their names; only a column with the name of the score is an error. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.llm.gam import AdditiveModel
from fieldpulse.llm.shingles import word_numbers
from fieldpulse.llm.tables import held_out, pieces, table, unused

SAMPLE = 20_000  # labelled rows that a model is fitted on at most
PIECE = 1 << 21

FEATURES = [
    "log_bytes", "log_words", "mean_word", "longest_word", "white", "digits", "upper", "punctuation",
    "symbols", "beyond_ascii", "entropy", "top_byte", "distinct_words", "top_word", "distinct_pairs",
    "top_pair", "log_lines", "mean_line", "distinct_lines", "stops", "repeats",
]

_KIND = np.zeros(256, np.int64)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[48:58] = 2
_KIND[65:91] = 3
_KIND[97:123] = 4
_KIND[128:] = 5
for _b in b".,;:!?'\"()-":
    _KIND[_b] = 6


def _shares(counts: np.ndarray) -> tuple[float, float]:
    return len(counts) / counts.sum(), counts.max() / counts.sum()


def _one(text: bytes, words: np.ndarray) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    by = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kind = np.bincount(_KIND, by, 7) / n
    p = by[by > 0] / n
    w = len(words)
    longest = max(map(len, text.split()), default=0) if w else 0
    words_left = n * (1 - kind[1])
    distinct = top = pairs = top_pair = repeats = 0.0
    if w:
        distinct, top = _shares(np.unique(words, return_counts=True)[1])
    if w > 1:
        both = words[:-1] * np.uint64(3) + words[1:]
        pairs, top_pair = _shares(np.unique(both, return_counts=True)[1])
        repeats = float((words[1:] == words[:-1]).mean())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        np.log1p(n), np.log1p(w), words_left / max(w, 1), np.log1p(longest), kind[1], kind[2], kind[3], kind[6],
        kind[0], kind[5], float(-(p * np.log2(p)).sum()), by.max() / n, distinct, top, pairs,
        top_pair, np.log1p(len(lines)), np.log1p(n / max(len(lines), 1)), len(set(lines)) / max(len(lines), 1),
        (by[46] + by[33] + by[63]) / max(w, 1), repeats,
    ]


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each whole text; a null counts as empty."""
    words, counts = word_numbers(texts)
    ends = np.cumsum(counts)
    out = np.zeros((len(texts), len(FEATURES)))
    for i, (text, end, count) in enumerate(zip(texts, ends, counts, strict=True)):
        out[i] = _one(text.as_py() or b"", words[end - count : end])
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample: int = SAMPLE,
    text: str = "text",
    id_column: str = "doc_id",
) -> AdditiveModel:
    """A model from at most ``sample`` labelled documents that are not held out.

    They are those with the smallest digests of their id, so the choice depends on the data
    alone. Labels other than 0 and 1 take no part.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1))
    known = known.select(F.col("doc_id").alias("_doc"), F.col(label).cast("double").alias("_label"))
    known = known.orderBy(F.xxhash64("_doc"), "_doc", "_label").limit(sample)  # at most `sample` rows

    def run(batches):
        for batch in pieces(batches, PIECE):
            x = features(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc", "y", "x"]
            )

    plain = docs.select(F.col(id_column).cast("long").alias("_doc"), F.col(text).cast("binary").alias("text"))
    found = plain.join(F.broadcast(known), "_doc").select("text", "_doc", "_label")
    found = found.mapInArrow(run, "doc long, y double, x array<double>")
    found = found.groupBy("doc", "y").agg(F.min("x").alias("x"))  # no more rows than labels
    rows = sorted((tuple(r.x), r.y) for r in found.collect())
    x = np.array([r[0] for r in rows]).reshape(-1, len(FEATURES))
    return AdditiveModel().fit(x, np.array([r[1] for r in rows]))


def scored(
    docs: DataFrame, model: AdditiveModel, text: str = "text", score: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1; every row gets one."""
    if score in docs.columns:
        raise ValueError(f"the column {score} exists already; name another")
    given = docs.columns
    own = unused(given, "_text")
    wide = docs.withColumn(own, F.col(text).cast("binary"))
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches):
        for batch in pieces(batches, PIECE, own):
            s = model.score(features(batch.column(len(given))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s)], names=[*given, score])

    return wide.mapInArrow(run, schema)


def op5_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    plain = scored(docs, model).select("doc_id", "score")
    return plain.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
