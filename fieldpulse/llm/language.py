"""Language of whole texts by a recurrent network over bytes.

The network reads runs of at most ``STEPS`` bytes: words, and parts of longer words. It labels
every byte; a document's probabilities are the means over all of its bytes. Equal runs have
equal labels, so each distinct one is computed once while it stays in memory.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.llm.gru import ByteNetwork, packed
from fieldpulse.llm.tables import held_out, pieces, table, unused

STEPS = 24
UNKNOWN = "und"
DOCS = 300  # documents of each language that the network learns from at most
RUNS = 150  # runs that each of them gives at most, evenly over the whole text
ROUNDS = 300
PIECE = 1 << 21
_KEPT = 200_000
_LETTER = re.compile(r"[^\W\d_]")


def runs_of(text: bytes) -> list[bytes]:
    words = text.split()
    if max(map(len, words), default=0) <= STEPS:
        return words
    return [w[i : i + STEPS] for w in words for i in range(0, len(w), STEPS)]


def has_letter(text: bytes) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text.decode("utf-8", "replace")))


class LanguageModel:
    def __init__(self, languages: list[str], network: ByteNetwork | None):
        self.languages, self.network = languages, network
        self.index: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(languages)), np.float32)

    def __getstate__(self):
        return {"languages": self.languages, "network": self.network}

    def __setstate__(self, state):
        self.__init__(**state)

    def _learn(self, runs: list[bytes]) -> None:
        """Adds the summed byte probabilities of new runs."""
        runs.sort(key=len)
        found = []
        for start in range(0, len(runs), 8192):
            part = runs[start : start + 8192]
            grid, lengths = packed(part, len(part[-1]))
            prob = self.network.probabilities(grid, lengths)
            live = np.arange(grid.shape[1])[:, None] < lengths[None, :]
            found.append((prob * live[:, :, None]).sum(axis=0))
        for run in runs:
            self.index[run] = len(self.index)
        self.sums = np.concatenate((self.sums, *found))

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """(language, its mean probability) of each text."""
        if len(self.index) > _KEPT:
            self.index, self.sums = {}, self.sums[:0]
        names, scores = [], []
        pending = [runs_of(t) for t in texts]
        fresh = {r for runs in pending for r in runs} - self.index.keys() if self.network else ()
        if fresh:
            self._learn(sorted(fresh))
        for text, runs in zip(texts, pending, strict=True):
            if not self.languages or not runs or not has_letter(text):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            at = np.fromiter(map(self.index.__getitem__, runs), np.int64, len(runs))
            mean = self.sums[at].sum(axis=0, dtype=np.float64) / sum(map(len, runs))
            best = int(mean.argmax())
            names.append(self.languages[best])
            scores.append(round(min(1.0, float(mean[best])), 6))
        return names, scores


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    id_column: str = "doc_id",
    docs_per_language: int = DOCS,
    rounds: int = ROUNDS,
) -> LanguageModel:
    """A model from a bounded sample of documents that are not held out.

    Of each language, the ``docs_per_language`` documents with the smallest digests of their id
    give at most ``RUNS`` runs each. Without any such document all texts are ``und``.
    """
    use = docs.where(~held_out(F.col(id_column)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    ranked = use.select(F.col(id_column).alias("_doc"), F.col(lang).alias("_lang")).selectExpr(
        "*", "row_number() OVER (PARTITION BY _lang ORDER BY xxhash64(_doc), _doc) AS _rank"
    )
    sample = ranked.where(F.col("_rank") <= docs_per_language).select("_doc", "_lang").distinct()

    def run(batches):
        for batch in pieces(batches, PIECE):
            kept = []
            for t in batch.column(0):
                runs = runs_of(t.as_py())
                kept.append(runs[:: max(1, -(-len(runs) // RUNS))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.list_(pa.binary())), batch.column(1)], names=["runs", "lang"]
            )

    # No more rows than documents per language times languages.
    found = (
        use.select(F.col(id_column).alias("_doc"), F.col(lang).alias("_lang"), F.col(text).cast("binary").alias("text"))
        .join(F.broadcast(sample), ["_doc", "_lang"])
        .select("text", "_lang")
        .mapInArrow(run, "runs array<binary>, lang string")
    )
    rows = sorted((r.lang, [bytes(x) for x in r.runs]) for r in found.collect())
    languages = sorted({name for name, _ in rows})
    runs = [x for _, own in rows for x in own]
    if not runs:
        return LanguageModel([], None)
    labels = np.array([languages.index(name) for name, own in rows for _ in own])
    share = np.bincount(labels, minlength=len(languages))
    weights = 1.0 / share[labels]
    network = ByteNetwork(len(languages))
    network.train(runs, labels, weights / weights.sum(), STEPS, rounds)
    return LanguageModel(languages, network.single())


def identified(docs: DataFrame, model: LanguageModel, text: str = "text", names=("lang_pred", "lang_score")) -> DataFrame:
    """``docs`` with the predicted language and its probability; ``und``, 0 without any letter."""
    if set(names) & set(docs.columns):
        raise ValueError(f"the columns {names} exist already; name others")
    given, own = docs.columns, unused(docs.columns, "_text")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    )

    def run(batches):
        for batch in pieces(batches, PIECE, own):
            found, scores = model.predict([t.as_py() or b"" for t in batch.column(len(given))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*given, *names]
            )

    return docs.withColumn(own, F.col(text).cast("binary")).mapInArrow(run, schema)


def op3_recurrent_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"))
    found = identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
