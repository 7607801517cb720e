"""Training corpus from documents: quality, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. ``run`` writes
every stage's result to the shared folder and reads it again for the next one.

All stages take null and empty texts, null and repeated doc_ids, repeated rows, very long texts and
empty tables, and hand other columns through whatever their names: null and empty texts are scored
like any other, are equal to each other for the exact copies (one of them stays), have no words and
so no near copies, hold no personal data, and give no sequence tokens. The last stage's columns are
those of ``packing.packed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import exact_dedup, near_dedup, packing, pseudonyms, quality
from fieldpulse.llm.tables import table, unused, written
from fieldpulse.llm.word_tokens import default_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores 0.5 or more; null and empty texts are scored too."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs.columns, "_score")
    return quality.scored(docs, model, score=score).where(F.col(score) >= 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share 80 % of their five-word shingles, the one with the smallest doc_id."""
    return near_dedup.keep_one(docs, percent=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in all texts; n_chars follows."""
    found = pseudonyms.pseudonymised(docs, pseudonyms.session_key(spark))
    if "n_chars" not in docs.columns:
        return found
    length = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", length)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences with their ids in buckets and batches, as ``packing.packed`` describes."""
    return packing.packed(docs, default_path(), with_ids=True)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pseudonyms", hide_personal_data),
    ("packing", pack),
]

#: Trained models, registers and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
