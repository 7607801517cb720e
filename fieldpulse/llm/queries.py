"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldpulse.llm import alignment, exact_dedup, exact_topk, grid_join, language, merkle, near_dedup, packing, pseudonyms, quality, sentence_pieces, token_files, url_trust

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op11_token_alignment": alignment.op11_token_alignment,
    "op12_grid_near_dedup": grid_join.op12_grid_near_dedup,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
    "op7_length_buckets": packing.op7_length_buckets,
    "op2_feistel_pseudonyms": pseudonyms.op2_feistel_pseudonyms,
    "op3_recurrent_language": language.op3_recurrent_language,
    "op5_additive_quality": quality.op5_additive_quality,
    "op6_norm_sorted_topk": exact_topk.op6_norm_sorted_topk,
    "op8_url_trust": url_trust.op8_url_trust,
    "op4_rans_token_files": token_files.op4_rans_token_files,
    "op1_sentence_pieces": sentence_pieces.op1_sentence_pieces,
    "op9_setsketch_near_dedup": near_dedup.op9_setsketch_near_dedup,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
}
ORACLES: dict[str, str] = {
    "op12_grid_near_dedup": grid_join.SQL,
    "op13_merkle_manifest": merkle.SQL,
    "op6_norm_sorted_topk": exact_topk.SQL,
    "op8_url_trust": url_trust.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
}
