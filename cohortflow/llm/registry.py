"""The queries of the corpus operators, op1 to op13 and the pipeline, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cohortflow.llm import bpe, hard_negatives, language_id, media, mixing, near_join, packing, prefix_trie, secrets, sharding, token_counts, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts.query,
    "op2_ngram_jaccard_join": near_join.query,
    "op3_mixing": mixing.query,
    "op4_language_id": language_id.query,
    "op5_toxicity": toxicity.query,
    "op6_secret_scans": secrets.query,
    "op7_packing": packing.query,
    "op8_sharding": sharding.query,
    "op9_media_columns": media.query,
    "op10_exact_top_k": topk.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_bpe": bpe.query,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": near_join.SQL,
    "op3_mixing": mixing.SQL,
    "op6_secret_scans": secrets.SQL,
    "op8_sharding": sharding.SQL,
    "op10_exact_top_k": topk.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
