"""From raw documents to packed sequences: the stages, each an operator over all that the one before kept.

Stages take ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import common, mixing, near_join, packing, secrets, toxicity
from cohortflow.llm.common import cut, documents


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from their labels scores as toxic go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by three quarters of their shingles, directly or through others, the one with the least id stays."""
    return near_join.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, and credential parts that complete each other, are replaced in the texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources come near their target weights."""
    return mixing.remix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, every source in its share of each window."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


NAMED: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def chain() -> list[tuple[str, Stage]]:
    """The stages of one run: each first removes what the one before it wrote on its way, whose result has been written by then.

    The first removes nothing, and what the last wrote stays, so that results of other runs can still be read.
    """
    passed: list[str] = []

    def link(place: int, f: Stage) -> Stage:
        def one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if place:
                common.remove_tables(spark, only=passed)
            before = set(common.written)
            out = f(spark, docs, sf_dir)
            passed[:] = [p for p in common.written if p not in before]
            return out

        return one

    return [(name, link(i, f)) for i, (name, f) in enumerate(NAMED)]


STAGES = chain()

#: No SQL expresses the learned stage, or the tokenizer's; tests hold each stage and run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in their order. What a stage wrote on its way, and its result, is removed once the next one's result stands."""
    docs, stood = documents(spark, sf_dir), None
    *stages, (_, last) = chain()
    for name, f in stages:
        docs = cut(f(spark, docs, sf_dir), f"stage-{name}")
        if stood:
            common.remove_tables(spark, only=[stood])
        stood = common.written[-1]
    return last(spark, docs, sf_dir)
