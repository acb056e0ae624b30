"""Toxicity by FTRL-proximal logistic regression (operator 5).

Features are hashed: words, their beginnings (which stand for inflected forms), pairs of
neighbours, and pairs with one word skipped; each counts once in a text. Learning rates are
per coordinate, and an L1 penalty keeps most weights at zero, so what goes to the tasks is a
few thousand numbers. Trained in one task on a bounded sample of labelled rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import cut, documents
from cohortflow.llm.language_id import letters, word_spans
from cohortflow.llm.sampling import bounded, held_out, once
from cohortflow.llm.shingles import mix, release, spans_hash, text_slices

BITS = 20
#: At most about so many labelled rows are learned from.
TRAIN_ROWS = 16_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.1
#: A bucket's sum moves by less than one a row and epoch, so buckets of fewer rows never pass the L1 penalty.
MIN_ROWS = int(L1 // EPOCHS) + 1
PREFIXES = (3, 4, 5, 6, 7)
CUT = 0.3


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family, the bucket of every feature and the text it is from."""
    text = letters(data)
    starts, ends = word_spans(text, offsets)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    values = text.astype(np.uint64)
    mask = np.uint64((1 << BITS) - 1)
    word = spans_hash(values, starts, ends)
    yield (word & mask).astype(np.int64), owner
    for k in PREFIXES:
        # A beginning is the whole of the word's letters so far; a word that is no longer has none of its own.
        at = ends - starts > k
        stem = mix(spans_hash(values, starts[at], starts[at] + k) + np.uint64(k))
        yield (stem & mask).astype(np.int64), owner[at]
    for skip in (1, 2):
        if len(word) > skip:
            same = owner[skip:] == owner[:-skip]
            pair = mix(word[:-skip] * np.uint64(3) + word[skip:] + np.uint64(skip))
            yield (pair & mask).astype(np.int64)[same], owner[:-skip][same]


@dataclass
class Model:
    at: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Probability of each text; ``table`` is all weights by bucket."""
        n = len(offsets) - 1
        keys = []
        for at, owner in features(data, offsets):
            hit = table[at] != 0
            keys.append(owner[hit] << BITS | at[hit])
        keys = np.unique(np.concatenate(keys))
        sums = np.bincount(keys >> BITS, weights=table[keys & ((1 << BITS) - 1)], minlength=n) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -30, 30)))

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.at] = self.weight
        return out


def train(at_all: np.ndarray, bounds: np.ndarray, y: np.ndarray, seed: int = 5) -> Model:
    """FTRL-proximal over the rows' distinct buckets ``at_all[bounds[i]:bounds[i + 1]]``, in a shuffled order each epoch."""
    draw = np.random.default_rng(seed)
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    free = 1 << BITS  # the bias has no penalty

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(z[at]) <= L1] = 0
        w[-1] = -z[free] / ((BETA + np.sqrt(n[free])) / ALPHA)
        return w

    for _ in range(EPOCHS):
        for i in draw.permutation(len(y)).tolist():
            at = np.append(at_all[bounds[i] : bounds[i + 1]], free)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y[i]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    everything = np.arange((1 << BITS) + 1)
    w = weights(everything)
    at = np.flatnonzero(w[:-1])
    return Model(at, w[at], float(w[-1]))


def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text, toxic`` to the text's distinct buckets. A task sends an id once, however often it repeats."""
    sent: set[int] = set()
    for batch in batches:
        new = once(batch.column(0).to_pylist(), sent)
        batch = batch if all(new) else batch.filter(pa.array(new))
        for first, data, offsets in text_slices(batch.column(1)):
            at, owner = (np.concatenate(x) for x in zip(*features(data, offsets), strict=True))
            keys = np.unique(owner << BITS | at)
            edges = np.searchsorted(keys, np.arange(len(offsets)) << BITS)
            low = (keys & ((1 << BITS) - 1)).astype(np.int32)
            n = len(offsets) - 1
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array([low[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], names=["doc_id", "toxic", "at"])
    release()


def train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sample's rows to one model. Buckets of fewer than ``MIN_ROWS`` rows are left out: their weights stay zero."""
    ids, toxic, sizes, parts = [], [], [], []
    for b in batches:
        ids += b.column("doc_id").to_pylist()
        toxic += b.column("toxic").to_pylist()
        sizes += [len(a.as_buffer()) // 4 for a in b.column("at")]
        parts += [np.frombuffer(a.as_buffer(), dtype=np.int32) for a in b.column("at")]
    if not ids:
        return
    # One array for all rows, in order of their ids, whatever order they came in; an id that several tasks sent counts once.
    order = sorted(range(len(ids)), key=ids.__getitem__)
    order = [i for n, i in enumerate(order) if not n or ids[i] != ids[order[n - 1]]]
    at = np.concatenate([parts[i] for i in order])
    del parts, b
    release()
    bounds = np.concatenate([[0], np.cumsum([sizes[i] for i in order])])
    seen = np.zeros(1 << BITS, dtype=np.int64)
    for i in range(0, len(at), 1 << 20):
        seen += np.bincount(at[i : i + (1 << 20)], minlength=1 << BITS)
    keep = (seen >= MIN_ROWS)[at]
    upto = np.array([np.count_nonzero(keep[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    at = at[keep]
    model = train(at, np.concatenate([[0], np.cumsum(upto)]), np.array([toxic[i] for i in order], dtype=np.float64))
    del at, keep
    release()
    yield pa.RecordBatch.from_pylist([{"model": pickle.dumps(model)}])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """A model from at most about ``rows`` labelled rows of ``docs`` that are not held out; None without any.

    Of several labels of an id the highest counts, of several of its texts one. The sampled ids, at most about ``rows``, are broadcast.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("double").alias("toxic"))
    sample = cut(bounded(cut(known, "toxic-labels"), rows), "toxic-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    at = texts.mapInArrow(to_rows, "doc_id long, toxic double, at binary")
    found = at.repartition(1).mapInArrow(train_task, "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else None


def predict(model: Model | None):
    """``doc_id, text`` to ``doc_id, score``; columns after them pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table() if model else None
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                score = model.scores(data, offsets, table) if model else np.zeros(n)
                rest = [batch.column(i).slice(first, n) for i in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(score), *rest], names=["doc_id", "score", *batch.schema.names[2:]])
        release()

    return run


def score(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", cut_at: float = CUT) -> DataFrame:
    """``doc_id, score, predicted`` of every row, from its whole text alone.

    A null or empty text has the score of no features; without a model all scores are 0. Rows with null
    or equal ids stay apart; an empty table gives no rows.
    """
    sent = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = sent.mapInArrow(predict(model), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= cut_at).cast("int"))


def keep_clean(df: DataFrame, model: Model | None, cut_at: float = CUT, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores below ``cut_at``, with all their columns under their own names.

    A null or empty text has the score of no features, and stays where that is below; repeated rows are judged one by
    one, alike; without a model all rows stay; an empty table gives none.
    """
    columns = [c for c in df.columns if c != text_col]
    sent = df.select(F.col(f"`{text_col}`").alias("_key"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)])
    schema = ", ".join(["doc_id string", "score double", *[f"_{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(columns)]])
    out = sent.mapInArrow(predict(model), schema).where(F.col("score") < cut_at)
    back = {text_col: F.col("doc_id")} | {c: F.col(f"_{i}") for i, c in enumerate(columns)}
    return out.select(*[back[c].alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
