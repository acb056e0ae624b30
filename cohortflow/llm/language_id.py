"""Language identification by averaged hashed subword embeddings (operator 4).

A text's subwords are its three-byte runs of letters (with a mark at a word's ends) and its
whole words, hashed to rows of an embedding table. Their mean goes through a linear
softmax. Both are trained by stochastic gradient descent in numpy on a bounded sample of
labelled rows, in one task; languages share the sample evenly, so a rare one keeps all its
rows up to its share. Every fifth row of a language is kept apart to calibrate: a temperature
for the probabilities, and the score below which a prediction counts as rejected.
For scoring, embeddings and softmax are multiplied into one small table.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import documents
from cohortflow.llm.sampling import bounded_by, held_out, once
from cohortflow.llm.shingles import mix, spans_hash, text_slices

BUCKETS = 1 << 16
DIM = 16
#: At most about so many labelled rows are learned from.
TRAIN_ROWS = 6_000
EPOCHS = 5
#: Learning rates of the softmax, of its bias, and of the embeddings: a mean over some hundred subwords gives each a small gradient.
RATE, BIAS_RATE, EMBEDDING_RATE = 0.5, 0.05, 25.0
#: The share of calibration rows that are predicted right which may be rejected.
REJECT = 0.005
UNKNOWN = "und"

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes with ASCII and Latin-1 letters lower-cased, and a blank for every ASCII byte that is no letter."""
    out = _FOLD[data]
    if len(out) > 1:
        upper = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
        out[upper] += 0x20
    return out


def word_spans(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters; none crosses a text's end."""
    solid = text != 32
    n = len(text)
    starts, ends = np.zeros(n, dtype=bool), np.zeros(n + 1, dtype=bool)
    if n:
        starts[0], starts[1:] = solid[0], solid[1:] & ~solid[:-1]
        ends[1:n], ends[n] = solid[:-1] & ~solid[1:], solid[-1]
        inner = offsets[(offsets > 0) & (offsets < n)]
        starts[inner] |= solid[inner]
        ends[inner] |= solid[inner - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends)


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each subword, and the text it is from."""
    text = letters(data)
    padded = np.concatenate([[32], text, [32]]).astype(np.uint64)
    codes = padded[:-2] << np.uint64(16) | padded[1:-1] << np.uint64(8) | padded[2:]
    keep = text != 32
    first = offsets[:-1][np.diff(offsets) > 0]
    codes[first] &= np.uint64(0xFFFF)  # nothing before a text or after it
    codes[offsets[1:][np.diff(offsets) > 0] - 1] &= np.uint64(0xFFFF00)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts, ends = word_spans(text, offsets)
    words = spans_hash(text.astype(np.uint64), starts, ends)
    hashed = np.concatenate([mix(codes[keep] + np.uint64(1 << 32)), words])
    return (hashed & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate([owner[keep], owner[starts]])


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # one row of logits for each bucket
    bias: np.ndarray
    temperature: float
    accept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of each language for each text."""
        at, owner = subwords(data, offsets)
        n = len(offsets) - 1
        count = np.maximum(np.bincount(owner, minlength=n), 1)
        sums = np.stack([np.bincount(owner, weights=self.table[at, k], minlength=n) for k in range(len(self.langs))], axis=1)
        return softmax((sums / count[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str], seed: int = 4) -> Model:
    """Fit embeddings and softmax, then calibrate on every fifth row of each language.

    Rows are a text's distinct buckets and their shares. Without a row to calibrate on the temperature is 1 and all is accepted.
    """
    draw = np.random.default_rng(seed)
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    met, keep, rest = [0] * len(names), [], []
    for i, k in enumerate(y.tolist()):
        (rest if met[k] % 5 == 4 else keep).append(i)
        met[k] += 1
    emb = draw.normal(0, 0.1, (BUCKETS, DIM))
    out, bias = draw.normal(0, 0.1, (DIM, len(names))), np.zeros(len(names))
    steps, done = EPOCHS * len(keep), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(keep).tolist():
            where, share = rows[i]
            h = share @ emb[where]
            p = softmax(h @ out + bias)
            p[y[i]] -= 1
            left = 1 - done / steps
            g = out @ p
            out -= RATE * left * np.outer(h, p)
            bias -= BIAS_RATE * left * p
            emb[where] -= EMBEDDING_RATE * left * share[:, None] * g[None, :]
            done += 1
    temperature, accept = 1.0, 0.0
    if rest:
        logits = np.stack([rows[i][1] @ emb[rows[i][0]] @ out + bias for i in rest])
        truth, at = y[rest], np.arange(len(rest))
        temperature = min((float(t) for t in np.geomspace(0.05, 20, 60)), key=lambda t: -np.log(softmax(logits / t)[at, truth] + 1e-12).sum())
        best = softmax(logits / temperature).max(axis=1)[logits.argmax(axis=1) == truth]
        accept = float(np.quantile(best, REJECT)) if len(best) else 0.0
    return Model(names, (emb @ out).astype(np.float32), bias, temperature, accept)


def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text, lang`` to the text's distinct buckets and how often each is met: bounded by the buckets, however long the text. A task sends an id once."""
    sent: set[int] = set()
    for batch in batches:
        new = once(batch.column(0).to_pylist(), sent)
        batch = batch if all(new) else batch.filter(pa.array(new))
        for first, data, offsets in text_slices(batch.column(1)):
            at, owner = subwords(data, offsets)
            keys, counts = np.unique(owner * BUCKETS + at, return_counts=True)
            n = len(offsets) - 1
            edges = np.searchsorted(keys, np.arange(n + 1) * BUCKETS).tolist()
            low, counts = (keys % BUCKETS).astype(np.int32), counts.astype(np.int32)
            parts = ([x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)] for x in (low, counts))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(2).slice(first, n), *(pa.array(p, pa.binary()) for p in parts)], names=["doc_id", "lang", "at", "met"])


def train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["doc_id"], r["lang"], r["at"], r["met"]) for b in batches for r in b.to_pylist())
    rows = [r for i, r in enumerate(rows) if not i or r[0] != rows[i - 1][0]]  # several tasks may have sent an id
    if rows:
        each = [(np.frombuffer(at, dtype=np.int32), np.frombuffer(met, dtype=np.int32).astype(np.float64)) for _, _, at, met in rows]
        model = train([(at, met / max(1.0, met.sum())) for at, met in each], [x for _, x, _, _ in rows])
        yield pa.RecordBatch.from_pylist([{"model": pickle.dumps(model)}])


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Model | None:
    """A model from at most about ``rows`` rows of ``df`` with a language, a text and an id that is not held out; None without any.

    Of several rows of an id one counts. Every language has a row at least, so there are more than ``rows`` only if
    there are more languages. The languages' names and counts go to the driver.
    """
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    usable = own.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sample = bounded_by(usable, "lang", rows)
    found = sample.mapInArrow(to_rows, "doc_id long, lang string, at binary, met binary").repartition(1).mapInArrow(train_task, "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else None


def predict(model: Model | None):
    """``doc_id, text`` to ``doc_id, lang_pred, score, accepted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                raw = data.tobytes()
                plain = (data | 0x20) - 97 < 26
                some = np.add.reduceat(np.append(plain, False).astype(np.int64), offsets[:-1])
                some[np.diff(offsets) == 0] = 0
                letter = [bool(some[i]) or any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].decode()) for i in range(n)]
                if model is None:
                    pred, score = np.array([UNKNOWN] * n, dtype=object), np.zeros(n)
                else:
                    p = model.scores(data, offsets)
                    pred, score = np.array(model.langs, dtype=object)[p.argmax(axis=1)], p.max(axis=1)
                pred = [x if ok else UNKNOWN for x, ok in zip(pred, letter, strict=True)]
                score = np.where(letter, score, 0.0)
                accepted = np.array(letter) & (score >= (model.accept if model else 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(pred, pa.string()), pa.array(score), pa.array(accepted)], names=["doc_id", "lang_pred", "score", "accepted"])

    return run


def identify(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` of every row, from its whole text alone.

    A null text, or one without any letter, is ``und`` with score 0 and not accepted, as is every text without a
    model. ``accepted`` is false below the calibrated score; the best language is named all the same. Ties go to
    the language first in order. Rows with null or equal ids stay apart; an empty table gives no rows.
    """
    sent = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return sent.mapInArrow(predict(model), "doc_id long, lang_pred string, score double, accepted boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs, fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
