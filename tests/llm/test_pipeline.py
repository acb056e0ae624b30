import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from cohortflow.llm import mixing, toxicity
from cohortflow.llm.common import cut, documents

from tests.llm.test_media_packing import check_pieces
from tests.llm.test_models import plain_ftrl
from tests.llm.test_native import base
from tests.llm.test_near_join import brute


def texts_at(text):
    """The distinct buckets of one text alone."""
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return np.unique(np.concatenate([at for at, _ in toxicity.features(data, np.array([0, len(data)]))]))


def plainly_toxic(docs, labels):
    """Ids that a plain FTRL over the labelled rows, in the order of their ids, scores as toxic."""
    known = {}
    for i, toxic in labels:
        if i is not None and toxic is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            known[i] = max(known.get(i, 0.0), float(toxic > 0))
    rows = [(i, texts_at(t)) for i, t in sorted(docs) if i in known]
    seen = Counter(b for _, at in rows for b in at.tolist())
    kept = [np.array([b for b in at.tolist() if seen[b] >= toxicity.MIN_ROWS], dtype=np.int64) for _, at in rows]
    weights, bias = plain_ftrl(kept, [known[i] for i, _ in rows])
    score = {i: 1 / (1 + math.exp(-sum(weights.get(b, 0.0) for b in texts_at(t).tolist()) - bias)) for i, t in docs}
    return {i for i, p in score.items() if p >= toxicity.CUT}


def plainly_mixed(duck, rows):
    """How often each id of ``rows`` (their ids differ) is wanted, from the mixing query's SQL over them."""
    own = duck.cursor()
    own.register("mine", pd.DataFrame([(r["doc_id"], r["text"], r["source"]) for r in rows], columns=["doc_id", "text", "source"]))
    own.execute("CREATE TEMP VIEW documents AS SELECT * FROM mine")
    return {i: (2 * taken + size) // (2 * size) for i, size, taken in own.execute(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall() if size}


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """What each stage returned, as it was written."""
    frames = [documents(spark, sf_dir)]
    for _, stage in P.chain():
        frames.append(cut(stage(spark, frames[-1], sf_dir), "test-stage"))
    return frames


def test_stages_against_plain_versions(spark, sf_dir, duck, staged):
    assert all(f.columns == staged[0].columns for f in staged[:-1])
    raw, clean, single, masked, mixed = [[r.asDict() for r in f.collect()] for f in staged[:-1]]

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect()
    bad = plainly_toxic([(r["doc_id"], r["text"]) for r in raw], labels)
    assert bad and {r["doc_id"] for r in clean} == {r["doc_id"] for r in raw} - bad
    found, _, _ = brute([(r["doc_id"], r["text"]) for r in clean])
    assert {r["doc_id"] for r in single} == {i for i, (_, c) in found.items() if i == c}
    before = {r["doc_id"]: r["text"] for r in single}
    assert len(masked) == len(single)
    for r in masked:
        assert r["n_chars"] == len(r["text"]) and (r["text"] == before[r["doc_id"]]) == (not base(before[r["doc_id"]]))
        assert not base(r["text"])
    want = plainly_mixed(duck, masked)
    got = Counter(r["doc_id"] for r in mixed)
    assert {i: got[i] for i in want} == want and set(got) <= set(want)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids_of = defaultdict(list)
    for r in mixed:
        ids_of[r["doc_id"]].append(tokenizer.encode(r["text"], add_special_tokens=False).ids + [1])
    pieces = staged[-1].collect()
    check_pieces(pieces, ids_of, 2048)
    assert sum(p["length"] for p in pieces) == sum(len(x) for v in ids_of.values() for x in v)


def test_runs_leave_each_other_alone(spark, sf_dir, staged):
    """Two runs before either is read: both give what the stages, held against plain versions, give."""
    one, other = P.run(spark, sf_dir), P.run(spark, sf_dir)
    want = Counter(map(tuple, staged[-1].collect()))
    assert Counter(map(tuple, one.collect())) == want
    assert Counter(map(tuple, other.collect())) == want


def test_stages_of_nothing(spark, sf_dir, no_docs):
    docs = no_docs
    for _, stage in P.STAGES:
        docs = cut(stage(spark, docs, sf_dir), "none")
        assert docs.count() == 0


def test_awkward_documents(spark, sf_dir, docs):
    """Columns whose names clash with those used inside go through all stages."""
    frame = docs
    for name, stage in P.STAGES:
        assert frame.columns == docs.columns
        frame = cut(stage(spark, frame, sf_dir), "awkward")
    assert frame.count() > 0
