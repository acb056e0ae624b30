import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from cohortflow.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def counts(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, type=pa.string())], names=["doc_id", "text"])
    return np.concatenate([np.asarray(b.column(2)) for b in T.count_texts(PATH)(iter([batch]))]).tolist()


def test_as_the_library(library):
    draw = random.Random(1)
    alphabet = " " * 6 + "\n\t" + "abcdeth" * 3 + "éßñ漢字ゼ😀▁AB.,-=_/0123\x00　"
    texts = [" " * k + c for k in range(40) for c in ("", "x", "Ж", "☃")]
    texts += ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(1500)]
    texts += ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(400, 4000))) for _ in range(5)]
    texts += ["".join(draw.choice(["the", "ing", "tion", "0", "==", "--", "__"]) for _ in range(1500)) for _ in range(5)]
    texts += ["a" * 5000, "=" * 3000, "ab" * 2000, "<s> </s> <unk> <0x0A>"]
    assert counts(texts) == [len(x) for x in library.encode(texts)]


def test_documents_as_the_library(spark, sf_dir, library):
    from cohortflow.llm.common import documents

    got = {r["doc_id"]: r["n_tokens"] for r in T.query(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, sf_dir).collect()}
    assert got == dict(zip(texts, map(len, library.encode(list(texts.values()))), strict=True))


def test_a_small_table_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(T, "TABLE", 1 << 12)
    monkeypatch.setattr(T, "machines", {})
    texts = ["some words that the machine has to learn again and again", "unbroken" * 500]
    assert counts(texts) == [len(x) for x in library.encode(texts)]


def test_scan_composes_maps():
    # States are numbers; chunk 0 ends in state 1; the maps of 1 to 4 add their own number and move on.
    maps = {c: {s: (s + c, 10 * c + s) for s in range(12)} for c in range(1, 5)}
    done, missing = T.scan(maps, {0: 1})
    assert done == {1: 11, 2: 22, 3: 34, 4: 47} and not missing
    del maps[3][4]
    done, missing = T.scan(maps, {0: 1})
    assert missing == [(3, 4)] and 4 not in done


def test_awkward_rows(docs, no_docs, library):
    out = T.token_counts(docs, PATH)
    assert out.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = [r["text"] or "" for r in docs.collect()]
    rows = sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect())
    assert rows == sorted((len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for t in texts)
    assert T.token_counts(no_docs, PATH).count() == 0
