"""Byte-pair encoding and decoding against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortflow.llm import bpe
from cohortflow.llm.common import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, type=pa.string())], names=["doc_id", "text"])
    return [ids for b in bpe.encoding(PATH)(iter([batch])) for ids in b.column(1).to_pylist()]


def awkward_texts():
    draw = random.Random(5)
    alphabet = " " * 6 + "\n\t\r " + "abcdeth" * 3 + "'" * 5 + "strvemlld" * 3 + "éßñ漢字ゼ😀AB.,-=_/0123\x00　 ́²Ⅷ٠"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(4000)]
    texts += ["".join(draw.choice(["<|endoftext|>", " ", "'s", "a", "\n", "<|", "|>", "endoftext"]) for _ in range(draw.randrange(20))) for _ in range(1500)]
    texts += ["".join(map(chr, range(a, a + 400))) for a in (1, 0x300, 0x600, 0xFF00, 0x1F300)]
    return [*texts, "a" * 30_000, " " * 3_000, "=- " * 999, "ab" * 9_000, "it's we're I'll they've I'm I'd 'S 're's", None, ""]


def test_as_the_library(library):
    texts = awkward_texts()
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ids_of(texts) == want


def test_a_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "loaded", {})
    texts = ["some pieces that are forgotten <|endoftext|> and learned again", "and again", " ".join(f"w{i}" for i in range(300))] * 3
    assert [ids_of([t])[0] for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def plainly_merged(vocabulary, piece):
    """The lowest rank first, the leftmost of it, until none is left."""
    ids = vocabulary.of_byte[list(piece)].tolist()
    while True:
        ranks = [(vocabulary.with_left.get(a, {}).get(b, 1 << 40), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))]
        rank, i = min(ranks, default=(1 << 40, 0))
        if rank == 1 << 40:
            return ids
        ids[i : i + 2] = [vocabulary.made[rank]]


def test_index_merges_as_the_plain_loop():
    vocabulary, draw = bpe.encoder_for(PATH).vocabulary, random.Random(9)
    pieces = [bytes(draw.choice(b"aaabcdefghilnorst eeee") for _ in range(draw.randrange(1, 40))) for _ in range(400)]
    sizes = np.array([len(p) for p in pieces])
    ids, lengths = vocabulary.merged(np.frombuffer(b"".join(pieces), dtype=np.uint8), sizes)
    ends = np.cumsum(lengths)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, lengths, strict=True)] == [plainly_merged(vocabulary, p) for p in pieces]


def test_documents_as_the_library(spark, sf_dir, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.query(spark, sf_dir).collect()}
    want = {}
    for r in documents(spark, sf_dir).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert text == (r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert got == want


def test_decodes_as_the_library(spark, library):
    draw = random.Random(3)
    lists = [[draw.randrange(50_257) for _ in range(draw.randrange(30))] for _ in range(300)] + [[50_256, 60_000, 11], [], [220, 127, 129], [187]]
    df = spark.createDataFrame([(i, ids) for i, ids in enumerate(lists)], "n int, ids array<int>")
    got = [r["decoded"] for r in bpe.decode(df, PATH).orderBy("n").collect()]
    assert got == [library.decode([i for i in ids if i < 50_257], skip_special_tokens=False) for ids in lists]
    odd = spark.createDataFrame([(None,), ([None, 40, -1],)], "ids array<int>")
    assert {r["decoded"] for r in bpe.decode(odd, PATH).collect()} == {"", "I"}
    assert bpe.decode(df.limit(0), PATH).count() == 0


def test_awkward_rows(docs, no_docs, library):
    out = bpe.encode(docs, PATH)
    assert out.columns == ["doc_id", "ids"]
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids"]) for r in out.collect()) == want
    texts = sorted(r["text"] or "" for r in docs.collect())
    assert sorted(r["decoded"] for r in bpe.decode(out.withColumn("text", F.lit("clash")), PATH).collect()) == texts
    assert bpe.encode(no_docs, PATH).count() == 0
    assert bpe.encode(docs.withColumnsRenamed({"doc_id": "a.b", "text": "c.d"}), PATH, "a.b", "c.d").count() == docs.count()


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
