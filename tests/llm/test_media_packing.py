import hashlib
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortflow.llm import media, packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def check_pieces(pieces, ids_of, length):
    """Every id once, sequences gapless and full but for the last."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"], p["doc_tokens"]].append(p)
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    for (doc_id, n), own in docs.items():
        for ids in [x for x in ids_of[doc_id] if len(x) == n][:1]:
            copies = sum(len(x) == n for x in ids_of[doc_id])
            assert sum(p["length"] for p in own) == copies * n
            for p in own:
                part = np.array(ids[p["start"] : p["start"] + p["length"]], dtype="<u4")
                assert len(part) == p["length"] and zlib.crc32(part.tobytes()) == p["ids_crc32"]
    for own in seqs.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    full = [sum(n for _, n in own) for _, own in sorted(seqs.items())]
    assert all(n == length for n in full[:-1]) and sorted(seqs) == list(range(len(seqs)))


@pytest.mark.parametrize("window", [1, 3, 32])
def test_pack(docs, no_docs, tokenizer, window):
    ids_of = defaultdict(list)
    for r in docs.collect():
        ids_of[r["doc_id"]].append(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1])
    pieces = packing.pack(docs.repartition(3), WORDS, 512, window).collect()
    check_pieces(pieces, ids_of, 512)
    assert packing.pack(no_docs, WORDS).count() == 0


def test_windows_hold_the_shares(spark, tokenizer):
    rows = [(i, "alpha beta gamma delta " * (20 + i % 7), "big" if i % 3 else f"s{i % 2}") for i in range(300)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), WORDS, 256, 4).collect()
    source = {i: s for i, _, s in rows}
    total, per = Counter(), defaultdict(Counter)
    for p in pieces:
        place = p["sequence_id"] * 256 + p["offset"]
        total[source[p["doc_id"]]] += p["length"]
        per[place // 1024][source[p["doc_id"]]] += p["length"]
    n = sum(total.values())
    for w in range(n // 1024):
        assert all(abs(per[w][s] - 1024 * total[s] / n) <= 8 for s in total)


def round_robin(rows, length, window):
    """Places by a plain deficit round robin, token by token: rows are ``doc_id, source, n, key`` in any order."""
    from fractions import Fraction

    queues = defaultdict(list)
    for doc_id, source, n, key in sorted(rows, key=lambda r: r[3]):
        queues[source] += [(doc_id, key, k) for k in range(n)]
    order = sorted(queues, key=lambda s: (s is not None, s))
    total = sum(map(len, queues.values()))
    quantum = {s: Fraction(len(queues[s]) * length * window, total) for s in order}
    deficit, stream, at = dict.fromkeys(order, Fraction(0)), [], 0
    while any(queues.values()):
        for s in order:
            deficit[s] += quantum[s]
            send = min(int(deficit[s]), len(queues[s]))
            deficit[s] -= send
            stream += [(at, *token) for token in queues[s][:send]]
            queues[s] = queues[s][send:]
        at += 1
    pieces = Counter()
    begin = 0
    for i in range(1, len(stream) + 1):
        # A piece ends where its document, its window's run or its sequence does.
        if i == len(stream) or i % length == 0 or stream[i][:3] != stream[i - 1][:3] or stream[i][3] != stream[i - 1][3] + 1:
            _, doc_id, _, start = stream[begin]
            pieces[doc_id, start, i - begin, begin // length, begin % length] += 1
            begin = i
    return pieces


@pytest.mark.parametrize(("length", "window"), [(16, 1), (32, 3), (64, 32)])
def test_places_as_a_plain_round_robin(spark, docs, tokenizer, length, window):
    texts = [(i, " ".join(f"w{(i * k) % 50}" for k in range(i % 40)), None if i % 7 == 0 else f"s{i % 5 if i % 3 else 0}") for i in range(150)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, source string")
    rows = []
    for i, text, source in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        n, crc = len(ids) + 1, zlib.crc32(np.array(ids, dtype="<u2").tobytes())
        rows.append((i, source, n, (hashlib.md5(f"{i}|{crc}|{n}".encode()).hexdigest(), n)))
    want = round_robin(rows, length, window)
    for parts in (1, 5):
        got = packing.pack(frame.repartition(parts), WORDS, length, window).collect()
        assert Counter((p["doc_id"], p["start"], p["length"], p["sequence_id"], p["offset"]) for p in got) == want


def test_numbers_of_keys():
    draw = np.random.default_rng(2)
    table, want = packing.Numbers(1 << 12), {}
    for _ in range(6):
        keys = np.unique(np.concatenate([draw.integers(0, 2**63, 250, dtype=np.uint64), np.arange(3, dtype=np.uint64) << np.uint64(52)]))
        new = keys[table.get(keys) < 0]
        want |= {k: len(want) + i for i, k in enumerate(new.tolist())}
        table.add(new)
        assert table.get(keys).tolist() == [want[k] for k in keys.tolist()]
    assert table.count == len(want) and (table.get(draw.integers(2**63, 2**64 - 1, 500, dtype=np.uint64)) == -1).all()


def test_a_full_table_starts_anew(tokenizer, monkeypatch):
    import pyarrow as pa

    from cohortflow.llm.shingles import text_slices

    monkeypatch.setattr(packing, "CACHE", 40)
    monkeypatch.setattr(packing, "SLOTS", 64)
    texts = [" ".join(f"tok{i * 37 + k}. {k}<x" for k in range(30)) for i in range(12)]
    chunked = packing.ChunkTokenizer(WORDS)
    for _, data, offsets in text_slices(pa.array(texts), 100):
        ids, at = chunked.texts(data, offsets)
        want = [tokenizer.encode(data[a:b].tobytes().decode(), add_special_tokens=False).ids for a, b in zip(offsets[:-1], offsets[1:])]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_chunks_as_the_library(tokenizer):
    import pyarrow as pa

    from cohortflow.llm.shingles import text_slices

    texts = ["A b.  C,d e.", "it's The end . .. a.b", "É ßÜİ ÀÇ. ÷× µ ª", "a<|endoftext|>b <|startoftext|>", "\x1c\x85 x́ é", "", "don't I'LL 1234 x9", "word. word, Word"] * 3
    chunked = packing.ChunkTokenizer(WORDS)
    for _, data, offsets in text_slices(pa.array(texts)):
        ids, at = chunked.texts(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_round_trip(docs, no_docs):
    want = Counter()
    for r in docs.collect():
        text = (r["text"] or "").encode()
        payload = text + b"\xff" * ((-len(text) % 576) if text else 576)
        want[r["doc_id"], len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])] += 1
    rows = media.texts_as_media(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows) == want
    same = {(r["media_sha256"], r["media_bytes"], r["feature"]) for r in rows if r["doc_id"] in (1, 2)}
    assert len(same) == 1 and all(r["error"] is None for r in rows)
    assert media.texts_as_media(no_docs).count() == 0


def test_ranges_cover_every_member_once(docs):
    folder = media.store(docs.repartition(2))
    spark = docs.sparkSession
    for size in (100, 1000, 5000, 1 << 20):
        assert media.media_columns(spark, folder, True, size).count() == docs.count()
    assert media.media_columns(spark, folder).count() == docs.count()


def test_a_directory_is_read_by_few_ranges(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for i in range(300):
            z.writestr(f"{i}/{i}.png", media.to_png(media.pad(b"x" * i)))
    size = (tmp_path / "a.zip").stat().st_size
    reader = media.ArchiveReader({"path": f"file://{tmp_path}", "rangeBytes": "2000"})
    parts = reader.partitions()
    found = [[m for b in reader.read(p) for m in b.column("member").to_pylist()] for p in parts]
    assert len(parts) == -(-size // 2000) and sorted(sum(found, [])) == sorted(f"{i}/{i}.png" for i in range(300))
    with (tmp_path / "a.zip").open("rb") as f:
        import pyarrow as pa

        directory = media.directory_bytes(pa.PythonFile(f))
    assert 0 < directory and sum(map(bool, found)) <= max(1, -(-size // (media.SHARE * directory)))


def test_only_listed_archives_count(spark, docs, tmp_path):
    folder = media.store(docs)
    with zipfile.ZipFile(folder.removeprefix("file://") + "/orphan.zip", "w") as z:
        z.writestr("0/77.png", media.to_png(media.pad(b"of a task that failed")))
    assert media.media_columns(spark, folder, True).count() == docs.count()
    assert media.media_columns(spark, folder).count() == docs.count() + 1


def test_foreign_and_damaged_members(spark, tmp_path):
    good = media.to_png(media.pad(b"fine"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("0/1.png", good[:-10])  # whole as a member, cut as a picture
        z.writestr("cover.png", good)
        z.writestr("1/99999999999999999999.png", good)
        z.writestr("2/-5.png", good)
        z.writestr("3/x\u0663.png", good[:20])
        z.writestr("4/7.png", b"")
        z.writestr("5/8.png", good)
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    for name, flag in ((b"5/8.png", 1),):  # as if it were encrypted
        at = raw.rindex(name) - 46
        raw[at + 8] |= flag
        raw[raw.index(name) - 30 + 6] |= flag
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    (tmp_path / "b.zip").write_bytes(b"PK nothing")
    rows = media.media_columns(spark, f"file://{tmp_path}").collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["error"] is None) for r in rows) == Counter([(1, None, False), (None, 4, True), (None, 4, True), (-5, 4, True), (None, None, False), (7, None, False), (8, None, False), (None, None, False)])


def test_a_member_that_fails_at_first():
    class Flaky:
        def __init__(self, failures):
            self.left = failures

        def read(self, info):
            self.left -= 1
            if self.left >= 0:
                raise OSError("store is busy")
            return b"data"

    reader = media.ArchiveReader({"path": "file:///none", "tries": "3"})
    assert reader.member(Flaky(2), None) == (b"data", None)
    assert reader.member(Flaky(3), None) == (None, "OSError: store is busy")
    assert reader.member(type("Odd", (), {"read": lambda self, i: (_ for _ in ()).throw(NotImplementedError("method 99"))})(), None)[1] == "NotImplementedError: method 99"


def test_features_as_counted_plainly():
    import math

    for payload in (media.pad(b""), media.pad(b"some text " * 100), bytes(range(192)) * 3):
        samples = np.frombuffer(payload, dtype=np.uint8).reshape(-1, media.WIDTH)
        n, counts = len(payload), Counter(payload)
        mean = sum(payload) / n
        spread = math.sqrt(sum((b - mean) ** 2 for b in payload) / n)
        entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
        bins = [sum(c for b, c in counts.items() if b // 32 == k) * 1000 // n for k in range(8)]
        got = dict(x.split("=") for x in media.feature(samples).split(";"))
        assert abs(float(got["mean"]) - mean) < 1e-3 and abs(float(got["std"]) - spread) < 1e-3 and abs(float(got["entropy"]) - entropy) < 1e-3
        assert got["hist"] == "/".join(map(str, bins))


def test_empty_pictures_and_damaged_lzma(spark, tmp_path):
    def picture(width, height):
        head = media.struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
        return media.SIGNATURE + media.chunk(b"IHDR", head) + media.chunk(b"IDAT", media.zlib.compress(b"\0" * height)) + media.chunk(b"IEND", b"")

    good = media.to_png(media.pad(b"fine"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_LZMA) as z:
        z.writestr("0/1.png", good * 3)
        z.writestr("1/2.png", picture(0, 5))
        z.writestr("2/3.png", picture(5, 0))
        z.writestr("3/4.png", good)
        at = z.getinfo("0/1.png")
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[at.header_offset + 30 + 7 + 4 :][:1]
    raw[at.header_offset + 30 + 7 + 4] = 255  # the compressor's properties
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    rows = {r["doc_id"]: r for r in media.media_columns(spark, f"file://{tmp_path}").collect()}
    assert "LZMAError" in rows[1]["error"] and "empty" in rows[2]["error"] and "empty" in rows[3]["error"] and rows[4]["error"] is None


def test_a_member_too_large_for_memory():
    def read(self, info):
        raise MemoryError

    reader = media.ArchiveReader({"path": "file:///none", "tries": "1"})
    assert reader.member(type("Huge", (), {"read": read})(), None)[1].startswith("MemoryError")


def test_planned_ranges_read_their_archive_once(docs, monkeypatch):
    folder = media.store(docs.repartition(2))
    for size in ("100", "2000", "10000000"):
        reader = media.ArchiveReader({"path": folder, "listed": "true", "rangeBytes": size})
        parts = reader.partitions()
        found = [[m for b in reader.read(p) for m in b.column("member").to_pylist()] for p in parts]
        assert all(p.planned for p in parts) and sum(map(len, found)) == docs.count()
    monkeypatch.setattr(media, "RANGES", 3)
    reader = media.ArchiveReader({"path": folder, "rangeBytes": "10"})
    assert len(reader.partitions()) <= 5 and sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == docs.count()


def test_a_bad_member_does_not_stop_the_others(spark, tmp_path):
    good = media.to_png(media.pad(b"fine"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("0/1.png", good)
        z.writestr("1/2.png", b"no picture")
        z.writestr("2/3.png", good)
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[raw.index(good) + 60] ^= 255  # the first member's bytes no longer fit its checksum
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    rows = {r["doc_id"]: r for r in media.media_columns(spark, f"file://{tmp_path}").collect()}
    assert rows[1]["error"] and rows[2]["error"] and rows[3]["error"] is None and rows[3]["n_bytes"] == 4


def test_pictures():
    for n in (0, 1, 575, 576, 577, 5000):
        payload = media.pad(b"x" * n)
        assert len(payload) % 576 == 0 and payload and media.from_png(media.to_png(payload)).tobytes() == payload
    with pytest.raises(ValueError):
        media.from_png(media.to_png(media.pad(b"x"))[:-20])
