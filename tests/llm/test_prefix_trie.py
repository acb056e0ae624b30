"""The trie of conversations: against SQL, brute force, and awkward rows."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain(rows, family=None):
    """Nodes by dictionaries over whole prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((-1 if turn is None else turn, turn is not None, digest(role or "", text or ""), len(text or "")))
    convs = {c: [(t[2], t[3]) for t in sorted(v, key=lambda t: (t[1], t[0], t[2]))] for c, v in convs.items()}
    if family:
        whole = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 6
            whole[c] = convs.get(c - int(np.fmod(c, family)), [])[:h] + own[h:]
        convs = whole
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * (k[-1][1] if k else 0)
    return Counter(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items()
    )


def got(frame):
    assert frame.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(map(tuple, frame.collect()))


def made(seed=3, n=500):
    draw, rows = random.Random(seed), []
    for c in range(n):
        kind = draw.randrange(10)
        turns = [("system", "s")] * (kind < 7) + [(draw.choice(["user", "assistant"]), draw.choice("abc") * draw.randrange(1, 4)) for _ in range(draw.randrange(6) if kind else 40)]
        if kind > 7:
            turns = [("user", "copy"), ("assistant", "of one")]
        rows += [(c * 7 % n, t, r, x) for t, (r, x) in enumerate(turns)]
    return rows


def test_as_sql(spark, sf_dir, duck, check_same):
    check_same(P.query(spark, sf_dir), duck.execute(P.SQL).df())


@pytest.mark.parametrize("block", [1, 3, 64, P.BLOCK])
def test_as_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(P, "TOGETHER", 1)
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(P.prefix_trie(df, block=block)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rebuilt_conversations(spark):
    rows = [(c - 150, t, r, x) for c, t, r, x in made(4, 420) if c % 5 or c == 150]
    c = F.col("conv_id")
    frame = P.prefix_trie(spark.createDataFrame(rows, SCHEMA), c - c % 100, (F.crc32(c.cast("string")) % 6).cast("int"), 5, block=50)
    assert got(frame) == plain(rows, 100)


def test_one_conversation_of_many_turns(spark):
    rows = [(1, t, "user", f"{t % 7}") for t in range(5000)] + [(2, t, "user", f"{t % 7}") for t in range(4000)] + [(3, None, "user", "0")]
    assert sum(got(P.prefix_trie(spark.createDataFrame(rows, SCHEMA), block=1)).values()) == 5001


def test_awkward_rows(spark):
    rows = [
        (1, 0, None, None), (1, 1, "user", "é😀\x00"), (1, 1, "user", "é😀\x00"), (1, None, "assistant", "first"), (2, 0, "", ""), (2, 5, "user", "é😀\x00"), (2, 5, "user", "tie"),
        (None, 0, "user", "nobody"), (-3, 0, "a", "bc"), (4, 0, "ab", "c"), (9007199254740993, 0, "ab", "c"), (-9007199254740993, 0, "ab", "c"), (6, 0, "user", "x" * 200_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(P.prefix_trie(df)) == plain(rows)
    clash = df.selectExpr("*", *[f"'clash' as `{c}`" for c in ("t", "tid", "points", "key", "base", "h", "head", "node", "parent", "kind", "task", "depth", "ids")])
    assert got(P.prefix_trie(clash)) == plain(rows)
    other = df.withColumnsRenamed({"conv_id": "a.b", "turn": "c d", "role": "e", "text": "f`"[:1] + "g"})
    assert got(P.prefix_trie(other, id_col="a.b", turn_col="c d", role_col="e", text_col="fg")) == plain(rows)
    assert got(P.prefix_trie(df.limit(0))) == Counter()
    assert got(P.prefix_trie(df.where("conv_id is null"))) == Counter()


@pytest.mark.parametrize("n", [3, 16, 17, 48, 49, 255, 2000])
def test_radix_tree(n):
    draw = random.Random(n)
    keys = [bytes([draw.randrange(256) if n > 256 else i % 256]) + os.urandom(draw.randrange(3)) + b"tail" * draw.randrange(3) for i in range(n)]
    keys = list(dict.fromkeys([b"", *keys, *(k[:-1] for k in keys[:: max(1, n // 50)] if k[:-1])]))
    draw.shuffle(keys)
    tree = P.RadixTree()
    for i, k in enumerate(keys):
        tree.insert(k, i)
    found, rooms, todo = [], set(), [(tree.root, b"")]
    while todo:
        node, path = todo.pop()
        path += node.path
        rooms.add(node.room)
        assert node.count() <= node.room and (node.value < 0 or keys[node.value] == path)
        assert keys[node.sample].startswith(path)
        if node is not tree.root and node.value < 0:
            assert node.count() > 1  # paths are compressed
        found += [path] * (node.value >= 0)
        todo += [(c, path) for c in reversed(node.children())]
    assert found == sorted(keys)
    assert max(rooms) == (4 if n <= 3 else 16 if n <= 16 else 48 if n <= 48 else 256)


def test_shared_bytes():
    for path, key, at in ((b"", b"abc", 1), (b"bcd", b"abcd", 1), (b"bxd", b"abcd", 1), (b"cde", b"abcd", 2), (b"a" * 5000 + b"b", b"z" + b"a" * 6000, 1), (b"x", b"abc", 3)):
        want = 0
        while want < len(path) and at + want < len(key) and path[want] == key[at + want]:
            want += 1
        assert P.shared(path, key, at) == want
