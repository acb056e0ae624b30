import random
from collections import Counter

import numpy as np

from cohortflow.llm import near_join as N


def brute(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = set()
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                    links.add((a, b))
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}, links, sets


def family(seed, size, n_words=80, edits=(1, 12)):
    draw = random.Random(seed)
    base = [f"w{seed}x{draw.randrange(400)}" for _ in range(n_words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(draw.randrange(*edits)):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def made():
    texts = family(1, 40) + family(2, 25, 30, (1, 4)) + family(3, 6, 9, (1, 2)) + ["tiny one"] * 3 + ["", None, " "]
    texts += ["a b c d", "A b c D", "a b c d e", "common line of some words " + "x y z " * 3] + family(4, 10, 200, (20, 60))
    return list(enumerate(texts))


def test_components_as_brute_force(spark):
    rows = made()
    want, _, _ = brute(rows)
    for parts, common in (("4", N.COMMON), ("7", 2), ("4", 10)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_components(df, often=common).collect()}
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_every_link(spark):
    rows = made()
    _, links, sets = brute(rows)
    got = {tuple(sorted((r["x"], r["y"]))) for r in N.near_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i, s in sets.items():
        first.setdefault(frozenset(s), i)
    want = {(first[frozenset(sets[a])], first[frozenset(sets[b])]) for a, b in links}
    assert got == {tuple(sorted(p)) for p in want if p[0] != p[1]}


def test_documents_as_sql(spark, sf_dir, duck, check_same):
    check_same(N.query(spark, sf_dir), duck.execute(N.SQL).df())


def test_awkward_rows(docs, no_docs):
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.near_components(docs).collect()]
    of = {i: (n, c) for i, n, c in rows if i is not None}
    assert len(rows) == docs.count() and [of[i][1] for i in (1, 2, 3)] == [1, 1, 1]
    assert [of[i] for i in (5, 6, 7)] == [(0, 5), (0, 6), (0, 7)]
    assert of[9] == (1, 9) and of[11] == (1, 9)
    assert [r for r in rows if r[0] is None][0][2] is None
    assert N.near_components(no_docs).count() == 0


def test_keep_one(spark, docs, no_docs):
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    whole = Counter(map(tuple, docs.collect()))
    assert set(map(tuple, kept.collect())) <= set(whole)
    near = [4] if N.near_components(docs).where("doc_id = 4 and component_id = 4").count() else []
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 5, 6, 7, 8, None, 9, 10] + near)
    assert N.keep_one(no_docs).count() == 0


def test_rows_stay_and_not_ids(spark):
    a, b = "one two three four five six seven", "other words that stand in no way near the first"
    df = spark.createDataFrame([(1, a, 1), (2, a, 2), (2, b, 3), (None, b, 4), (None, a, 5), (3, b, 6), (3, None, 7), (3, None, 8), (4, "", 9)], "doc_id long, text string, row long")
    assert sorted(r["row"] for r in N.keep_one(df).collect()) == [1, 3, 7, 8, 9]
    only = df.where("doc_id is null").unionByName(df.where("doc_id is null"))
    assert sorted(r["text"] for r in N.keep_one(only).collect()) == sorted([a, b])


def test_a_pair_is_verified_once_and_shares_a_prefix(spark):
    texts = family(2, 25, 30, (1, 4)) + family(5, 40, 90, (1, 5)) + family(6, 60, 300, (2, 14)) + family(7, 40, 200, (4, 10))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, sets = N.classes_and_sets(df, "doc_id", "text", 5, 75, N.COMMON)
    _, told = N.linked_classes(sets, 75, told=True)
    pairs = Counter((r["x"], r["y"]) for r in told.collect())
    assert len(pairs) > 150 and set(pairs.values()) == {1}
    prefix = {r["class"]: set(np.frombuffer(r["hashes"], dtype=np.int64)[: r["prefix"]].tolist()) for r in sets.collect()}
    assert all(prefix[x] & prefix[y] for x, y in pairs)
    assert any(not r["ok"] for r in told.collect()) and any(r["ok"] for r in told.collect())


def test_filters():
    a, b = (np.sort(np.random.default_rng(i).integers(-(2**63), 2**63 - 1, 300)) for i in (1, 2))
    b[:200] = a[50:250]
    counts = N.suffix_counts(a, np.array([-1, 0, 149, 299]))
    assert counts.sum(axis=1).tolist() == [300, 299, 150, 0] and counts[2].tolist() == np.bincount(N.stretch(a[150:]), minlength=16).tolist()
    assert np.minimum(counts[0], N.suffix_counts(b, np.array([-1]))[0]).sum() >= 200
    assert N.least_shared(np.array([1, 4, 5]), 75).tolist() == [1, 3, 4] and N.need(7, 75) == 3


def test_verification_counts():
    import pandas as pd

    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 400, draw.integers(1, 300))) for _ in range(30)]
    frame = pd.DataFrame({"class": range(30), "comp": range(30), "size": [len(s) for s in sets], "hashes": [s.tobytes() for s in sets], "listed": [[1]] * 30, "places": [[0]] * 30, "others": [[True]] * 30, "failed": [None] * 30})
    x, y = N.Side(frame[:10]), N.Side(frame[10:])
    u, v = (z.ravel() for z in np.meshgrid(range(10), range(20), indexing="ij"))
    for gather in (7, 1 << 22):
        N.GATHER = gather
        assert N.overlaps(x, y, u, v).tolist() == [len(np.intersect1d(sets[i], sets[10 + j])) for i, j in zip(u, v)]


def test_a_forest_connects_the_same():
    draw = np.random.default_rng(5)
    for n, m in ((1, 1), (5, 9), (40, 30), (60, 2000), (300, 200)):
        a, b = draw.integers(0, n, m) * 7, draw.integers(0, n, m) * 7 + 1000
        kept = N.forest(a, b)

        def parts(edges):
            of = {}
            for x, y in edges:
                x, y = of.setdefault(x, {x}), of.setdefault(y, {y})
                if x is not y:
                    x |= y
                    for k in y:
                        of[k] = x
            return {frozenset(s) for s in of.values()}

        assert parts(zip(a[kept].tolist(), b[kept].tolist())) == parts(zip(a.tolist(), b.tolist()))
        assert len(kept) == len({*a.tolist(), *b.tolist()}) - len(parts(zip(a.tolist(), b.tolist())))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)], "x long, y long")
    got = {r["class"]: r["comp"] for r in N.components(edges).collect()}
    assert len({got[i] for i in range(31)}) == 1 and got[100] == got[101] != got[0] and len(got) == 33
