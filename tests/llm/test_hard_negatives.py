"""Hard negatives: against SQL, brute force, and awkward rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, anchor, positives=5, negatives=3, low=50, high=95):
    """``rows``: ``(vec_id, vector, label)``, all usable."""
    x = [[int(np.floor(256 * c)) for c in v] for _, v, _ in rows]
    out = []
    for i, (a, v, label) in enumerate(rows):
        if not anchor(a):
            continue
        scored = [(-sum(p * q for p, q in zip(x[i], x[j], strict=True)), b, other) for j, (b, w, other) in enumerate(rows) if j != i and len(w) == len(v)]
        best = sorted((s, b) for s, b, other in scored if other == label)[:positives]
        for s, b in best:
            fits = sorted((t, c) for t, c, other in scored if other != label and low * -s <= 100 * -t <= high * -s)
            out += [(a, b, n, c, -s, -t) for n, (t, c) in enumerate(fits[:negatives], 1)]
    return Counter(out)


def test_as_sql(spark, sf_dir, duck, check_same):
    check_same(H.query(spark, sf_dir), duck.execute(H.SQL).df())


@pytest.mark.parametrize("shard_rows", [None, 40])
def test_as_brute_force(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(H, "GROUP_QUERIES", 7)
    draw = random.Random(11)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(420):
        c = draw.choice(centres)
        rows.append((i, [a + draw.gauss(0, 0.4) for a in c], draw.randrange(4)))
    rows += [(1000 + i, centres[0], i % 2) for i in range(120)]  # equal vectors, a hot tile
    rows += [(7, centres[1], 0), (7, centres[1], 0), (7, centres[2], 1)]  # equal ids
    rows += [(2000 + i, [draw.gauss(0, 1) for _ in range(2)], i % 2) for i in range(30)]  # another length
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = H.hard_negatives(df, F.col("vec_id") % 7 == 0, shard_rows=shard_rows)
    assert Counter(map(tuple, got.collect())) == plain(rows, lambda a: a % 7 == 0)


def test_other_limits(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0.5, 1) for _ in range(4)], draw.randrange(3)) for i in range(150)]
    got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") < 20, 2, 4, 10, 100)
    assert Counter(map(tuple, got.collect())) == plain(rows, lambda a: a < 20, 2, 4, 10, 100)
    with pytest.raises(ValueError, match="limits"):
        H.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") < 20, low=96, high=95)


def test_awkward_rows(spark):
    one = [1.0, 0.5]
    rows = [
        (0, one, 1), (1, [0.9, 0.5], 1), (2, [0.6, 0.4], 2), (3, [0.7, 0.3], None), (4, None, 2), (5, [0.6, None], 2), (6, [0.6, float("nan")], 2), (7, [0.6, float("inf")], 2),
        (None, [0.6, 0.4], 2), (8, [0.6, 0.4], 3), (8, [0.6, 0.4], 3), (9, [-1.0, -0.5], 1), (10, [], 1), (11, [], 2), (12, [0.6], 1),
    ]
    usable = [(i, v, k) for i, v, k in rows if i is not None and v is not None and k is not None and all(c is not None and np.isfinite(c) for c in v)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'clash' as `{c}`" for c in ("row", "shard", "v", "w", "p", "part", "parts", "score", "rank", "e", "query")])
    got = Counter(map(tuple, H.hard_negatives(df, F.col("vec_id") >= 0).collect()))
    assert got == plain(usable, lambda a: True) and any(k[0] == 0 for k in got)
    renamed = df.withColumnsRenamed({"vec_id": "a.b", "embedding": "c.d", "label": "e.f"})
    assert Counter(map(tuple, H.hard_negatives(renamed, F.col("vec_id") >= 0, id_col="a.b", vector_col="c.d", label_col="e.f").collect())) == got
    none = H.hard_negatives(df.limit(0), F.col("vec_id") >= 0)
    assert none.count() == 0 and none.columns == H.hard_negatives(df, F.col("vec_id") >= 0).columns


def test_large_scores(spark):
    """Scores beyond 2^53 are exact; beyond a long they are an error."""
    big = float(1 << 20)
    rows = [(i, [big + i, big], i % 2) for i in range(12)]
    got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") < 3, low=1, high=100)
    assert Counter(map(tuple, got.collect())) == plain(rows, lambda a: a < 3, low=1, high=100)
    with pytest.raises(Exception, match="beyond a long"):
        H.hard_negatives(spark.createDataFrame([(i, [3e9, 3e9], i % 2) for i in range(4)], SCHEMA), F.col("vec_id") == 0).collect()


def test_tree_drops_boxes_that_cannot_matter(monkeypatch):
    draw = np.random.default_rng(2)
    x = np.concatenate([draw.normal(c, 1, (600, 3)) for c in (-40, 0, 40)]).round().astype(np.int64)
    tree = H.RTree(x.astype(float), leaf=32, fan=4)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    x = x[tree.order]
    rows = H.Rows(x, np.arange(len(x)), np.arange(len(x)), draw.integers(0, 2, len(x)), x.astype(float))
    seen = []
    monkeypatch.setattr(H, "products", lambda q, y, wide: (seen.append(len(y)), q @ y.T)[1])
    q = np.array([40, 40, 40])
    least, most = H.intervals(q[None, :].astype(float), tree.low, tree.high)
    windows = [(2000, 4500), (100, 200)]
    best, who = H.best_first(tree, rows, q, -1, 0, False, windows, 3, least[0].tolist(), most[0].tolist(), True)
    score, other = x @ q, rows.label != 0
    for w, (lo, hi) in enumerate(windows):
        want = sorted((-s, i) for i, s in enumerate(score.tolist()) if other[i] and lo <= s <= hi)[:3]
        want = [(-s, i) for s, i in want]
        assert [(s, i) for s, i in zip(best[w].tolist(), who[w].tolist(), strict=True) if s > H.NONE] == want
    assert sum(seen) < len(x) / 2


def test_only_rows_of_chosen_shards_are_sent(spark, monkeypatch):
    draw = random.Random(1)
    rows = [(i, [100.0 * (i % 10), draw.random()], i % 20) for i in range(2000)]
    sent = []
    whole = H.visit

    def counted(rows, chosen, k, same):
        shards = {s for r in chosen.collect() for s in r["shards"]}
        sent.append((rows.where(F.col("shard").isin(shards)).count(), rows.count()))
        return whole(rows, chosen, k, same)

    monkeypatch.setattr(H, "visit", counted)
    got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 9, shard_rows=100)
    assert Counter(map(tuple, got.collect())) == plain(rows, lambda a: a == 9)
    assert all(a < b / 3 for a, b in sent[:2])
