"""Sharding, mixing, secrets and top-k: against their SQL, plain versions, and awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import mixing, secrets, sharding, topk


@pytest.mark.parametrize("module", [mixing, secrets, sharding, topk])
def test_as_sql(spark, sf_dir, duck, check_same, module):
    check_same(module.query(spark, sf_dir), duck.execute(module.SQL).df())


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 16, 17, 100, 1000])
def test_permutation(spark, rows):
    want = [sharding.permute_number(x, rows, 8) for x in range(rows)]
    got = spark.range(rows).select("id", sharding.permuted(F.col("id"), rows, 8).alias("p")).orderBy("id").collect()
    assert sorted(want) == list(range(rows)) and [r["p"] for r in got] == want


def test_shards(docs, no_docs):
    rows = sharding.shard_rows(docs, 4).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    again = sharding.shard_rows(docs.repartition(5), 4).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert sharding.shard_rows(no_docs, 4).count() == 0


def shared_out(sizes):
    """Targets by repeated sharing, the plain way."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weight.items() if s not in fixed}
        rest = total - sum(fixed.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_targets(spark):
    draw = random.Random(3)
    for n in (1, 2, 7, 30):
        sizes = {f"s{i:02}" if i else None: draw.choice([0, 1, 5, 100, 10_000]) for i in range(n)}
        got = mixing.source_targets(spark.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")).collect()
        want = shared_out(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
        assert all(abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) for r in got)


def test_mix(docs, no_docs):
    rows, pieces = mixing.mix(docs)
    size = {r["row"]: r["size"] for r in rows.collect()}
    taken = Counter()
    spans = defaultdict(list)
    slots = set()
    for p in pieces.collect():
        taken[p["row"]] += p["length"]
        spans[p["row"], p["epoch"]].append((p["start"], p["start"] + p["length"]))
        slots.add(p["slot"])
        assert 0 <= p["start"] and p["start"] + p["length"] <= size[p["row"]]
    assert all(taken[r] <= 3 * size[r] for r in size) and len(slots) == len({*slots})
    for s in spans.values():
        assert all(a[1] <= b[0] for a, b in zip(sorted(s), sorted(s)[1:]))
    per = defaultdict(lambda: [0, 0.0])
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in rows.collect():
        per[source[r["doc_id"]]][0] += taken[r["row"]]
        per[source[r["doc_id"]]][1] = r["target"]
    assert all(t == int(target) for t, target in per.values())
    rows, pieces = mixing.mix(no_docs)
    assert rows.count() == 0 and pieces.count() == 0
    assert mixing.remix(no_docs).count() == 0


def test_remix_keeps_columns_and_order(spark, docs):
    out = mixing.remix(docs)
    assert out.columns == docs.columns
    whole = Counter(map(tuple, docs.collect()))
    got = Counter(map(tuple, out.collect()))
    assert set(got) <= set(whole) and all(n <= 3 * whole[r] for r, n in got.items())
    rows = [(i, f"w{i} " * (50 + i % 7), "abc"[i % 3], i) for i in range(120)] + [(7, "same words here", "a", 0)] * 400
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, nth long")
    sized, pieces = mixing.mix(df)
    size = {r["row"]: (r["doc_id"], r["size"]) for r in sized.collect()}
    turns, taken = defaultdict(lambda: 1 << 62), Counter()
    for p in pieces.collect():
        turns[p["row"], p["epoch"]] = min(turns[p["row"], p["epoch"]], p["slot"])
        taken[p["row"]] += p["length"]
    want = []
    for r, (i, n) in size.items():
        copies = (2 * taken[r] + n) // (2 * n)
        want += [(slot, r, i) for slot in sorted(v for (row, _), v in turns.items() if row == r)[:copies]]
    # One file a part, named in order: the rows as they will be read.
    assert [r["doc_id"] for r in mixing.remix(df).collect()] == [i for _, _, i in sorted(want)]


def test_shuffled_slots_change_the_result(spark, sf_dir, monkeypatch, check_same, duck):
    plain = mixing.schedule

    def turned(targets, block):
        return plain(targets, block).withColumn("slot", 100_000 - F.col("slot"))

    monkeypatch.setattr(mixing, "schedule", turned)
    with pytest.raises(AssertionError):
        check_same(mixing.query(spark, sf_dir), duck.execute(mixing.SQL).df())


def test_slots_are_even(spark):
    targets = spark.createDataFrame([("a", 1, 100, 5, 640.0), ("b", 2, 100, 2, 320.0), ("c", 3, 100, 1, 64.0)], "source string, idx long, source_size long, w long, target double")
    rows = mixing.schedule(targets, 1).collect()
    by = defaultdict(dict)
    for r in rows:
        by[r["idx"]][r["rank"]] = r["slot"]
    assert [len(by[i]) for i in (1, 2, 3)] == [640, 320, 64] and len({r["slot"] for r in rows}) == 1024
    for i in by:
        slots = [by[i][k] for k in range(len(by[i]))]
        assert slots == sorted(slots)
        # The share of the first k slots stays within a few slots of the source's share.
        assert all(abs(k + 1 - (s + 1) * len(slots) / 1024) <= 6 for k, s in enumerate(slots))


KEYWORD = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in KEYWORD.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


KEY40 = "Ab1+" * 10
CASES = [
    "😀 password = 'abcdefgh1' and token:short secret: token: longenough1", "API_KEY=\"x.y-z_123\" apikey=12345678 ", "passwd password=password=12345678",
    "AKIA" + "A1" * 8 + " AKIAAKIA AKIAB", "f" * 32 + "g" + "0a" * 20 + " " + "f" * 31, "", None, "token=" + "ab" * 20, "x" * 300_00 + " secret=abcdefgh",
    "K token=abcdefgh ſecret=abcdefgh toKen=abcdefgh", "secret=aaaaaaaa" * 3000,
]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id long, text string")
    rows, spans = secrets.scan(df)
    got = {r["doc_id"]: r["base"] for r in rows.join(secrets.listed(spans), "row").collect()}
    for i, t in enumerate(CASES):
        assert got.get(i, "") == base(t or ""), i


def test_parts_are_reported_only_together(spark):
    access = "AKIA" + "B2" * 8
    far = " " + "z " * 200
    texts = [KEY40, f"{access} then {KEY40}", f"{access}{far}{KEY40}", "ASIA" + "C3" * 8, "ASIA" + "C3" * 8 + " token=abcdefgh", "https://h/x", f"{access} secret=abcdefgh https://h/x", f"{access} https://h/x", KEY40 * 2 + f" {access}"]
    rows, spans = secrets.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    kinds = defaultdict(set)
    for r in rows.join(spans, "row").collect():
        kinds[r["doc_id"]].add(r["kind"])
    assert [kinds[i] - set(secrets.BASE) for i in range(len(texts))] == [set(), {"key"}, set(), set(), {"session"}, set(), {"endpoint"}, set(), set()]


def near_parts(text):
    """Weak spans by comparing every part with every other, edge to edge."""
    found = []
    for kind, p in secrets.PATTERNS.items():
        for m in re.finditer(p, text, re.A):
            ok = {"assign": len(m[1]) >= 8, "key": len(m[1]) == 40 and not re.fullmatch("[0-9a-f]+", m[1])}.get(kind, True)
            found += [(kind, *m.span())] if ok else []

    rank = secrets.KINDS.index

    def nearest(f, kind, start, end):
        def distance(p):
            k, a, b = p
            before = (a, rank(k)) < (start, rank(kind))
            return (max(0, start - b, a - end), not before, -b if before else a, -a if before else rank(k))

        near = [p for p in found if secrets.FAMILY.get(p[0]) == f and p[1] <= end + 256 and p[2] >= start - 256]
        return min(near, key=distance, default=None)

    out = set()
    for k, a, b in found:
        links = [nearest(f, k, a, b) for f in secrets.NEEDS.get(k, ())]
        if links and all(links):
            out.add((k, a, b, "+".join(f"{x}:{y}:{z}" for x, y, z in links)))
    return out


def test_parts_are_near_by_their_edges(spark):
    access, session, long = "AKIA" + "B2" * 8, "ASIA" + "C3" * 8, "ab.-" * 200
    texts = [
        f"token={long} {session}", f"{session} token={long}", f"token={long}{session}{long}", f"https://h/?q={long} {access} secret=abcdefgh",
        f"{access} secret=abcdefgh https://h/?q={long}", f"https://h/{long}&{access}&secret=abcdefgh&{long}", f"token={long} {KEY40} secret={long} {access}",
        *[f"token={long}{' ' * n}{session}" for n in (255, 256, 257)], *[f"{session}{' ' * n}token={long}" for n in (255, 256, 257)],
        f"{access} token={long}{' ' * 300}https://h/x", f"token={long}{' ' * 200}token=abcdefgh{' ' * 300}{session}", f"😀 token={long} 漢字 {session}",
    ]
    draw = random.Random(7)
    bits = [access, session, KEY40, "secret=abcdefgh", "f" * 32, "https://h/x", f"token={long}", f"ftp://h/{long}", " " * 100, " " * 257]
    texts += [" ".join(draw.choices(bits, k=6)) for _ in range(200)]
    rows, spans = secrets.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = defaultdict(set)
    for r in rows.join(spans.where(~F.col("kind").isin(*secrets.BASE)), "row").collect():
        got[r["doc_id"]].add((r["kind"], r["start"], r["end"], r["links"]))
    assert [got[i] for i in range(len(texts))] == [near_parts(t) for t in texts]
    assert [len(got[i]) for i in range(14)] == [1, 1, 1, 1, 1, 1, 0, 1, 1, 0, 1, 1, 0, 0]
    out = secrets.redact(spark.createDataFrame([(1, f"token={long} {session}", 0)], "doc_id long, text string, n_chars long"))
    assert out.head()["text"] == "<assign> <session>"


def test_redaction(spark, docs, no_docs):
    text = "a token=abcdefgh12 b " + "0f" * 16 + " c"
    out = secrets.redact(spark.createDataFrame([(1, text, 9), (2, "clean", 5), (2, "clean", 5), (3, None, 0), (None, text, 9)], "doc_id long, text string, n_chars long"))
    got = sorted((r["text"] or "", r["n_chars"]) for r in out.collect())
    masked = "a <assign> b <hex> c"
    assert got == sorted([(masked, len(masked)), ("clean", 5), ("clean", 5), ("", 0), (masked, len(masked))])
    # Nothing to hide there, and names that clash come back with their own values.
    assert secrets.redact(docs).columns == docs.columns and Counter(map(tuple, secrets.redact(docs).collect())) == Counter(map(tuple, docs.collect()))
    hidden = secrets.redact(docs.withColumn("text", F.lit(text)))
    assert Counter(map(tuple, hidden.collect())) == Counter(map(tuple, docs.withColumn("text", F.lit(masked)).withColumn("n_chars", F.lit(len(masked)).cast("long")).collect()))
    assert secrets.redact(no_docs).count() == 0
    assert secrets.scan(docs)[0].count() == docs.count()


def test_empty_hash(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.sql("select sha2('', 256)").head()[0]


def plain_top(rows, k, every, only=None):
    import math

    ok = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(256 * x) for x in v]))
    out = Counter()
    for at, (q, v) in enumerate(ok):
        if q % every == 0 and (only is None or q in only):
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for b, (i, w) in enumerate(ok) if b != at and len(w) == len(v))[:k]
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return out


@pytest.mark.parametrize(("shard_rows", "group_queries"), [(3, 10_000), (8, 4), (40, 10_000), (1000, 5)])
def test_top_k(spark, shard_rows, group_queries):
    draw = random.Random(5)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(150, 190)] + [(190, None), (191, [1.0, None, 1.0, 1.0]), (192, [float("nan")] * 4), (193, [float("inf")] * 4), (None, [1.0] * 4), (200, [1.0, 2.0]), (201, [])]
    rows += [(10, rows[10][1]), (10, [0.25, -0.5, 1.0, 1.0]), (20, rows[20][1])]  # ids that repeat, with equal and other vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("shard", F.lit("x")).withColumn("row", F.lit("y"))
    got = topk.exact_top_k(df, F.col("vec_id") % 10 == 0, 5, shard_rows=shard_rows, group_queries=group_queries).collect()
    assert Counter(map(tuple, got)) == plain_top(rows, 5, 10)


@pytest.mark.parametrize("scale", [1e4, 1e6, 5e6])
def test_top_k_of_large_components(spark, scale):
    draw = random.Random(6)
    rows = [(i, [draw.uniform(-1, 1) * scale for _ in range(2)]) for i in range(60)] + [(60, [scale, scale]), (70, [scale + 1 / 256, scale]), (71, [scale, scale + 1 / 256])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, F.col("vec_id") % 10 == 0, 5, shard_rows=9).collect()
    assert Counter(map(tuple, got)) == plain_top(rows, 5, 10)


@pytest.mark.parametrize("scale", [1e8, 1e300])
def test_top_k_beyond_a_long_fails(spark, scale):
    df = spark.createDataFrame([(i, [scale, scale * i]) for i in range(20)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond a long"):
        topk.exact_top_k(df, F.col("vec_id") % 10 == 0, 5).collect()


def test_far_shards_get_no_queries(spark):
    draw = random.Random(8)
    rows = [(i, [(i % 8) * 10 + draw.uniform(-1, 1), draw.uniform(-1, 1)]) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sides, sent = topk.sent, []

    def counted(rows, each, group_queries):
        out = sides(rows, each, group_queries)
        sent.append((out[0].count(), out[1].count()))
        return out

    topk.sent = counted
    try:
        some = F.col("vec_id").isin(0, 8, 16)  # all among the first of the eight groups of rows
        got = topk.exact_top_k(df, some, 5, shard_rows=50).collect()
        few = [rows for rows, _ in sent]
        assert Counter(map(tuple, got)) == plain_top(rows, 5, 1, {0, 8, 16}) and max(few) < 800 / 2
        sent.clear()
        got = topk.exact_top_k(df, F.col("vec_id") % 10 == 0, 5, shard_rows=50, group_queries=40).collect()
    finally:
        topk.sent = sides
    assert Counter(map(tuple, got)) == plain_top(rows, 5, 10)
    assert sent[0][1] == 80 and sum(n for _, n in sent) < 80 * 16 / 2


def test_choosing_in_blocks_gives_the_same(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(4)]) for i in range(150)]
    monkeypatch.setattr(topk, "BOUNDS", 7)
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, 5, shard_rows=8).collect()
    assert Counter(map(tuple, got)) == plain_top(rows, 5, 10)


def test_top_k_of_nothing(spark):
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 10 == 0, 5).count() == 0
