"""N-gram Jaccard join (operator 2).

A text's set is its distinct 5-word shingles. Texts of equal words are one class.
One pass over the texts sends each class's shingle hashes to partitions by hash,
packed in blocks of numbers, where every shingle is counted over all classes. Only
shingles of two classes or more come back. Sorted by that count, rarest first, a
class's prefix is what must hold a shared shingle if any other class is similar
enough: its unshared shingles fill the prefix first, so most classes drop out here.

Classes that meet in a prefix shingle are candidates, each pair once, less what the
length, positional and suffix filters exclude; what is left is verified on the whole
sets, once a pair. Copies of one text meet in the same shingles, and all their pairs
would grow with the square of the group. So each list first pairs its members with two
of them only, and what links there is one component from then on. Then only members of
different components are candidates of each other. They meet in blocks within a task,
from which only links come out: a pair belongs to the first prefix shingle that both
hold, and to the side that is not of that list's largest component (of two such sides,
the smaller class); pairs that failed before are left out. A link within a component
changes no component, so none that matters is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common
from cohortflow.llm.common import cut, documents
from cohortflow.llm.shingles import mix, release, shingles, spans_hash, text_slices, words

N = 5
PERCENT = 75
#: Shingles that a task gathers before it sends blocks.
FLUSH = 1 << 20
#: Classes and list members that meet in one block, set elements gathered at once, and stretches of the suffix filter.
QUERIES, MEMBERS, GATHER, BUCKETS = 256, 128, 1 << 22, 16

#: A shingle that a task meets so often in one flush is common: it takes the last place in every order
#: and is not counted, so that no part gets a row for each text that holds it.
COMMON = 64
LAST = np.iinfo(np.int32).max

BLOCK = "part int, ids binary, classes binary, sizes binary, counts binary, hashes binary, seen binary"
_BLOCK_ARROW = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("ids", "classes", "sizes", "counts", "hashes", "seen")]])
SETS = "class long, size int, prefix int, hashes binary"
_SETS_ARROW = pa.schema([("class", pa.int64()), ("size", pa.int32()), ("prefix", pa.int32()), ("hashes", pa.binary())])


def least_shared(size: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shingles that a set of this size shares with a similar one."""
    return -(-size * percent // 100)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    if not len(x):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]])


def frequent(h: np.ndarray, least: int) -> np.ndarray:
    """The values that occur ``least`` times or more, by way of a coarse count."""
    low = (h & np.uint64(0xFFFF)).astype(np.int64)
    some = h[(np.bincount(low, minlength=1 << 16) >= least)[low]]
    values, counts = np.unique(some, return_counts=True)
    return values[counts >= least]


def to_blocks(n: int, parts: int, common: int):
    """Texts to blocks: for each part the classes met, their sizes, and their shingles there.

    A task sends a class's shingles once, however many copies it meets. Blocks with ``ids``
    carry the rows themselves: id, class and size. Common shingles go to the classes' own parts at
    once, in blocks with ``seen``; the shingles' part only learns which they are, from blocks without classes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        place = (TaskContext.get().partitionId() if TaskContext.get() else 0) * 7919  # rows need no part of their own: each has its share
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def blocks() -> Iterator[pa.RecordBatch]:
            cls = np.concatenate([c for c, _, _ in held])
            sizes = np.concatenate([s for _, s, _ in held])
            h = np.concatenate([x for _, _, x in held])
            owner = np.repeat(np.arange(len(cls)), sizes)
            often = frequent(h, common)
            if len(often):
                is_common = np.isin(h, often)
                yield from by_class(h[is_common], cls[owner[is_common]], sizes[owner[is_common]].astype(np.int32), np.full(int(is_common.sum()), LAST, dtype=np.int32), parts)
                for p in np.unique(part_of(often, parts)).tolist():
                    yield _rows([{"part": int(p), "classes": b"", "hashes": often[part_of(often, parts) == np.uint64(p)].tobytes()}], _BLOCK_ARROW)
                h, owner = h[~is_common], owner[~is_common]
            part = part_of(h, parts).astype(np.uint16 if parts < 65_536 else np.uint32)
            order = np.argsort(part, kind="stable")
            part, h, owner = part[order], h[order], owner[order]
            edges = _runs(part)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                at = _runs(owner[a:b])
                who = owner[a:b][at[:-1]]
                yield _rows([{"part": int(part[a]), "classes": cls[who].tobytes(), "sizes": sizes[who].astype(np.int32).tobytes(), "counts": np.diff(at).astype(np.int32).tobytes(), "hashes": h[a:b].tobytes()}], _BLOCK_ARROW)
            held.clear()

        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                _, _, w, at = words(data, offsets)
                cls = spans_hash(w, at[:-1], at[1:]) if len(w) else np.zeros(len(offsets) - 1, dtype=np.uint64)
                h, bounds = shingles(w, at, n)
                sizes = np.diff(bounds)
                ids = batch.column(0).slice(first, len(sizes))
                known = np.asarray(ids.is_valid())
                yield _rows([{"part": place % parts, "ids": np.asarray(ids.fill_null(0)).astype(np.int64).tobytes(), "seen": known.astype(np.uint8).tobytes(), "classes": cls.tobytes(), "sizes": sizes.astype(np.int32).tobytes()}], _BLOCK_ARROW)
                place += 1
                new = np.zeros(len(cls), dtype=bool)
                for i, c in enumerate(cls.tolist()):
                    if sizes[i] and c not in sent:
                        sent.add(c)
                        new[i] = True
                if new.any():
                    held.append((cls[new], sizes[new], h[np.repeat(new, sizes)]))
                if sum(len(x) for _, _, x in held) >= FLUSH:
                    yield from blocks()
        if held:
            yield from blocks()
        release()

    return run


def by_class(h: np.ndarray, cls: np.ndarray, size: np.ndarray, seen: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Shingles with their classes and counts, as blocks for the classes' parts."""
    order = np.argsort(cls, kind="stable")
    h, cls, size, seen = h[order], cls[order], size[order], seen[order]
    to = part_of(mix(cls), parts).astype(np.int64)
    order = np.argsort(to, kind="stable")
    h, cls, size, seen, to = h[order], cls[order], size[order], seen[order], to[order]
    edges = _runs(to)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        at = _runs(cls[a:b])
        yield _rows([{"part": int(to[a]), "classes": cls[a:b][at[:-1]].tobytes(), "sizes": size[a:b][at[:-1]].tobytes(), "counts": np.diff(at).astype(np.int32).tobytes(), "hashes": h[a:b].tobytes(), "seen": seen[a:b].tobytes()}], _BLOCK_ARROW)


def count_shared(parts: int):
    """One part's blocks to blocks by class: the shingles of two classes or more, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[np.ndarray]] = {"cls": [], "size": [], "h": []}
        often = [np.zeros(0, dtype=np.uint64)]
        for batch in batches:
            for row in batch.to_pylist():
                if row["seen"] is not None:  # rows, or blocks by class already
                    yield _rows([row], _BLOCK_ARROW)
                    continue
                if not row["classes"]:
                    often.append(np.frombuffer(row["hashes"], dtype=np.uint64))
                    continue
                counts = np.frombuffer(row["counts"], dtype=np.int32)
                got["cls"].append(np.repeat(np.frombuffer(row["classes"], dtype=np.uint64), counts))
                got["size"].append(np.repeat(np.frombuffer(row["sizes"], dtype=np.int32), counts))
                got["h"].append(np.frombuffer(row["hashes"], dtype=np.uint64))
        if not got["h"]:
            return
        h = np.concatenate(got.pop("h"))
        order = np.argsort(h, kind="stable")
        h = h[order]
        same = np.zeros(len(h) + 1, dtype=bool)
        same[1:-1] = h[1:] == h[:-1]
        several = same[1:] | same[:-1]  # others stand alone
        several |= np.isin(h, np.unique(np.concatenate(often)))
        order, h = order[several], h[several]
        cls, size = np.concatenate(got.pop("cls"))[order], np.concatenate(got.pop("size"))[order]
        order = np.lexsort((cls, h))
        h, cls, size = h[order], cls[order], size[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])  # tasks may have sent the same class
        h, cls, size = h[new], cls[new], size[new]
        edges = _runs(h)
        seen = np.repeat(np.diff(edges), np.diff(edges)).astype(np.int32)
        seen[np.isin(h, np.unique(np.concatenate(often)))] = LAST
        two = seen > 1
        h, cls, size, seen = h[two], cls[two], size[two], seen[two]
        yield from by_class(h, cls, size, seen, parts)
        release()

    return run


def to_sets(percent: int):
    """Blocks by class to sets: shared shingles rarest first, and how many of them stand in the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], dtype=np.int32)
                cls, size = np.frombuffer(row["classes"], dtype=np.uint64), np.frombuffer(row["sizes"], dtype=np.int32)
                got.append((np.repeat(cls, counts), np.repeat(size, counts), np.frombuffer(row["hashes"], dtype=np.uint64), np.frombuffer(row["seen"], dtype=np.int32)))
        if not got:
            return
        cls, size, h, seen = (np.concatenate(x) for x in zip(*got, strict=True))
        if (seen == LAST).any():  # tasks may have sent the same class
            order = np.lexsort((h, cls))
            cls, size, h, seen = cls[order], size[order], h[order], seen[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])
            cls, size, h, seen = cls[new], size[new], h[new], seen[new]
        # Classes with too few shared shingles for their prefix go before the costly sort.
        order = np.argsort(cls, kind="stable")
        edges = _runs(cls[order])
        n, shared = size[order][edges[:-1]].astype(np.int64), np.diff(edges)
        prefix = n - least_shared(n, percent) + 1 - (n - shared)
        keep = order[np.repeat(prefix > 0, shared)]
        cls, size, h, seen = cls[keep], size[keep], h[keep], seen[keep]
        order = np.lexsort((h, seen, cls))
        cls, size, h = cls[order], size[order], h[order]
        edges = _runs(cls)
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            n = int(size[a])
            prefix = n - int(least_shared(np.int64(n), percent)) + 1 - (n - int(b - a))
            rows.append({"class": int(cls[a].astype(np.int64)), "size": n, "prefix": min(prefix, int(b - a)), "hashes": h[a:b].astype(np.int64).tobytes()})
            if len(rows) == 500:
                yield _rows(rows, _SETS_ARROW)
                rows = []
        if rows:
            yield _rows(rows, _SETS_ARROW)

    return run


def to_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hash, class, size, place``: each set's prefix, with places counted over the whole set."""
    for batch in batches:
        for row in batch.to_pylist():
            h = np.frombuffer(row["hashes"], dtype=np.int64)
            alone = row["size"] - len(h)
            k = row["prefix"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:k]), pa.array(np.full(k, row["class"])), pa.array(np.full(k, row["size"], dtype=np.int32)), pa.array((alone + np.arange(k)).astype(np.int32))],
                names=["hash", "class", "size", "place"],
            )


def stretch(h: np.ndarray) -> np.ndarray:
    """Which of the suffix filter's stretches of hash values each element falls into."""
    return (h.view(np.uint64) >> np.uint64(60)).astype(np.int64)


def suffix_counts(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many elements of ``h`` after each place in ``at`` fall into each stretch."""
    inside = np.zeros((len(h) + 1, BUCKETS), dtype=np.int32)
    inside[np.arange(len(h)), stretch(h)] = 1
    after = inside[::-1].cumsum(axis=0)[::-1]
    return after[at + 1]


def need(total: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The fewest shared elements that link sets of so many in all: 100 shared >= percent * (total - shared)."""
    return -(-percent * total // (100 + percent))


def verify(percent: int):
    """Pairs with their sets to ``x, y, member, ok``: whether they link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, a, whole = [], None, None, None
            x, y, sx, sy, hx, hy = (batch.column(k) for k in ("x", "y", "size_x", "size_y", "hashes_x", "hashes_y"))
            for i in range(batch.num_rows):
                if x[i].as_py() != last:
                    last = x[i].as_py()
                    a = np.sort(np.frombuffer(hx[i].as_buffer(), dtype=np.int64))
                    whole = np.bincount(stretch(a), minlength=BUCKETS)
                b = np.frombuffer(hy[i].as_buffer(), dtype=np.int64)
                least = need(sx[i].as_py() + sy[i].as_py(), percent)
                ok = int(np.minimum(whole, np.bincount(stretch(b), minlength=BUCKETS)).sum()) >= least
                if ok:
                    at = np.searchsorted(a, b)
                    at[at == len(a)] = 0
                    ok = int((a[at] == b).sum()) >= least
                keep.append(ok)
            yield pa.RecordBatch.from_arrays([x, y, batch.column("member"), pa.array(keep, pa.bool_())], names=["x", "y", "member", "ok"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``x, y, member, ok`` of the candidate pairs ``x, y, member``: whether their sets are similar enough."""
    a = sets.select(F.col("class").alias("x"), F.col("size").alias("size_x"), F.col("hashes").alias("hashes_x"))
    b = sets.select(F.col("class").alias("y"), F.col("size").alias("size_y"), F.col("hashes").alias("hashes_y"))
    both = pairs.join(b, "y").join(a, "x").select("x", "y", "member", "size_x", "size_y", "hashes_x", "hashes_y")
    return both.mapInArrow(verify(percent), "x long, y long, member long, ok boolean")


def with_leaders(postings: DataFrame, percent: int) -> DataFrame:
    """``x, y, member``: each list's members paired with two of them, chosen by hashes of the class, less what the filters exclude.

    The positional bound is that of the shingle they met in, which may not be their first: what it
    excludes too much is met again among members of different components.
    """
    def first(seed: int) -> Column:
        return F.min(F.struct(F.xxhash64("class", F.lit(seed)).alias("o"), F.col("class"), "size", "place"))

    # A table of its own, so that a join with it can be split where a list is long.
    lists = cut(postings.groupBy("hash").agg(F.count("*").alias("n"), F.array(first(1), first(2)).alias("leaders")).where("n > 1"), "join-lists")
    met = postings.join(lists, "hash").select("class", "size", "place", F.explode("leaders").alias("l")).where(F.col("class") != F.col("l.class"))
    met = met.where(F.greatest("size", "l.size") * percent <= F.least("size", "l.size") * 100)
    pair = met.groupBy(F.least("class", "l.class").alias("x"), F.greatest("class", "l.class").alias("y")).agg(
        F.min("class").alias("member"), F.min(F.struct("place", F.col("size").alias("a"), F.col("l.size").alias("b"), F.col("l.place").alias("at"))).alias("m"))
    most = F.least(F.col("m.a") - F.col("m.place"), F.col("m.b") - F.col("m.at"))
    return pair.where(most * (100 + percent) >= (F.col("m.a") + F.col("m.b")) * percent).select("x", "y", "member")


class Side:
    """One side of a block: its classes' sets, and their places in lists that hold several components."""

    def __init__(self, d: pd.DataFrame) -> None:
        self.cls, self.comp, self.size = (d[c].to_numpy(np.int64) for c in ("class", "comp", "size"))
        self.sets = [np.frombuffer(h, dtype=np.int64) for h in d["hashes"]]
        count = [len(h) for h in d["listed"]]
        self.row, self.first = np.repeat(np.arange(len(d)), count), np.concatenate([[0], np.cumsum(count)])
        self.hash, self.place = (np.concatenate([np.asarray(x, dtype=np.int64) for x in d[c]]) for c in ("listed", "places"))
        self.other = np.concatenate([np.asarray(x, dtype=bool) for x in d["others"]])
        self.failed = [() if f is None else f for f in d["failed"]]
        order = np.argsort(self.hash, kind="stable")
        self.by_hash, self.edges = order, _runs(self.hash[order])
        self.named = self.hash[order][self.edges[:-1]]

    def list_of(self, i: int) -> np.ndarray:
        return self.by_hash[self.edges[i] : self.edges[i + 1]]

    def at(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the entry of each row and place is."""
        key = self.row << 32 | self.place
        order = np.argsort(key)
        return order[np.searchsorted(key[order], row << 32 | place)]

    def suffixes(self, entry: np.ndarray) -> np.ndarray:
        """For each entry, its set's elements after it by stretch of hash values."""
        out = np.zeros((len(self.row), BUCKETS), dtype=np.int32)
        for r in np.unique(self.row[entry]).tolist():
            own = slice(self.first[r], self.first[r + 1])
            out[own] = suffix_counts(self.sets[r], self.place[own] - (self.size[r] - len(self.sets[r])))
        return out[entry]


def candidates(x: Side, y: Side, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block to verify: those that first meet here, less what the three filters exclude."""
    ok = (x.comp[:, None] != y.comp[None, :]) & (np.maximum.outer(x.size, y.size) * percent <= np.minimum.outer(x.size, y.size) * 100)
    none = np.iinfo(np.int64).max
    px, py = (np.full(ok.shape, none) for _ in "xy")
    _, at_x, at_y = np.intersect1d(x.named, y.named, assume_unique=True, return_indices=True)
    for i, j in zip(at_x.tolist(), at_y.tolist(), strict=True):
        a, b = x.list_of(i), y.list_of(j)
        both = np.ix_(x.row[a], y.row[b])
        px[both] = np.minimum(px[both], x.place[a][:, None])
        py[both] = np.minimum(py[both], y.place[b][None, :])
    u, v = np.nonzero(ok & (px < none))
    if not len(u):
        return u, v
    a, b = x.at(u, px[u, v]), y.at(v, py[u, v])
    mine = x.other[a] & (~y.other[b] | (x.cls[u] < y.cls[v]))
    least = need(x.size[u] + y.size[v], percent)
    # No element before the first that both hold is shared, so these bound what is: the positional filter ...
    mine &= np.minimum(x.size[u] - x.place[a], y.size[v] - y.place[b]) >= least
    past = np.zeros(ok.shape, dtype=bool)
    for side, other, of in ((x, y, past), (y, x, past.T)):
        for i in (i for i, f in enumerate(side.failed) if len(f)):
            of[i] |= np.isin(other.cls, side.failed[i])
    mine &= ~past[u, v]
    u, v, a, b, least = u[mine], v[mine], a[mine], b[mine], least[mine]
    if not len(u):
        return u, v
    # ... and the suffix filter: of each stretch no more than the smaller count is shared.
    sx, sy, keep = x.suffixes(a), y.suffixes(b), np.zeros(len(u), dtype=bool)
    for i in range(0, len(u), 1 << 16):
        j = slice(i, i + (1 << 16))
        keep[j] = 1 + np.minimum(sx[j], sy[j]).sum(axis=1) >= least[j]
    return u[keep], v[keep]


def overlaps(x: Side, y: Side, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """How many elements the sets of each pair share: verification, ordered by ``u``."""
    sizes = np.array([len(s) for s in y.sets])
    _, ids = np.unique(np.concatenate(x.sets + y.sets), return_inverse=True)
    start = np.concatenate([[0], np.cumsum([len(s) for s in x.sets])])
    ids_x, ids_y, first = ids[: start[-1]], ids[start[-1] :], np.concatenate([[0], np.cumsum(sizes)])
    held, out = np.zeros(int(ids.max()) + 1, dtype=bool), np.zeros(len(u), dtype=np.int64)
    edges = _runs(u)
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        own = ids_x[start[u[i]] : start[u[i] + 1]]
        held[own] = True
        n = sizes[v[i:j]]
        upto, k = np.cumsum(n), 0
        while k < len(n):  # in gathers of bounded size
            stop = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + GATHER, side="right")))
            size = n[k:stop]
            ends = np.cumsum(size)
            at = np.repeat(first[v[i + k : i + stop]] - (ends - size), size) + np.arange(int(ends[-1]))
            out[i + k : i + stop] = np.add.reduceat(held[ids_y[at]].astype(np.int64), ends - size)
            k = stop
        held[own] = False
    return out


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the edges from ``a`` to ``b`` to keep so that the same nodes stay connected: fewer than nodes, however many edges."""
    names, ends = np.unique(np.stack([a, b]), return_inverse=True)
    ends = ends.reshape(2, -1)
    _, first = np.unique(np.sort(ends, axis=0), axis=1, return_index=True)  # one edge for each two nodes
    label, kept = np.arange(len(names)), []
    u, v = ends[:, first]
    while len(u):
        # Each tree takes its first edge to a tree of a smaller number, and all of them are joined.
        high, low = np.maximum(u, v), np.minimum(u, v)
        tree, at = np.unique(high, return_index=True)
        kept.append(first[at])
        label[tree] = low[at]
        while (label[label] != label).any():
            label = label[label]
        u, v = label[u], label[v]
        more = u != v
        u, v, first = u[more], v[more], first[more]
    return np.concatenate(kept) if kept else np.zeros(0, dtype=np.int64)


def block_links(percent: int, every: bool, told: bool):
    """``x, y, ok`` of one block of classes against one of list members: of the links as many as keep the same
    components connected, or ``every`` link, or all pairs verified if ``told``."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"x": np.zeros(0, np.int64), "y": np.zeros(0, np.int64), "ok": np.zeros(0, bool)})
        if left.empty or right.empty:
            return empty
        x, y = Side(left), Side(right)
        u, v = candidates(x, y, percent)
        if not len(u):
            return empty
        total = x.size[u] + y.size[v]
        ok = overlaps(x, y, u, v) >= need(total, percent)
        if not told:
            u, v, ok = u[ok], v[ok], ok[ok]
            if not every:
                at = forest(x.comp[u], y.comp[v])
                u, v, ok = u[at], v[at], ok[at]
        return pd.DataFrame({"x": np.minimum(x.cls[u], y.cls[v]), "y": np.maximum(x.cls[u], y.cls[v]), "ok": ok})

    return run


def across(postings: DataFrame, labels: DataFrame | None, sets: DataFrame, failed: DataFrame | None, percent: int, told: bool = False) -> DataFrame:
    """Links ``x, y, ok`` between list members of different components; every link, if there are no ``labels``.

    Members of a list's largest component don't meet each other; all others meet the whole list. Those others
    are put in blocks, like with like, and a block meets all members of its lists, in blocks. ``failed``: ``x, y,
    member`` of pairs that have been verified before. ``told``: all pairs verified here, whether they link or not.
    """
    every = labels is None
    if every:
        named = postings.withColumn("comp", F.col("class"))
    else:
        named = cut(postings.join(labels, "class", "left").withColumn("comp", F.coalesce("comp", "class")), "join-named")
    lead = F.min(F.struct(F.xxhash64("class", F.lit(1)).alias("o"), F.col("class")))
    sizes = named.groupBy("hash", "comp").agg(F.count("*").alias("n"), lead.alias("lead"))
    lists = sizes.groupBy("hash").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.min("lead").alias("lead"), F.count("*").alias("comps"))
    lists = lists.where("comps > 1").select("hash", F.lit(None).cast("long").alias("main") if every else "main", F.col("lead.class").alias("lead"), F.col("lead.o").alias("o"))
    mixed = named.join(cut(lists, "join-lists"), "hash").withColumn("other", F.col("main").isNull() | (F.col("comp") != F.col("main")))
    mixed = cut(mixed.select("hash", "class", "comp", "place", "other", "lead", "o"), "join-mixed")
    other = mixed.where("other")
    blocks = other.groupBy("class", "comp").agg(F.min_by("lead", F.struct("o", "lead")).alias("lead"))
    blocks = cut(blocks, "join-leads")
    blocks = blocks.join(cut(blocks.groupBy("lead").agg(F.count("*").alias("n")), "join-lead-sizes"), "lead")
    blocks = cut(blocks.select("class", "comp", "lead", F.pmod(F.xxhash64("class", F.lit(3)), F.ceil(F.col("n") / QUERIES)).alias("block")), "join-blocks")
    probes = cut(other.join(blocks.select("class", "lead", "block").withColumnRenamed("lead", "of"), "class").select("hash", "of", "block").distinct(), "join-probes")
    members = cut(probes.join(mixed.select("hash", "class"), "hash").select("of", "block", "class").distinct(), "join-members")
    chunks = cut(members.groupBy("of", "block").agg(F.ceil(F.count("*") / MEMBERS).alias("chunks")), "join-chunks")
    right = members.join(chunks, ["of", "block"]).withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(5)), F.col("chunks"))).drop("chunks")
    left = blocks.select("class", F.col("lead").alias("of"), "block").join(chunks, ["of", "block"])
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    entries = F.array_sort(F.collect_list(F.struct("place", "hash", "other")))
    own = mixed.groupBy("class", "comp").agg(entries.alias("e")).select("class", "comp", F.col("e.hash").alias("listed"), F.col("e.place").alias("places"), F.col("e.other").alias("others"))
    own = own.join(sets.select("class", "size", "hashes"), "class")
    if failed is None:
        own = own.withColumn("failed", F.lit(None).cast("array<long>"))
    else:
        past = failed.groupBy(F.col("member").alias("class")).agg(F.collect_set(F.when(F.col("x") == F.col("member"), F.col("y")).otherwise(F.col("x"))).alias("failed"))
        own = own.join(past, "class", "left")
    own = cut(own, "join-own")
    keys = ["of", "block", "chunk"]
    left, right = (d.join(own, "class").select(*keys, *own.columns) for d in (left, right))
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(block_links(percent, every, told), "x long, y long, ok boolean")


def components(edges: DataFrame) -> DataFrame:
    """``class, comp``: one class of each component, the same for all that ``x, y`` connect.

    Every round a class moves to its least neighbour, if that is less, and the edges are drawn anew between
    those classes, without repeats and loops: the graph shrinks until no edge is left. Classes are
    hashes, so chains shrink fast too. Each round's tables are written to the shared folder.
    """
    edges = cut(edges.select("x", "y").where("x <> y").distinct(), "join-edges")
    labels = cut(edges.select(F.explode(F.array("x", "y")).alias("class")).distinct().withColumn("comp", F.col("class")), "join-labels")
    while not edges.isEmpty():
        ends = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        to = cut(ends.groupBy(F.col("x").alias("was")).agg(F.least(F.min("y"), F.first("x")).alias("now")), "join-steps")
        for side in ("x", "y"):
            edges = edges.join(to, F.col(side) == F.col("was")).drop(side, "was").withColumnRenamed("now", side)
        edges = cut(edges.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "join-edges")
        labels = labels.join(to, F.col("comp") == F.col("was"), "left").select("class", F.coalesce("now", "comp").alias("comp"))
        labels = cut(labels, "join-labels")
    return labels


def relabelled(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels after links between components."""
    named = labels.select("class", F.col("comp").alias("c"))

    def of(side: str) -> DataFrame:
        return more.join(named.withColumnRenamed("class", side), side, "left").withColumn(side, F.coalesce("c", side)).drop("c")

    more = of("x")
    more = more.join(named.withColumnRenamed("class", "y"), "y", "left").withColumn("y", F.coalesce("c", "y")).drop("c")
    moved = components(more.where("x <> y").select("x", "y").distinct())
    moved = moved.select(F.col("class").alias("was"), F.col("comp").alias("now"))
    kept = labels.join(moved, labels["comp"] == moved["was"], "left").select("class", F.coalesce("now", "comp").alias("comp"))
    single = moved.select(F.col("was").alias("class"), F.col("now").alias("comp")).join(labels, "class", "left_anti")
    return cut(kept.unionByName(single), "join-labels")


def classes_and_sets(df: DataFrame, id_col: str, text_col: str, n: int, percent: int, often: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, class, size`` of every row, and the sets that can have a similar one."""
    spark, began = df.sparkSession, len(common.written)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(to_blocks(n, parts, often), BLOCK)
    counted = cut(sent.repartitionById(parts, F.col("part")).mapInArrow(count_shared(parts), BLOCK), "join-blocks")
    rows = counted.where(F.col("ids").isNotNull()).select("ids", "seen", "classes", "sizes").mapInArrow(_to_rows, "doc_id long, class long, size int")
    blocks = counted.where(F.col("ids").isNull())
    sets = blocks.repartitionById(parts, F.col("part")).mapInArrow(to_sets(percent), SETS)
    rows, sets = cut(rows, "join-rows"), cut(sets, "join-sets")
    common.remove_tables(spark, began, ("join-rows", "join-sets"))
    return rows, sets


def _to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            known = np.frombuffer(row["seen"], dtype=np.uint8).astype(bool)
            ids = pa.array(np.frombuffer(row["ids"], dtype=np.int64), mask=~known)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.frombuffer(row["classes"], dtype=np.uint64).astype(np.int64)), pa.array(np.frombuffer(row["sizes"], dtype=np.int32))], names=["doc_id", "class", "size"])


def near_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT, often: int = COMMON) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``df``.

    Rows link when 100 * shared >= percent * union of their sets; a component's id is its least
    ``doc_id``. A null or empty text, or one of white space only, has no shingles and links with nothing,
    not even its like: it is its own component. Rows with null ids take part and come out with a null id;
    rows with equal ids stay apart. Words and shingles are told apart by 64-bit hashes. An empty table gives
    no rows. Memory: a task holds one part of the shingles, of which there are ``spark.sql.shuffle.partitions``.
    """
    began = len(common.written)
    rows, sets = classes_and_sets(df, id_col, text_col, n, percent, often)
    labels, _ = linked_classes(sets, percent)

    least = cut(rows.where("size > 0").groupBy("class").agg(F.min("doc_id").alias("least")).join(labels, "class", "left").withColumn("comp", F.coalesce("comp", "class")), "join-least")
    named = least.join(cut(least.groupBy("comp").agg(F.min("least").alias("component_id")), "join-components"), "comp").select("class", "component_id")
    named = cut(named, "join-final")
    common.remove_tables(df.sparkSession, began, ("join-rows", "join-final"))
    out = rows.join(named, "class", "left")
    return out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def linked_classes(sets: DataFrame, percent: int, told: bool = False) -> tuple[DataFrame, DataFrame]:
    """``class, comp`` of the classes that link with any, and, if ``told``, ``x, y, ok`` of every pair that was verified."""
    postings = cut(sets.select("class", "size", "prefix", "hashes").mapInArrow(to_postings, "hash long, class long, size int, place int"), "join-postings")
    tried = cut(verified(with_leaders(postings, percent), sets, percent), "join-tried")
    labels = components(tried.where("ok"))
    more = cut(across(postings, labels, sets, tried.where("not ok"), percent, told), "join-links")
    return relabelled(labels, more.where("ok")), tried.select("x", "y", "ok").unionByName(more)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT, often: int = COMMON) -> DataFrame:
    """Of the rows of each component one: that with the least id (a null one is the last), and of these the first.

    It is a row that stays, not an id: of rows with equal ids those in other components are judged by themselves.
    Null, empty and blank texts link with nothing, so all of them stay. All columns of ``df`` pass through under
    their own names, in a struct of their own; an empty table gives no rows.
    """
    mine = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    whole = cut(df.select(F.monotonically_increasing_id().alias("row"), mine.alias("kept")), "join-whole")
    at = {c: F.col(f"kept.c{i}") for i, c in enumerate(df.columns)}
    found = near_components(whole.select("row", at[text_col].alias("text")), "row", "text", n, percent, often)
    best = F.struct(at[id_col].isNull().alias("none"), at[id_col].alias("id"), "row")
    narrow = found.select(F.col("doc_id").alias("row"), "component_id").join(whole.select("row", best.alias("best")), "row")
    stay = narrow.groupBy("component_id").agg(F.min("best").alias("best")).select("best.row")
    return whole.join(cut(stay, "join-stay"), "row", "left_semi").select(*[at[c].alias(c) for c in df.columns])


def near_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT, often: int = COMMON) -> DataFrame:
    """``x, y``: every link between different texts, as the least ids of the rows with those texts (x's hash is the smaller).

    For inspection: a group of similar texts has as many links as pairs. Texts whose rows have no id are left out.
    """
    rows, sets = classes_and_sets(df, id_col, text_col, n, percent, often)
    postings = sets.select("class", "size", "prefix", "hashes").mapInArrow(to_postings, "hash long, class long, size int, place int")
    links = across(cut(postings, "join-postings"), None, sets, None, percent).drop("ok")
    least = cut(rows.groupBy("class").agg(F.min("doc_id").alias("least")), "join-least")
    for side in ("x", "y"):
        links = links.join(least.withColumnRenamed("class", side), side).drop(side).withColumnRenamed("least", side)
    return links.select("x", "y")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


SQL = f"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {N - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - {N - 1}, 1) + 1 END)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= {PERCENT} * (nx.n + ny.n - k)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""
