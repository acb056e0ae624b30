"""The prefix trie of conversations, by adaptive radix trees (operator 11).

A turn's id is the 128-bit digest of its role and text, big-endian; a conversation's key is
the ids of its turns end to end. Keys are sorted by ranges, so that a prefix's members
stand side by side. A task takes its range block by block: it puts a block's keys into
an adaptive radix tree, whose nodes hold 4, 16, 48 or 256 children and compress paths,
and walks it; only byte depths at which a turn ends are nodes of the trie.

A node is settled when its first and last members have been seen. That holds for all but the prefixes of
a block's first and last key. What these have gathered so far is carried to the next
block, from the last block of a task to a tree over the carries of neighbouring tasks, and so on
until one is left: a hot prefix costs one narrow row for each task, and copies of a conversation are spread over
as many tasks as they fill.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import cut

#: Bytes of a turn's id.
WIDTH = 16
#: Conversations of a block, and turns of it, at most (or one conversation).
BLOCK, BLOCK_TURNS = 8192, 1 << 17
#: Tasks whose carries are put together at once, as a power of two.
TOGETHER = 8
NOBODY = 2**63 - 1


class Node:
    """A node of an adaptive radix tree: the bytes that lead to it, a value if a key ends here, and its children.

    Up to 4 and up to 16 children stand in the order of their bytes; up to 48 are found by an index of 256 places; then every byte has a place.
    """

    __slots__ = ("path", "value", "sample", "room", "bytes", "index", "below")

    def __init__(self, path: bytes, value: int, sample: int) -> None:
        self.path, self.value, self.sample = path, value, sample
        self.room, self.bytes, self.index, self.below = 4, bytearray(), None, []

    def find(self, byte: int) -> Node | None:
        if self.room <= 16:
            at = self.bytes.find(byte)
            return self.below[at] if at >= 0 else None
        if self.room == 48:
            at = self.index[byte]
            return self.below[at] if at < 48 else None
        return self.below[byte]

    def count(self) -> int:
        return len(self.below) if self.room < 256 else sum(c is not None for c in self.below)

    def put(self, child: Node) -> None:
        """Add a child, or take the place of the one with its first byte."""
        byte = child.path[0]
        if self.room <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.below[at] = child
                return
            if len(self.below) == self.room:
                self.grow()
                return self.put(child)
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.below.insert(at, child)
        elif self.room == 48:
            if self.index[byte] < 48:
                self.below[self.index[byte]] = child
                return
            if len(self.below) == 48:
                self.grow()
                return self.put(child)
            self.index[byte] = len(self.below)
            self.below.append(child)
        else:
            self.below[byte] = child

    def grow(self) -> None:
        """The next larger layout."""
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            self.room, self.index = 48, bytearray([48]) * 256
            for at, byte in enumerate(self.bytes):
                self.index[byte] = at
            self.bytes = None
        else:
            self.room, self.below = 256, [self.below[at] if at < 48 else None for at in self.index]
            self.index = None

    def children(self) -> list[Node]:
        """In the order of their bytes."""
        if self.room <= 16:
            return self.below
        if self.room == 48:
            return [self.below[at] for at in self.index if at < 48]
        return [c for c in self.below if c is not None]


def shared(path: bytes, key: bytes, at: int) -> int:
    """How many bytes ``path`` shares with ``key`` from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    same, most = 0, min(len(path), len(key) - at)
    while same < most:
        step = (same + most + 1) // 2
        if path[same:step] == key[at + same : at + step]:
            same = step
        else:
            most = step - 1
    return same


class RadixTree:
    def __init__(self) -> None:
        self.root = Node(b"", -1, -1)

    def insert(self, key: bytes, value: int) -> None:
        parent, node, at = None, self.root, 0
        while True:
            same = shared(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same], -1, node.sample)
                node.path = node.path[same:]
                upper.put(node)
                parent.put(upper)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                if node.sample < 0:
                    node.sample = value
                return
            child = node.find(key[at])
            if child is None:
                return node.put(Node(key[at:], value, value))
            parent, node = node, child


@dataclass
class Path:
    """A key whose prefixes from ``start`` turns on are not settled, and what each has gathered from those below that are.

    ``n`` members, the smallest of them, settled children, and the leaves and saved tokens below these; ``ids`` names each prefix from the root on.
    """

    key: bytes
    points: np.ndarray
    start: int
    n: list[int]
    least: list[int]
    kids: list[int]
    leaves: list[int]
    saved: list[int]
    ids: list[bytes] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.ids = self.ids or named(self.key)


def named(key: bytes) -> list[bytes]:
    """A name for each prefix of whole turns: a digest of the one before and the next turn."""
    out = [hashlib.md5(b"").digest()]
    for at in range(0, len(key), WIDTH):
        out.append(hashlib.md5(out[-1] + key[at : at + WIDTH]).digest())
    return out


@dataclass
class Settled:
    """Columns of nodes, of ends that are told apart from their nodes, and the paths that are carried on."""

    nodes: list[tuple] = field(default_factory=list)
    ends: list[tuple] = field(default_factory=list)
    carried: list[Path] = field(default_factory=list)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def settle(carried: list[Path], keys: list[bytes], points: list[np.ndarray], conv_ids: list[int], out: Settled, last: bool = False) -> None:
    """Put carried paths and conversations, all in the order of their keys, into one tree; add what is settled to ``out`` and carry on the rest.

    ``last``: nothing follows and nothing stood before, so that all is settled.
    """
    tree, groups = RadixTree(), []  # of a group: its key, turns' lengths, and conversations
    paths: list[tuple[int, Path]] = []
    for p in carried:
        if not groups or groups[-1][0] != p.key:
            groups.append((p.key, p.points, []))
        paths.append((len(groups) - 1, p))
    for key, length, c in zip(keys, points, conv_ids, strict=True):
        if not groups or groups[-1][0] != key:
            groups.append((key, length, []))
        groups[-1][2].append(c)
    for g, (key, _, _) in enumerate(groups):
        tree.insert(key, g)

    # Nodes of the trie before those below them.
    above, depth, length, end = [-1], [0], [0], [0] * len(groups)
    todo = [(tree.root, 0, 0)]
    while todo:
        node, at, top = todo.pop()
        to = at + len(node.path)
        for d in range(at // WIDTH + 1, to // WIDTH + 1):
            above.append(top)
            depth.append(d)
            length.append(int(groups[node.sample][1][d - 1]))
            top = len(above) - 1
        if node.value >= 0:
            end[node.value] = top
        todo += [(child, to, top) for child in node.children()]

    size = len(above)
    n, least, kids, leaves, saved = [0] * size, [NOBODY] * size, [0] * size, [0] * size, [0] * size
    names: dict[int, bytes] = {}  # of nodes that were carried
    for g, p in paths:
        at = end[g]
        for i in range(len(p.n) - 1, -1, -1):
            n[at] += p.n[i]
            least[at] = min(least[at], p.least[i])
            kids[at] += p.kids[i]
            leaves[at] += p.leaves[i]
            saved[at] += p.saved[i]
            names[at] = p.ids[p.start + i]
            at = above[at]
    for g, (_, _, own) in enumerate(groups):
        if own:
            n[end[g]] += len(own)
            least[end[g]] = min(least[end[g]], own[0])

    unsettled: dict[int, bytes] = {}
    edges = [] if last else [0] if len(groups) == 1 else [0, len(groups) - 1]
    routes = []
    for g in edges:
        route, ids = [], named(groups[g][0])
        at = end[g]
        while at >= 0:
            route.append(at)
            unsettled[at] = ids[depth[at]]
            at = above[at]
        routes.append((g, route[::-1], ids))
    for at in range(size - 1, -1, -1):
        if at in unsettled:
            continue
        leaves[at] = leaves[at] or 1
        saved[at] += (n[at] - 1) * length[at]
        up = above[at]
        if up >= 0:
            n[up] += n[at]
            least[up] = min(least[up], least[at])
            kids[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]

    ends = {}
    for g, (_, _, own) in enumerate(groups):
        if own:
            told, name = ",".join(map(str, own)), unsettled.get(end[g]) or names.get(end[g])
            if name is None:
                ends[end[g]] = hashlib.sha256(told.encode()).hexdigest()
            else:
                out.ends.append((name, own[0], told))
    for at in range(size):
        if at not in unsettled:
            up = above[at]
            known = up >= 0 and up not in unsettled
            name = names.get(at)
            out.nodes.append((least[at], depth[at], least[up] if known else None, n[at], kids[at], leaves[at], saved[at], None if name else ends.get(at, NO_ENDS), name, None if known or up < 0 else unsettled[up]))
    out.carried, taken = [], 0
    for g, route, ids in routes:
        mine = route[taken:]
        out.carried.append(Path(groups[g][0], np.array(groups[g][1]), taken, *([x[at] for at in mine] for x in (n, least, kids, leaves, saved)), ids))
        other = set(route)
        taken = sum(at in other for at in routes[-1][1]) if len(routes) > 1 else 0


_LONGS = pa.list_(pa.int64())
_OUT = pa.schema(
    [
        ("kind", pa.string()), *((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()), ("node", pa.binary()), ("parent", pa.binary()),
        ("first_id", pa.int64()), ("ids", pa.string()),
        ("task", pa.int64()), ("place", pa.int64()), ("key", pa.binary()), ("points", _LONGS), ("start", pa.int64()), *((c, _LONGS) for c in ("n", "least", "kids", "leaves", "saved")),
    ]
)
OUT = "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node binary, parent binary, first_id long, ids string, " + (
    "task long, place long, key binary, points array<long>, start long, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>"
)


def rows_of(out: Settled, task: int, carry: bool) -> pa.RecordBatch:
    """What has been settled, taken out of ``out``, and if ``carry`` the paths that are carried on."""
    parts = []
    nodes, ends, carried = out.nodes, out.ends, out.carried if carry else []
    if nodes:
        parts.append({"kind": ["node"] * len(nodes)} | dict(zip(_OUT.names[1:11], map(list, zip(*nodes, strict=True)), strict=True)))
    if ends:
        parts.append({"kind": ["ends"] * len(ends)} | dict(zip(("node", "first_id", "ids"), map(list, zip(*ends, strict=True)), strict=True)))
    if carried:
        named = {c: [getattr(p, c) for p in carried] for c in ("key", "start", "n", "least", "kids", "leaves", "saved")}
        parts.append({"kind": ["path"] * len(carried), "task": [task] * len(carried), "place": list(range(len(carried))), "points": [p.points.tolist() for p in carried], **named})
    out.nodes, out.ends = [], []
    sizes = [len(p["kind"]) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array([v for p, k in zip(parts, sizes, strict=True) for v in p.get(f.name, [None] * k)], f.type) for f in _OUT], schema=_OUT)


def settle_range(block: int, block_turns: int):
    """``conv_id, key, points`` in the order of key and id to ``OUT``: one range of all, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, seen = TaskContext.get().partitionId(), Settled(), False
        for batch in batches:
            keys, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            flat, sizes = batch.column(2).flatten().to_numpy(zero_copy_only=False), batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            first = 0
            while first < len(keys):
                last = min(first + block, max(first + 1, int(np.searchsorted(upto, upto[first] + block_turns, side="right")) - 1), len(keys))
                settle(out.carried, keys[first:last], [flat[upto[i] : upto[i + 1]] for i in range(first, last)], ids[first:last], out)
                yield rows_of(out, task, False)
                first, seen = last, True
        if seen:
            yield rows_of(out, task, True)

    return run


def settle_carried(last: bool):
    """The paths that some neighbouring tasks carried on to ``OUT``."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        paths = [Path(r["key"], np.array(r["points"], dtype=np.int64), r["start"], *(r[c] for c in ("n", "least", "kids", "leaves", "saved"))) for r in table.sort_by([("task", "ascending"), ("place", "ascending")]).to_pylist()]
        out = Settled()
        settle(paths, [], [], [], out, last)
        return pa.Table.from_batches([rows_of(out, key[0].as_py(), not last)])

    return run


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, ids`` in the order of nodes and ids to each node's digest of all its ids, comma-joined, a piece at a time."""
    node, digest = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_told"])

    for batch in batches:
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name == node:
                digest.update(b"," + ids.encode())
                continue
            if digest:
                yield told()
            node, digest = name, hashlib.sha256(ids.encode())
    if digest:
        yield told()


def keyed(df: DataFrame, base: Column | None, head: Column | None, heads: int, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, key, points`` of every conversation: its turns' ids end to end, and their code points."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    tid = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = df.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), tid.alias("tid"), F.length(text).cast("long").alias("points")).where("conv_id is not null")
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "tid", "points"))).alias("t"))
    if base is not None:
        convs = cut(convs.select("conv_id", base.alias("base"), head.alias("h"), F.transform("t", lambda x: F.struct(x["tid"].alias("tid"), x["points"].alias("points"))).alias("t")), "trie-conversations")
        needed = convs.select(F.col("base").alias("conv_id")).distinct()
        begins = convs.select("conv_id", F.slice("t", 1, heads).alias("head")).join(needed, "conv_id", "left_semi").withColumnRenamed("conv_id", "base")
        convs = convs.join(begins, "base", "left")
        none = F.slice("t", 1, 0)
        before = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
        own = F.slice("t", F.col("h") + 1, F.greatest(F.size("t") - F.col("h"), F.lit(0)))
        convs = convs.select("conv_id", F.concat(before, own).alias("t"))
    key = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["tid"])), ""))
    return convs.select("conv_id", key.alias("key"), F.transform("t", lambda x: x["points"]).alias("points"))


def prefix_trie(df: DataFrame, base: Column | None = None, head: Column | None = None, heads: int = 0, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each distinct sequence of first turns, the textless root among them.

    ``conv_id`` the smallest member, ``depth`` in turns, ``parent_conv_id`` that of the parent, null at the root, ``n_convs`` members,
    ``n_children``, ``n_leaves`` nodes without children below it or itself, ``saved_tokens`` the code points of turns below it and of its own
    that members after the first repeat, ``ends_sha256`` the digest of the ids of those members that end here.

    Turns are in the order of ``turn``, null first; turns of an equal number in that of their digests. Null roles and texts
    are empty; rows without a conversation's id take no part; repeated rows are turns of their own. An empty table gives no
    rows. Columns but the four named are not read. With ``base`` and ``head``, columns of ``conv_id``, a conversation is first rebuilt:
    its first ``head`` turns, ``heads`` at most, become those of the conversation ``base``, all if there are fewer, none if it is absent.

    Turns are told apart by 128-bit digests. A task holds one block of ``block`` conversations, and a conversation
    whole, at some 300 bytes for each of its turns; so does the shuffle that gathers its turns.
    """
    spark = df.sparkSession
    turns = keyed(df, base, head, heads, id_col, turn_col, role_col, text_col)
    ranges = turns.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").select("conv_id", "key", "points")
    tables = [cut(ranges.mapInArrow(settle_range(block, block_turns), OUT), "trie-ranges")]
    tasks = tables[0].where("kind = 'path'").agg(F.max("task")).first()[0]
    if tasks is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    while True:
        tasks >>= TOGETHER
        paths = tables[-1].where("kind = 'path'")
        tables.append(cut(paths.groupBy(F.shiftright("task", TOGETHER).alias("g")).applyInArrow(settle_carried(not tasks), OUT), "trie-carried"))
        if not tasks:
            break
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    nodes = every.where("kind = 'node'").select(*_OUT.names[1:11])
    ends = every.where("kind = 'ends'").select("node", "ids", "first_id").repartition("node").sortWithinPartitions("node", "first_id")
    ends = ends.select("node", "ids").mapInArrow(hashed, "node binary, ends_told string")
    late = nodes.where("node is not null").join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_told", F.lit(NO_ENDS))).select(*_OUT.names[1:11])
    nodes = late.unionByName(nodes.where("node is null"))
    # Only children of carried nodes, and the root, still lack their parent.
    parents = every.where("kind = 'node' and node is not null").select(F.col("node").alias("parent"), F.col("conv_id").alias("theirs"))
    found = nodes.where("parent is not null").join(parents, "parent").withColumn("parent_conv_id", F.col("theirs")).select(*_OUT.names[1:9])
    return found.unionByName(nodes.where("parent is null").select(*_OUT.names[1:9]))


#: The query's conversations begin like the first of each so many, for fewer turns than so many.
FAMILY, HEADS = 100, 6


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), c - c % FAMILY, (F.crc32(c.cast("string")) % HEADS).cast("int"), HEADS - 1)


SQL = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
turns AS (
  SELECT conv_id, tid, points, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS pos FROM (
    SELECT conv_id, turn, length(coalesce(text, '')) AS points, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS tid
    FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT h.conv_id, t.tid, t.points, t.pos FROM heads h JOIN turns t ON t.conv_id = h.base AND t.pos <= h.h
  UNION ALL SELECT h.conv_id, t.tid, t.points, t.pos FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.pos > h.h),
whole AS (SELECT h.conv_id, coalesce(s, []) AS s, coalesce(p, []) AS p FROM heads h
  LEFT JOIN (SELECT conv_id, list(tid ORDER BY pos) AS s, list(points ORDER BY pos) AS p FROM rebuilt GROUP BY conv_id) USING (conv_id)),
prefixes AS (
  SELECT conv_id, d, array_to_string(s[:d], '') AS k, array_to_string(s[:greatest(d - 1, 0)], '') AS up, d = len(s) AS ends, CASE WHEN d > 0 THEN p[d] ELSE 0 END AS points
  FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM whole)),
nodes AS (
  SELECT k, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(points) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY k),
below AS (SELECT up, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY up),
sums AS (
  SELECT a.k, count(*) FILTER (NOT EXISTS (SELECT 1 FROM below WHERE below.up = b.k)) AS n_leaves, sum(b.saved) AS saved_tokens
  FROM nodes a JOIN nodes b ON starts_with(b.k, a.k) GROUP BY a.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.up LEFT JOIN below ON below.up = n.k JOIN sums ON sums.k = n.k
"""
