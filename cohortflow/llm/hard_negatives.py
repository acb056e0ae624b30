"""Hard-negative mining by inner product with STR-packed R-trees (operator 12).

Rows are tiled by sort-tile-recursive cuts, fitted on a bounded sample, into shards; a
tile of too many rows is dealt on. A box of least and greatest coordinates bounds what any
row in it can score with a query: each coordinate gives an interval, and their sum is
the box's. In waves a query goes to the shard that may hold its best scores, then to the
next few, then to all that are left, with the kth score so far; shards whose interval
misses its windows, or stays below the kth score, are never visited.

Within a shard an R-tree is packed likewise, tile by tile and level by level. A best-first
queue holds boxes by the highest score that they may have inside a window, and
drops boxes outside all windows or strictly below their kth score.

Positives are one search of rows of the same label with one window of all scores; negatives are
one of rows of other labels, with one window for each positive.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import cut
from cohortflow.llm.shingles import mix
from cohortflow.llm.topk import EXACT, NONE, SPACE, by_length, products, sent, usable, whole

#: Rows of a leaf, and boxes of an inner node.
LEAF, FAN = 256, 16
QUERY_BLOCK = 256
#: Rows of a shard at most, tiles at most, sampled rows for each tile, and queries that one task takes of a shard.
SHARD_ROWS, TILES, SAMPLE, GROUP_QUERIES = 65_536, 1024, 16, 16_384
#: Shards that a query visits before it is told its kth score: in the first wave, and until the second is over.
WAVES = (1, 9)
#: Bounds that a task works out at once.
BOUNDS = 1 << 21
MOST = 2**63 - 1
HITS = "query long, p int, vec_id long, score long"


def tiles(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Sort-tile-recursive: slabs of equal numbers of rows along the coordinate of the widest spread, each cut on along the next."""
    pages = -(-len(x) // size)
    dims = np.argsort(-x.var(axis=0), kind="stable")[: max(1, int(np.log2(max(pages, 1))))].tolist() if x.shape[1] else []
    out, todo = [], [(np.arange(len(x)), 0)]
    while todo:
        at, depth = todo.pop()
        pages = -(-len(at) // size)
        if pages > 1 and depth < len(dims):
            at = at[np.argsort(x[at, dims[depth]], kind="stable")]
            slabs = int(np.ceil(round(pages ** (1 / (len(dims) - depth)), 9)))
            rows = size * -(-pages // slabs)
            todo += [(at[i : i + rows], depth + 1) for i in range(0, len(at), rows)]
        else:
            out += [at[i : i + size] for i in range(0, len(at), size)]
    return out


class RTree:
    """Boxes over the rows of ``x``, packed level by level; ``rows[i]`` of a leaf, ``below[i]`` of an inner node; the root is last.

    ``order`` puts a leaf's rows side by side; leaves are stretches of rows in that order.
    """

    def __init__(self, x: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> None:
        leaves = tiles(x, leaf)
        self.order = np.concatenate(leaves)
        ends = np.cumsum([len(at) for at in leaves]).tolist()
        self.rows: list[slice | None] = [slice(e - len(at), e) for at, e in zip(leaves, ends, strict=True)]
        self.below: list[list[int] | None] = [None] * len(self.rows)
        low, high = [x[at].min(axis=0) for at in leaves], [x[at].max(axis=0) for at in leaves]
        level = list(range(len(self.rows)))
        while len(level) > 1:
            middle = np.array([(low[i] + high[i]) / 2 for i in level])
            above = []
            for group in tiles(middle, fan):
                members = [level[i] for i in group.tolist()]
                above.append(len(self.rows))
                self.rows.append(None)
                self.below.append(members)
                low.append(np.min([low[i] for i in members], axis=0))
                high.append(np.max([high[i] for i in members], axis=0))
            level = above
        self.low, self.high = np.array(low), np.array(high)


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each of ``q`` scores in each box at least and at most. Exact below 2^53, else with slack for rounding."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    size = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = np.where(size < EXACT, 0, 1e-9 * size)
    return least - slack, most + slack


@dataclass
class Rows:
    """Rows of one shard, all with as many components, in the order of its tree; ``about``: ``x`` as doubles."""

    x: np.ndarray
    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    about: np.ndarray


def limits(window: dict) -> tuple[float, float]:
    """The least score that still counts, and the greatest. Windows without ends reach beyond longs, where scores are an error."""
    low = max(window["lo"], window["floor"])
    return -np.inf if low <= -MOST else low, np.inf if window["hi"] >= MOST else window["hi"]


def best_first(tree: RTree, rows: Rows, q: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[float, float]], k: int, least: list[float], most: list[float], wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows in each window ``(at least, at most)``; ``NONE`` where there are fewer."""
    floor, roof = [w[0] for w in windows], [w[1] for w in windows]
    best = np.full((len(windows), k), NONE, dtype=np.int64)
    who = np.full((len(windows), k), MOST, dtype=np.int64)

    def reach(node: int) -> float | None:
        """The highest score that the box may have inside a window, if any."""
        a, b = least[node], most[node]
        inside = [min(b, hi) for lo, hi in zip(floor, roof, strict=True) if a <= hi and b >= lo]
        return max(inside) if inside else None

    root, as_doubles = len(tree.rows) - 1, q.astype(np.float64)
    queue = [(-r, root)] if (r := reach(root)) is not None else []
    while queue:
        _, node = heapq.heappop(queue)
        if reach(node) is None:  # a kth score has risen meanwhile
            continue
        if tree.below[node] is not None:
            for child in tree.below[node]:
                if (r := reach(child)) is not None:
                    heapq.heappush(queue, (-r, child))
            continue
        at = tree.rows[node]
        score = products(q[None, :], rows.x[at], True)[0] if wide else (rows.about[at] @ as_doubles).astype(np.int64)
        ok = (rows.label[at] == label) & (rows.row[at] != own) if same else rows.label[at] != label
        ok &= (score >= min(floor)) & (score <= max(roof))
        hits = np.flatnonzero(ok)
        if not len(hits):
            continue
        vec_id, score = rows.vec_id[at][hits], score[hits]
        for w in range(len(windows)):
            inside = (score >= floor[w]) & (score <= roof[w])
            if inside.any():
                s, v = np.concatenate([best[w], score[inside]]), np.concatenate([who[w], vec_id[inside]])
                order = np.lexsort((v, -s))[:k]
                best[w], who[w] = s[order], v[order]
                floor[w] = max(floor[w], int(best[w, -1]))
    return best, who


@dataclass
class Tiling:
    """By number of components: cuts of a sample's tiles as a tree of slabs, into how many shards each tile is dealt, and the shards' boxes."""

    cuts: dict[int, tuple]
    dealt: dict[int, int]
    boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def tile(self, x: np.ndarray) -> np.ndarray:
        """The tile of each row; lengths that the sample lacks have one tile."""
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(np.arange(len(x)), self.cuts.get(x.shape[1], ("tile", 0)))]
        while todo:
            at, node = todo.pop()
            if node[0] == "tile":
                out[at] = node[1]
                continue
            _, dim, edges, below = node
            slab = np.searchsorted(edges, x[at, dim], side="right")
            todo += [(at[slab == s], below[s]) for s in np.unique(slab).tolist()]
        return out


def sample_cuts(x: np.ndarray, size: int) -> tuple:
    """The cuts of ``tiles`` over a sample, as values: ``("slabs", coordinate, edges, below)`` down to ``("tile", number)``."""
    pages = -(-len(x) // size)
    dims = np.argsort(-x.var(axis=0), kind="stable")[: max(1, int(np.log2(max(pages, 1))))].tolist() if x.shape[1] else []
    count = iter(range(len(x) + 1))

    def split(at: np.ndarray, depth: int) -> tuple:
        pages = -(-len(at) // size)
        if pages <= 1 or depth == len(dims):
            return "tile", next(count)
        values = np.sort(x[at, dims[depth]])
        slabs = int(np.ceil(round(pages ** (1 / (len(dims) - depth)), 9))) if depth + 1 < len(dims) else pages
        rows = size * -(-pages // slabs)
        edges = np.unique(values[rows::rows])
        slab = np.searchsorted(edges, x[at, dims[depth]], side="right")
        return "slabs", dims[depth], edges, [split(at[slab == s], depth + 1) for s in range(len(edges) + 1)]

    return split(np.arange(len(x)), 0)


def shard_name(d: int, tile: np.ndarray, part: np.ndarray) -> np.ndarray:
    return np.int64(d) << 40 | tile << 20 | part


def route(tiling: Tiling):
    """Rows to their shards: tiles, dealt on by row where ``dealt`` says so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy()
            shard = np.zeros(len(row), dtype=np.int64)
            for at, v in by_length(batch.column("v")):
                name = shard_name(v.shape[1], tiling.tile(v.astype(np.float64)), np.int64(0))
                found, where = np.unique(name, return_inverse=True)
                dealt = np.array([tiling.dealt.get(s, 1) for s in found.tolist()], dtype=np.uint64)[where]
                shard[at] = name | (mix(row[at].astype(np.uint64)) % dealt).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shard)], names=[*batch.schema.names[:4], "shard"])

    return run


_BOX = pa.schema([("shard", pa.int64()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))])


def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The box of each shard's rows in a task."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        for at, v in by_length(batch.column("v")):
            for s in np.unique(shard[at]).tolist():
                mine = v[shard[at] == s]
                low, high = mine.min(axis=0), mine.max(axis=0)
                if s in found:
                    low, high = np.minimum(low, found[s][0]), np.maximum(high, found[s][1])
                found[s] = low, high
    yield pa.RecordBatch.from_arrays([pa.array(list(found)), *(pa.array([b[i].tolist() for b in found.values()], pa.list_(pa.int64())) for i in (0, 1))], schema=_BOX)


def choose(tiling: Tiling, first: int, last: int | None):
    """Queries to the ``first`` to ``last`` best of the shards whose intervals meet their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = batch.column("w").to_pylist()
            shards: list[list[int]] = [[] for _ in windows]
            for at, v in by_length(batch.column("v")):
                names, low, high = tiling.boxes[v.shape[1]]
                step = max(1, BOUNDS // len(names))
                for i in range(0, len(at), step):
                    q = v[i : i + step].astype(np.float64)
                    least, most = intervals(q, low, high)
                    middle = q @ ((low + high) / 2).T
                    for j, n in enumerate(at[i : i + step].tolist()):
                        reach, away = np.full(len(names), -np.inf), np.full(len(names), np.inf)
                        for w in windows[n]:
                            lo, hi = limits(w | {"floor": NONE})
                            near = np.minimum(most[j], hi)
                            better = (least[j] <= hi) & (most[j] >= lo) & (near > reach)
                            reach[better], away[better] = near[better], np.abs(middle[j] - near)[better]
                        # The windows' own bounds give the order in all waves; the kth scores so far drop shards from it.
                        order = np.lexsort((away, -reach))[first:last]
                        keep = np.zeros(len(order), dtype=bool)
                        for w in windows[n]:
                            lo, hi = limits(w)
                            keep |= (least[j][order] <= hi) & (most[j][order] >= lo)
                        shards[n] = names[order[keep]].tolist()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "label", "v", "w")), pa.array(shards, pa.list_(pa.int64()))], names=["row", "label", "v", "w", "shards"])

    return run


def shard_search(k: int, same: bool):
    """For a cogroup of one shard's rows and some of its queries; the tree is packed once for all of them."""

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, int]] = []
        if len(vectors) and len(queries):
            x = np.stack(vectors["v"].to_numpy()).astype(np.int64)
            tree = RTree(x.astype(np.float64))
            x = x[tree.order]
            rows = Rows(x, *(vectors[c].to_numpy(np.int64)[tree.order] for c in ("row", "vec_id", "label")), x.astype(np.float64))
            biggest = np.maximum(np.abs(tree.low), np.abs(tree.high)).max(axis=0)
            for i in range(0, len(queries), QUERY_BLOCK):
                part = queries.iloc[i : i + QUERY_BLOCK]
                q = np.stack(part["v"].to_numpy()).astype(np.int64)
                least, most = intervals(q.astype(np.float64), tree.low, tree.high)
                wide = np.abs(q.astype(np.float64)) @ biggest >= EXACT
                for j, (row, label, w) in enumerate(zip(part["row"].tolist(), part["label"].tolist(), part["w"].tolist(), strict=True)):
                    best, who = best_first(tree, rows, q[j], row, label, same, [limits(x) for x in w], k, least[j].tolist(), most[j].tolist(), bool(wide[j]))
                    found += [(row, w[a]["p"], int(who[a, b]), int(best[a, b])) for a, b in zip(*np.nonzero(best > NONE), strict=True)]
        return pd.DataFrame(found, columns=["query", "p", "vec_id", "score"])

    return run


def visit(rows: DataFrame, chosen: DataFrame, k: int, same: bool) -> DataFrame:
    """Hits of the queries in the shards chosen for them. Only rows of chosen shards are sent, once for each ``GROUP_QUERIES`` queries."""
    each = cut(chosen.withColumn("shard", F.explode("shards")).drop("shards"), "negatives-chosen")
    left, right = sent(rows, each, GROUP_QUERIES)
    left, right = left.select("row", "vec_id", "label", "v", "shard", "part"), right.select("row", "label", "v", "w", "shard", "part")
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(shard_search(k, same), HITS)


def search(rows: DataFrame, tiling: Tiling, queries: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
    """``query, p, vec_id, score, rank``: the k best rows of each query's window ``p``, of its own label or of others.

    ``queries``: rows with ``row, label, v``; ``windows``: ``row, p, lo, hi``, a handful for each row.
    """
    most, told, hits, first = max(len(b[0]) for b in tiling.boxes.values()), windows.withColumn("floor", F.lit(NONE).cast("long")), None, 0
    order = Window.partitionBy("query", "p").orderBy(F.col("score").desc(), "vec_id")
    for last in (*[w for w in WAVES if w < most], None):
        lists = told.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("p", "lo", "hi", "floor"))).alias("w"))
        chosen = queries.join(lists, "row").select("row", "label", "v", "w")
        chosen = chosen.mapInArrow(choose(tiling, first, last), "row long, label long, v array<long>, w array<struct<p:int,lo:long,hi:long,floor:long>>, shards array<long>")
        new = visit(rows, chosen, k, same)
        if last is not None:
            new = cut(new, "negatives-hits")
        hits = new if hits is None else hits.unionByName(new)
        if last is not None:
            first = last
            best = F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, k)
            kth = hits.groupBy(F.col("query").alias("row"), "p").agg(best.alias("b")).where(F.size("b") == k).select("row", "p", F.element_at("b", k).alias("floor"))
            told = windows.join(kth, ["row", "p"], "left").withColumn("floor", F.coalesce("floor", F.lit(NONE).cast("long")))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def tiled(rows: DataFrame, shard_rows: int | None) -> tuple[DataFrame, Tiling]:
    """``row, vec_id, label, v`` with their shards, and the tiling."""
    n = rows.count()
    size = shard_rows or min(SHARD_ROWS, max(2_048, n // 48))
    wanted = min(TILES, -(-n // size))
    few = F.pmod(F.xxhash64("row", F.lit(3)), F.lit(SPACE)) < int(SPACE * min(1.0, SAMPLE * wanted / n))
    sample = [r["v"] for r in rows.where(few).select("v").limit(2 * SAMPLE * wanted).collect()]
    tiling = Tiling({}, {}, {})
    for d in sorted({len(v) for v in sample}):
        mine = [v for v in sample if len(v) == d]
        x = np.array(mine, dtype=np.float64).reshape(len(mine), d)
        tiling.cuts[d] = sample_cuts(x, max(1, -(-len(sample) // wanted)))
    schema = "row long, vec_id long, label long, v array<long>, shard long"
    for tile in rows.mapInArrow(route(tiling), schema).groupBy("shard").count().where(F.col("count") > size).collect():
        tiling.dealt[tile["shard"]] = -(-tile["count"] // size)
    rows = cut(rows.mapInArrow(route(tiling), schema), "negatives-routed")

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": part["shard"].iloc[:1], "low": [np.min(part["low"].tolist(), axis=0)], "high": [np.max(part["high"].tolist(), axis=0)]})

    kind = "shard long, low array<long>, high array<long>"
    boxes = rows.select("shard", "v").mapInArrow(boxed, kind).groupBy("shard").applyInPandas(joined, kind).toArrow()
    names = boxes.column("shard").to_numpy()
    for d in np.unique(names >> 40).tolist():
        mine = boxes.filter(pa.array(names >> 40 == d)).sort_by("shard")
        low, high = (np.array(mine.column(c).to_pylist(), dtype=np.float64).reshape(len(mine), d) for c in ("low", "high"))
        tiling.boxes[d] = mine.column("shard").to_numpy(), low, high
    return rows, tiling


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", shard_rows: int | None = None
) -> DataFrame:
    """``OUT``: for each anchor and each of its best rows of the same label, the best rows of other labels whose score is within limits.

    Components become floor(256 x); scores are their inner products, exact up to a long, beyond which they are an error.
    Higher scores come first, ties go to the smaller id. The limits are ``low`` and ``high`` hundredths of the positive's score,
    so a positive below zero has no negatives. Fewer rows give fewer ranks; a positive without negatives, an anchor without
    positives and an empty table give no rows. Rows whose label, id or vector is null, or whose vector holds
    a null or a non-finite component, take no part; only rows of as many components are comparable. Rows of the same id stay
    apart: each is an anchor, a positive and a negative of its own. ``is_anchor`` is a condition on ``vec_id``;
    ``label`` replaces the label, from ``vec_id`` and ``label``. Columns but the three named are not read.

    A task holds one shard, of about ``SHARD_ROWS`` rows, and ``GROUP_QUERIES`` queries. The driver gets 16,384 sampled vectors and
    one box for each shard. Beyond ``TILES`` tiles shards of a tile share nearly one box, and vectors whose boxes don't
    separate them, as random ones in many dimensions, visit most shards: exact search then costs anchors times rows.
    """
    if not 0 < low <= high:
        raise ValueError("limits are positive, the lower one first")
    spark = df.sparkSession
    own = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("e"), F.col(f"`{label_col}`").cast("long").alias("label"))
    own = own.where(usable(F.col("e")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    named = (label if label is not None else F.col("label")).cast("long")
    rows = cut(own.select(F.monotonically_increasing_id().alias("row"), "vec_id", named.alias("label"), whole(F.col("e")).alias("v")), "negatives-rows")
    if rows.isEmpty():
        return spark.createDataFrame([], OUT)
    rows, tiling = tiled(rows, shard_rows)
    anchors = rows.where(is_anchor).select("row", "vec_id", "label", "v")
    everything = anchors.select("row", F.lit(0).alias("p"), F.lit(-MOST).alias("lo"), F.lit(MOST).alias("hi"))
    found = search(rows, tiling, anchors, everything, positives, True)
    pairs = cut(found.where("score >= 0").select(F.col("query").alias("row"), F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-pairs")

    def share(of: int, up: int) -> Column:
        """``of`` hundredths of the positive's score, rounded down, or up if ``up`` is 99; nothing on the way exceeds a long."""
        return F.expr(f"(positive_score div 100) * {of} + ((positive_score % 100) * {of} + {up}) div 100")

    windows = pairs.select("row", "p", share(low, 99).alias("lo"), share(high, 0).alias("hi"))
    hits = search(rows, tiling, anchors, windows, negatives, False)
    named_pairs = pairs.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    out = hits.select(F.col("query").alias("row"), "p", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(named_pairs, ["row", "p"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


EVERY = 50


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0, label=moved)


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.n, q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.n <> c.n AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0),
positives AS (
  SELECT n, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS p
  FROM scored WHERE same QUALIFY p <= 5),
ranked AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY n, p ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives JOIN (SELECT n, vec_id, score FROM scored WHERE NOT same) s USING (n)
  WHERE 50 * positive_score::HUGEINT <= 100 * s.score::HUGEINT AND 100 * s.score::HUGEINT <= 95 * positive_score::HUGEINT)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
