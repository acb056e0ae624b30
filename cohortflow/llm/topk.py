"""Exact top-k search by inner product with ball trees (operator 10).

A bounded sample gives the centres of cells, rows go to the nearest centre's cell, and
cells of too many rows are dealt on into shards; each shard is a ball of its cell's
centre and the distance of its farthest row. A query with norm |q| can score at most
q.c + |q|r in a ball with centre c and radius r. In waves a query goes to the shard of its
highest bound, then to the next few, then to all that are left; the kth score so far
goes with it, and shards whose bound it beats are never visited: in each wave only the rows of
shards that some query goes to are sent.
Within a shard a ball tree is searched likewise: blocks of queries walk its leaves from
the highest bound down, sharing each query's kth score from leaf to leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import cut
from cohortflow.llm.shingles import mix

LEAF = 128
QUERY_BLOCK = 256
#: Rows of a shard at most, cells at most, sampled rows for each cell, and queries that one group takes.
SHARD_ROWS, CELLS, SAMPLE, GROUP_QUERIES = 65_536, 1024, 16, 65_536
#: Bounds that a task works out at once.
BOUNDS = 1 << 21
#: Shards that a query visits before it is told its kth score: in the first wave, and until the second is over.
WAVES = (1, 9)
SPACE = 1 << 20
#: Whole numbers up to here are exact as doubles, and scores up to here are longs.
EXACT, LONG = 2.0**53, 2.0**63
HITS = "query long, query_id long, vec_id long, score long"


class BallTree:
    """Balls over the rows of ``x``: each split at the median along the line between two far points."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF) -> None:
        self.leaves: list[np.ndarray] = []
        centres, radii = [], []
        todo = [np.arange(len(x))]
        while todo:
            at = todo.pop()
            c = x[at].mean(axis=0)
            away = ((x[at] - c) ** 2).sum(axis=1)
            if len(at) <= leaf or not away.any():
                # A ball of equal points may hold more rows than a leaf: cut it for bounded blocks.
                for i in range(0, len(at), leaf):
                    self.leaves.append(at[i : i + leaf])
                    centres.append(c)
                    radii.append(np.sqrt(away.max()))
                continue
            a = x[at[away.argmax()]]
            b = x[at[((x[at] - a) ** 2).sum(axis=1).argmax()]]
            side = x[at] @ (b - a)
            order = np.argsort(side, kind="stable")
            todo += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]
        self.centres, self.radii = np.array(centres), np.array(radii)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x**2).sum(axis=1))


def bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """What each of ``q`` can score in each ball at most, with some slack for rounding."""
    length = norms(q)[:, None]
    return q @ centres.T + length * radii[None, :] + 1e-9 * length * (norms(centres) + radii)[None, :] + 1e-3


def products(q: np.ndarray, x: np.ndarray, wide: bool) -> np.ndarray:
    """The integer inner products of whole vectors. ``wide``: they may be beyond what doubles tell apart.

    Sums of longs wrap around, so a score that fits a long is right whatever came between; one that doesn't is an error.
    """
    about = q.astype(np.float64) @ x.astype(np.float64).T
    if not wide:
        return about.astype(np.int64)
    if about.size and np.abs(about).max() >= LONG * (1 - 1e-9):
        raise OverflowError("an inner product is beyond a long")
    return q @ x.T


def better(score: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: highest score, then smallest id."""
    order = np.lexsort((vec, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(vec, order, 1)


NONE = -(2**63) + 1


def search(tree: BallTree, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, q_rows: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows of one shard for each query; ``NONE`` where there are fewer.

    ``floor``: a score below which a row can't be among the query's k best anywhere. A query's own row is left out.
    """
    as_floats = q.astype(np.float64)
    bound = bounds(as_floats, tree.centres, tree.radii)
    wide = bool(len(x) and len(q)) and norms(as_floats).max() * (norms(tree.centres) + tree.radii).max() >= EXACT
    best = np.full((len(q), k), NONE, dtype=np.int64)
    who = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)
    kth = floor.copy()
    for leaf in np.argsort(-bound.max(axis=0), kind="stable"):
        live = np.flatnonzero(bound[:, leaf] >= kth)
        if not len(live):
            continue
        at = tree.leaves[leaf]
        score = products(q[live], x[at], wide)
        score[q_rows[live][:, None] == rows[at][None, :]] = NONE
        wins = np.flatnonzero(score.max(axis=1) >= kth[live])
        if not len(wins):
            continue
        mine = live[wins]
        merged = np.concatenate([best[mine], score[wins]], axis=1)
        names = np.concatenate([who[mine], np.broadcast_to(ids[at], (len(mine), len(at)))], axis=1)
        best[mine], who[mine] = better(merged, names, k)
        kth[mine] = np.maximum(kth[mine], best[mine][:, -1])
    return best, who


def whole(vector: Column) -> Column:
    def one(v: Column) -> Column:
        x = F.lit(256) * v.cast("double")
        return F.when(F.abs(x) < LONG, F.floor(x).cast("long")).otherwise(F.raise_error(F.lit("a vector's component is beyond a long")).cast("long"))

    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    def finite(v: Column) -> Column:
        d = v.cast("double")
        return v.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))

    return vector.isNotNull() & F.forall(vector, finite)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of an Arrow list column by their number of components: the rows, and their matrix."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().to_numpy(zero_copy_only=False)
    first = np.cumsum(ends) - ends
    for d in np.unique(ends).tolist():
        at = np.flatnonzero(ends == d)
        yield at, flat[first[at][:, None] + np.arange(d)[None, :]]


@dataclass
class Cells:
    """By number of components: the cells' centres and into how many shards each is dealt; and the shards with their cells and radii."""

    centres: dict[int, np.ndarray]
    dealt: dict[int, np.ndarray]
    shards: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def of(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Lengths that the sample lacks have one cell around zero."""
        return self.centres.get(d, np.zeros((1, d))), self.dealt.get(d, np.ones(1, dtype=np.int64))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = ((centres**2).sum(axis=1) - 2 * x[i : i + 4096] @ centres.T).argmin(axis=1)
    return out


def make_cells(sample: list[list[int]], n: int, size: int) -> Cells:
    """Cells around the leaves of a tree over the sample, dealt by the share of the sample that is nearest."""
    cells = Cells({}, {})
    for d in sorted({len(v) for v in sample}):
        own = [v for v in sample if len(v) == d]
        x = np.array(own, dtype=np.float64).reshape(len(own), d)
        rows = n * len(x) / len(sample)
        wanted = min(CELLS, max(1, round(rows / size)))
        centres = np.unique(BallTree(x, max(1, -(-len(x) // wanted))).centres, axis=0) if wanted > 1 else x.mean(axis=0)[None, :]
        share = np.bincount(nearest(x, centres), minlength=len(centres)) / len(x)
        cells.centres[d], cells.dealt[d] = centres, np.maximum(1, np.ceil(share * rows / size)).astype(np.int64)
    return cells


def shard_name(d: int, cell: np.ndarray, part: np.ndarray) -> np.ndarray:
    return np.int64(d) << 40 | cell << 28 | part


def route(cells: Cells):
    """``row, vec_id, v`` to their shards, and the distance to its centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy()
            shard, away = np.zeros(len(row), dtype=np.int64), np.zeros(len(row))
            for at, v in by_length(batch.column("v")):
                x = v.astype(np.float64)
                centres, dealt = cells.of(v.shape[1])
                cell = nearest(x, centres)
                part = (mix(row[at].astype(np.uint64)) % dealt[cell].astype(np.uint64)).astype(np.int64)
                shard[at], away[at] = shard_name(v.shape[1], cell, part), norms(x - centres[cell])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard), pa.array(away)], names=[*batch.schema.names, "shard", "away"])

    return run


def choose(cells: Cells, first: int, last: int | None):
    """Queries to the shards of the ``first`` to ``last`` highest bounds, as far as a bound reaches the query's ``floor``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floor = batch.column("floor").to_numpy()
            shards: list[list[int]] = [[] for _ in floor]
            for at, v in by_length(batch.column("v")):
                names, cell, radius = cells.shards[v.shape[1]]
                centres = cells.of(v.shape[1])[0][cell]
                step = max(1, BOUNDS // len(names))
                for a in range(0, len(at), step):
                    some = at[a : a + step]
                    bound = bounds(v[a : a + step].astype(np.float64), centres, radius)
                    order = np.argsort(-bound, axis=1, kind="stable")[:, first:last]
                    ok = np.take_along_axis(bound, order, 1) >= floor[some][:, None]
                    for i, o, keep in zip(some.tolist(), order, ok, strict=True):
                        shards[i] = names[o[keep]].tolist()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "vec_id", "v", "floor")), pa.array(shards, pa.list_(pa.int64()))], names=["row", "vec_id", "v", "floor", "shards"])

    return run


def shard_search(k: int):
    """For a cogroup of one shard's vectors and some of its queries; the tree is built once for all of them."""

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query", "query_id", "vec_id", "score")})
        if vectors.empty or queries.empty:
            return empty
        x = np.stack(vectors["v"].to_numpy()).astype(np.int64)
        rows, ids = vectors["row"].to_numpy(np.int64), vectors["vec_id"].to_numpy(np.int64)
        tree = BallTree(x.astype(np.float64))
        found = []
        for i in range(0, len(queries), QUERY_BLOCK):
            part = queries.iloc[i : i + QUERY_BLOCK]
            q = np.stack(part["v"].to_numpy()).astype(np.int64)
            q_rows, q_ids = part["row"].to_numpy(np.int64), part["vec_id"].to_numpy(np.int64)
            best, who = search(tree, x, rows, ids, q, q_rows, part["floor"].to_numpy(np.int64), k)
            keep = (best > NONE).ravel()
            found.append(pd.DataFrame({"query": np.repeat(q_rows, k)[keep], "query_id": np.repeat(q_ids, k)[keep], "vec_id": who.ravel()[keep], "score": best.ravel()[keep]}))
        return pd.concat(found)

    return run


def top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sent(rows: DataFrame, each: DataFrame, group_queries: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a visit by shard and part: the rows of shards that a query goes to, once for each ``group_queries`` of them, and the queries."""
    sizes = cut(each.groupBy("shard").agg(F.ceil(F.count("*") / group_queries).alias("parts")), "top-k-parts")
    left = rows.join(sizes, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    right = each.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.col("parts"))).drop("parts")
    return left, right


def visit(rows: DataFrame, chosen: DataFrame, k: int, group_queries: int) -> DataFrame:
    """Hits of the queries in the shards chosen for them."""
    left, right = sent(rows, cut(chosen.withColumn("shard", F.explode("shards")).drop("shards"), "top-k-chosen"), group_queries)
    left, right = left.select("row", "vec_id", "v", "shard", "part"), right.select("row", "vec_id", "v", "floor", "shard", "part")
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(shard_search(k), HITS)


def exact_top_k(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int | None = None, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the highest integer inner product for each query row.

    Components become floor(256 x). Every usable row is a candidate for every query but itself, rows of
    the same id among them; only rows of as many components are comparable. Ties go to the smaller id.
    Rows whose vector is null or holds a null or a non-finite component, and rows without id, take
    no part. Fewer candidates give fewer ranks, an empty table none. Scores are exact up to a long; a component or
    a score beyond it is an error. ``is_query`` is a condition on ``vec_id``. Columns but the two named are not read.
    Each task holds one shard and as many queries as ``group_queries``, whatever the table's size. The driver gets
    16,384 sampled vectors at most, and one distance for each shard, which is one for 65,536 rows. There are ``CELLS`` cells at most: beyond as many shards
    those of a cell share its ball, and their number no longer adds to what bounds exclude.
    """
    own = df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = cut(own.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), whole(F.col(vector_col)).alias("v")), "top-k-rows")
    n = rows.count()
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = shard_rows or min(SHARD_ROWS, max(2_048, n // 48))
    wanted = SAMPLE * min(CELLS, -(-n // size))
    few = F.pmod(F.xxhash64("row", F.lit(3)), F.lit(SPACE)) < int(SPACE * min(1.0, wanted / n))
    cells = make_cells([r["v"] for r in rows.where(few).select("v").limit(2 * wanted).collect()], n, size)
    rows = cut(rows.mapInArrow(route(cells), "row long, vec_id long, v array<long>, shard long, away double"), "top-k-routed")
    radii = rows.groupBy("shard").agg(F.max("away").alias("radius")).orderBy("shard").collect()
    for d in {r["shard"] >> 40 for r in radii}:
        mine = [r for r in radii if r["shard"] >> 40 == d]
        names = np.array([r["shard"] for r in mine], dtype=np.int64)
        cells.shards[d] = names, names >> 28 & 0xFFF, np.array([r["radius"] for r in mine])
    most = max(len(s[0]) for s in cells.shards.values())

    queries = rows.where(is_query).select("row", "vec_id", "v")
    told, hits, first = queries.withColumn("floor", F.lit(NONE).cast("long")), None, 0
    for last in (*[w for w in WAVES if w < most], None):
        chosen = told.mapInArrow(choose(cells, first, last), "row long, vec_id long, v array<long>, floor long, shards array<long>")
        new = visit(rows, chosen, k, group_queries)
        if last is None:
            hits = new if hits is None else hits.unionByName(new)
            break
        new = cut(new, "top-k-hits")
        hits, first = new if hits is None else hits.unionByName(new), last
        best = F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, k)
        kth = hits.groupBy(F.col("query").alias("row")).agg(best.alias("b")).where(F.size("b") == k).select("row", F.element_at("b", k).alias("floor"))
        told = queries.join(kth, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE).cast("long")))
    return top(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


K = 5
EVERY = 50


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0, K)


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.n <> c.n AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
