"""Sharding by a permutation of row numbers (operator 8).

Rows get dense global numbers in the order of a hash of what they hold. A
Feistel network over a square a little larger than the row count permutes the
numbers; a number that falls outside is walked on until it falls inside. The
permuted number p gives the shard (p mod n) and the slot (p div n), so any row's
place can be computed again from its number, the row count and the seed alone.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import cut, documents, running_total

PRIME = 2_147_483_647
ROUNDS = 4
WALKS = 16
LONG_WALKS = 4096


def round_keys(seed: int) -> list[tuple[int, int]]:
    """A multiplier and an addend below 2^31 for each Feistel round."""
    draw = random.Random(seed)
    return [(draw.randrange(1, PRIME), draw.randrange(PRIME)) for _ in range(ROUNDS)]


def side(rows: int) -> int:
    """The side of the smallest square that holds ``rows`` numbers."""
    return max(1, math.isqrt(max(rows, 1) - 1) + 1)


def permute_number(x: int, rows: int, seed: int) -> int:
    """The permuted number of row ``x``, in plain integers: what the column below computes."""
    m, keys = side(rows), round_keys(seed)
    while True:
        for k, c in keys:
            left, right = divmod(x, m)
            v = (right * k + c) % PRIME
            x = right * m + (left + (v * v + k) % PRIME) % m
        if x < rows:
            return x


def permuted(number: Column, rows: int, seed: int) -> Column:
    """``number`` (0 to ``rows`` - 1) sent through the network, walked until it is below ``rows``.

    One element of the folded sequence is one round. A finished number is kept
    as -(p + 1). Walks beyond the first few are computed only for rows that need them.
    """
    m, keys = side(rows), round_keys(seed)
    k_all = F.array(*[F.lit(k).cast("long") for k, _ in keys])
    c_all = F.array(*[F.lit(c).cast("long") for _, c in keys])

    def one(acc: Column, i: Column) -> Column:
        at = (i % ROUNDS + 1).cast("int")
        k, right = F.element_at(k_all, at), acc % m
        left = ((acc - right) / m).cast("long")
        v = (right * k + F.element_at(c_all, at)) % PRIME
        nxt = right * m + (left + (v * v + k) % PRIME) % m
        return F.when(acc < 0, acc).when((i % ROUNDS == ROUNDS - 1) & (nxt < rows), -nxt - 1).otherwise(nxt)

    def walk(start: Column, walks: int) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(walks * ROUNDS - 1)), start, one)

    first = walk(number.cast("long"), WALKS)
    return F.transform(
        F.transform(F.array(first), lambda p: F.when(p < 0, p).otherwise(walk(p, LONG_WALKS))),
        lambda p: F.when(p < 0, -p - 1).otherwise(F.raise_error(F.lit("cycle walk did not end"))),
    )[0]


def numbered(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """Add ``out``: dense numbers from 0 in the order of (md5 of ``order``, ``order``), nulls first."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order])
    rows = rows.withColumn("_h", F.md5(text)).withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int")).withColumn("_one", F.lit(1).cast("long"))
    by = [F.col("_h"), *[F.col(c).asc_nulls_first() for c in order]]
    return running_total(rows, [], "_b", by, "_one", out).drop("_h", "_b", "_one")


def shard_rows(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 8) -> DataFrame:
    """One row for each row of ``df``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number``.

    Law ``rows``: shards differ by one row at most and slots are gapless from 0.
    A null text counts as empty (size 1, checksum 0); a null id is numbered like any other;
    repeated rows get numbers of their own, in any order among themselves, which no
    output column can tell apart. An empty table gives no rows. Other columns are not read.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    narrow = cut(
        df.select(F.col(id_col).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32")),
        "shard-rows",
    )
    total = narrow.count()
    p = permuted(F.col("row_number"), total, seed)
    return (
        numbered(narrow, ["doc_id", "size", "text_crc32"], "row_number")
        .withColumn("_p", p)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            (F.col("_p") % n_shards).cast("int").alias("shard"),
            ((F.col("_p") - F.col("_p") % n_shards) / n_shards).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "row_number",
        )
    )


SHARDS = 16
SEED = 8


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir), SHARDS, seed=SEED)


def _sql() -> str:
    k_list, c_list = (", ".join(str(key[j]) for key in round_keys(SEED)) for j in (0, 1))
    return f"""
WITH RECURSIVE
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
body AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
sized AS (
  SELECT doc_id, (octet_length(encode(text)) + 1)::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM body, crc_table),
num AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), size::VARCHAR, text_crc32::VARCHAR)), doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number
  FROM sized),
dims AS (SELECT count(*) AS rows, ceil(sqrt(count(*)))::BIGINT AS m FROM num),
walk(n, rows, m, x, step) AS (
  SELECT row_number, rows, m, row_number, 0 FROM num, dims
  UNION ALL
  SELECT n, rows, m, (x % m) * m + ((x // m) + (v * v + k) % {PRIME}) % m, step + 1
  FROM (SELECT *, ((x % m) * k + c) % {PRIME} AS v FROM (
    SELECT *, ([{k_list}])[step % 4 + 1] AS k, ([{c_list}])[step % 4 + 1] AS c FROM walk
    WHERE step = 0 OR step % 4 <> 0 OR x >= rows))),
done AS (SELECT n, arg_max(x, step) AS p FROM walk GROUP BY n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {SHARDS})::INTEGER AS shard, (p // {SHARDS})::BIGINT AS slot,
  NULL::INTEGER AS grown_shard, row_number
FROM num JOIN done ON n = row_number
"""


SQL = _sql()
