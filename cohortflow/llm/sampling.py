"""Bounded samples of labelled rows for training, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = 1 << 40


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4 are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def bounded(ids: DataFrame, rows: int, id_col: str = "doc_id", seed: int = 17) -> DataFrame:
    """About ``rows`` of the rows of ``ids``, chosen by a hash of the id: all of them if they are no more."""
    total = ids.count()
    if total <= rows:
        return ids
    return ids.where(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(SPACE)) < int(SPACE * rows / total))


def once(ids: list[int], sent: set[int]) -> list[bool]:
    """Which of ``ids`` a task has not sent yet. ``sent`` holds those of a bounded sample, and is added to."""
    new = []
    for i in ids:
        new.append(i not in sent)
        sent.add(i)
    return new


def even_share(counts: list[int], rows: int) -> int:
    """The most that each label may have so that all together have ``rows`` at most, when smaller labels leave theirs to the others; one at least."""
    left, labels = rows, len(counts)
    for n in sorted(counts):
        if n * labels > left:
            return max(1, left // labels)
        left, labels = left - n, labels - 1
    return max(counts, default=0)


def bounded_by(df: DataFrame, label: str, rows: int, id_col: str = "doc_id", seed: int = 17) -> DataFrame:
    """About ``rows`` of the rows of ``df``, shared evenly by its labels and chosen by a hash of the id: all of a label that has no more than its share, and the first of each."""
    place = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(SPACE))
    counts = df.groupBy(label).agg(F.count("*").alias("n"), F.min(place).alias("first")).collect()
    share = even_share([r["n"] for r in counts], rows)
    limits = df.sparkSession.createDataFrame([(r[label], max(r["first"] + 1, int(SPACE * min(1.0, share / r["n"])))) for r in counts], f"{label} string, _limit long")
    return df.join(F.broadcast(limits), label).where(place < F.col("_limit")).select(*df.columns)
