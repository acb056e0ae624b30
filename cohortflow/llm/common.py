"""What the corpus operators share: the shared folder, tables written to it, and running totals."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.sources.scratch import shared_folder

#: While a table is written: shuffle files go with their job, and batches of whole texts stay small.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
#: The paths that this session's operators have written, for ``remove_tables``.
written: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path of the shared folder that nothing has been written to; it is removed by ``remove_tables``."""
    path = f"{shared_folder(spark)}/cohortflow/{name}-{uuid.uuid4().hex}"
    written.append(path)
    return path


def remove_tables(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = (), only: list[str] | None = None) -> None:
    """Remove what operators wrote to the shared folder after the first ``since`` paths of ``written``, but for tables named in ``keep``.

    For the time when results that read those tables have been saved. ``only``: of these paths.
    """
    for path in [p for p in written[since:] if p.rpartition("/")[2].rpartition("-")[0] not in keep and (only is None or p in only)]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        written.remove(path)


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """``WRITING`` holds inside."""
    before = {k: spark.conf.get(k) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    Row ids made by ``monotonically_increasing_id`` are fixed from then on, and
    a lost executor costs no recomputation of what stands before. The job's shuffle
    files, which nothing reads again, are removed when it ends.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before, in order of ``bucket`` and ``order``, within ``keys``.

    Two levels keep a hot key from landing in one task: rows are summed within
    (keys, bucket), and only one row for each (keys, bucket) is summed within
    the keys. ``bucket`` must split a key finely enough. Keys must not be null.
    """
    by = [*keys, bucket]
    coarse = df.groupBy(*by).agg(F.sum(value).alias("_sub"))
    over = Window.partitionBy(*keys).orderBy(bucket) if keys else Window.orderBy(bucket)
    coarse = coarse.select(*by, (F.sum("_sub").over(over) - F.col("_sub")).alias("_base"))
    local = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = df.withColumn("_local", F.sum(value).over(local) - F.col(value))
    return within.join(coarse, by).withColumn(out, F.col("_base") + F.col("_local")).drop("_base", "_local")
