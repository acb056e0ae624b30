"""Tables written to the shared folder, so that lineage ends there and numbers made on the way stay as they are."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, a temporary one on local masters and else an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("cohortflow.scratch", "")
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("cohortflow.scratch", base)
    return base.rstrip("/")


#: What this session's jobs have written here, for ``remove_tables``.
paths: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path of the shared folder that nothing has been written to; ``remove_tables`` removes it."""
    path = f"{shared_folder(spark)}/cohortflow/{name}-{uuid.uuid4().hex}"
    paths.append(path)
    return path


def remove_tables(spark: SparkSession, since: int = 0) -> None:
    """Remove what has been written to the shared folder after the first ``since`` of ``paths``: once results that read it have been saved."""
    for path in paths[since:]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del paths[since:]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
