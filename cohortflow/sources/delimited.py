"""Delimited files as frames of strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows are flagged by their width only when all their cells are parsed.
WHOLE_ROWS = {"columnPruning": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def flagged(column: str) -> Column:
    """Whether a row is of another width. Spark answers no query of the record of bad rows alone, so a cell is looked at too."""
    return F.col("_corrupt_record").isNotNull() & (F.coalesce(F.length(F.col(f"`{column}`")), F.lit(0)) >= 0)


class BadFile(ValueError):
    """A file that can't be used as a whole."""


def read_delimited(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """A file with a header, quoted as needed. Missing cells are empty. ``multi_line`` only where cells hold line breaks: such files aren't split."""
    df = spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE").csv(path)
    return df.na.fill("")


def read_run_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Plans and outcomes: tab-separated, quotes are literal."""
    return spark.read.options(header=True, sep="\t", quote="").csv(path).na.fill("")


def read_commented(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A file with comment lines before its header and literal quotes. A row wider than the header is an error; shorter ones are filled."""
    opts = {"header": True, "sep": sep, "quote": "", "comment": "#"}
    names = spark.read.options(**opts).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(schema).options(**opts, **WHOLE_ROWS).csv(path)
    width = F.size(F.split(F.col("_corrupt_record"), sep, -1))
    fine = F.col("_corrupt_record").isNull() | (width <= len(names))
    checked = F.when(fine, F.lit(True)).otherwise(F.raise_error(F.lit(f"{path}: a row is wider than the header")))
    return df.where(checked).drop("_corrupt_record").na.fill("")


def read_wide(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A quoted file with a header, as it stands, and ``malformed``: true for rows of another width. Missing cells are empty."""
    opts = {"header": True, "sep": sep, "quote": '"', "escape": '"'}
    names = spark.read.options(**opts).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(schema).options(**opts, **WHOLE_ROWS).csv(path)
    return df.withColumn("malformed", flagged(names[0])).drop("_corrupt_record").na.fill("")


def read_positional(spark: SparkSession, path: str, n: int, sep: str = ",") -> DataFrame:
    """Headerless rows: ``c0`` to ``c{n-1}`` and ``malformed``, true for rows of another width."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n)] + [T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(schema).options(sep=sep, quote='"', escape='"', **WHOLE_ROWS).csv(path)
    return df.withColumn("malformed", flagged("c0")).drop("_corrupt_record")


def require_columns(df: DataFrame, names: list[str], what: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise BadFile(f"{what} lacks columns: {', '.join(missing)}")
    return df


def require_none(df: DataFrame, bad, what: str) -> DataFrame:
    """The frame, if no row is ``bad``: one count before it is used."""
    n = df.where(bad).count()
    if n:
        raise BadFile(f"{what}: {n} rows")
    return df
