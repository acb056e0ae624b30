"""One row of several: the first, last, newest or preferred of a key. Orders are explicit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.functions.cells import trimmed
from cohortflow.functions.studies import consent_code, natural_key


def with_row_order(df: DataFrame, out: str = "ord") -> DataFrame:
    """Number the rows of files as they stand: by file, block and place, increasing but not dense.

    For frames read straight from files. A frame has no order of its own afterwards.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), F.monotonically_increasing_id().alias("n"))
    return df.select(*df.columns, place.alias(out))


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key; partial aggregation, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def first_usable_consent(df: DataFrame, keys: list[str], code: str, order: str, own: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Each key's first code that is a number but 0, and how many later rows have another (``keys, code, conflicts``); and the keys that say 0 and never another.

    Keys with only blank codes, or codes that are no numbers, are in neither. ``own``: a column of another id, which comes
    from the row whose code is used, or is the first that is not blank of the rows of 0.
    """
    name = F.col(own) if own else F.lit(None).cast("string")
    rows = df.select(*keys, consent_code(F.col(code)).alias("_code"), F.col(order).alias("_o"), name.alias("_own"))
    counts = rows.groupBy(*keys, "_code").agg(
        F.count("*").alias("_n"), F.min("_o").alias("_first"), F.min_by("_own", "_o").alias("_own"), F.min_by("_own", F.when(trimmed(F.coalesce("_own", F.lit(""))) != "", F.col("_o"))).alias("_named"))
    usable, zero = F.coalesce(F.col("_code") != "0", F.lit(False)), F.coalesce(F.col("_code") == "0", F.lit(False))
    per = counts.groupBy(*keys).agg(
        F.min_by(F.struct("_code", "_n", "_own"), F.when(usable, F.col("_first"))).alias("_r"), F.sum(F.when(usable, F.col("_n"))).alias("_all"), F.max(usable).alias("_usable"), F.max(zero).alias("_zero"), F.max(F.when(zero, F.col("_named"))).alias("_named"))
    yes = per.where("_usable").select(*keys, F.col("_r._code").alias(code), (F.col("_all") - F.col("_r._n")).alias("conflicts"), *([F.col("_r._own").alias(own)] if own else []))
    return yes, per.where("_zero and not _usable").select(*keys, *([F.coalesce("_named", F.lit("")).alias(own)] if own else []))


def code_conflicts(df: DataFrame, keys: list[str], code: str, order: str) -> DataFrame:
    """Keys with rows whose code differs from the row before: ``keys, conflicts, examples`` (five at most, in order)."""
    from cohortflow.operators.aggregates import first_examples

    before = F.lag(code).over(Window.partitionBy(*keys).orderBy(order))
    rows = df.withColumn("_before", before).where(F.col("_before").isNotNull() & (F.col("_before") != F.col(code)))
    rows = rows.withColumn("_change", F.concat_ws("->", "_before", code))
    return first_examples(rows, keys, "_change", order, 5).withColumnRenamed("count", "conflicts")


def newest(df: DataFrame, keys: list[str], name: str, time: str | None = None) -> DataFrame:
    """The newest candidate of each key, and how many there were: by time then name, or by the name's numbers."""
    order = F.struct(time, name) if time else F.struct(natural_key(F.col(name)), F.col(name))
    rest = [c for c in df.columns if c not in keys]
    per = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"), F.count("*").alias("candidates"))
    return per.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest], "candidates")


def preferred(df: DataFrame, keys: list[str], worse: Column, name: str) -> DataFrame:
    """The candidate of each key that is not ``worse``, then first by name, and how many there were."""
    order = Window.partitionBy(*keys).orderBy(worse.cast("int"), F.col(name))
    rows = df.withColumn("_n", F.row_number().over(order)).withColumn("candidates", F.count("*").over(Window.partitionBy(*keys)))
    return rows.where("_n = 1").drop("_n")


def paired_dictionaries(df: DataFrame, keys: list[str], name: str, subject_name: str) -> DataFrame:
    """The newest dictionary of each key: of those with the subject file's table accession, when any have it."""
    accession = F.nullif(F.regexp_extract(F.lower(subject_name), "pht\\d{6}", 0), F.lit(""))
    rows = df.withColumn("_pair", F.coalesce(F.contains(F.lower(name), accession), F.lit(False)))
    rows = rows.withColumn("_any", F.max("_pair").over(Window.partitionBy(*keys)))
    return newest(rows.where(F.col("_pair") | ~F.col("_any")).drop("_pair", "_any"), keys, name)


def first_labels(df: DataFrame, keys: list[str], label: str, position: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(label, position).alias(label))


def first_failure(df: DataFrame, order: str) -> DataFrame:
    """The failure that comes first in folder order, as one row (none without failures)."""
    return df.where("severity = 'ERROR'").orderBy(order).limit(1)
