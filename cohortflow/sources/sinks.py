"""Writing concept files, indexes, maps, tables and reports.

Files whose name others rely on are written by ``text`` into a directory of that name: one part file where one
ordered file is asked for, several where a group may be large.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.functions.cells import csv_quote, quoted_line
from cohortflow.functions.studies import concept_file
from cohortflow.operators.reshape import VCF_HEADER
from cohortflow.sources.scratch import written
from cohortflow.sources.streams import move

CONCEPT = ("person_id", "path", "numeric", "text", "timestamp")


def concept_line() -> Column:
    return quoted_line(*[F.col(c) for c in CONCEPT])


def write_concepts(rows: DataFrame, root: str, files_per_group: int = 1) -> None:
    """Quoted concept lines below ``root`` by ``study_id`` and ``consent_label``. Groups without rows write nothing.

    A large group is spread over several files by a hash of the row.
    """
    lines = rows.select("study_id", F.concat(F.lit("c"), F.col("consent_code")).alias("consent_label"), concept_line().alias("value"))
    spread = F.pmod(F.xxhash64("value"), F.lit(files_per_group))
    lines.repartition(F.col("study_id"), F.col("consent_label"), spread).write.mode("overwrite").partitionBy("study_id", "consent_label").text(root)


def parted(df: DataFrame, *by: str) -> DataFrame:
    """``df`` with all partition columns: a write without rows makes no folder that tells of them."""
    return df.withColumns({c: F.lit(None).cast("string") for c in by if c not in df.columns})


def written_files(spark: SparkSession, root: str, *by: str) -> DataFrame:
    """``path`` and the partition columns of the files that a partitioned write made below ``root``; those of ``by`` also where it wrote none. Their bytes are not read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(root)
    return parted(df.drop("modificationTime", "length", "content"), *by)


def written_lines(spark: SparkSession, root: str, *by: str) -> DataFrame:
    """``value`` and the partition columns of the lines that a partitioned write made below ``root``; those of ``by`` also where it wrote none."""
    return parted(spark.read.text(root), *by)


def move_files(files: DataFrame, target: str) -> int:
    """Move each file of ``path`` to ``name`` below ``target``, over what is there; how many there were. Files are renamed by tasks, not read."""
    done = written(move(files.select("path", F.concat(F.lit(f"{target}/"), "name").alias("to"))), "moved")
    told = done.agg(F.count("*").alias("n"), F.min("error").alias("error"), F.min_by("to", F.col("error").isNull()).alias("to")).head()
    if told["error"] is not None:
        raise OSError(f"{told['to']} could not be put in place: {told['error']}")
    return told["n"]


def publish_concepts(spark: SparkSession, root: str, target: str) -> int:
    """Give the files that ``write_concepts`` made below ``root`` the names that readers look for below ``target``.

    ``study/allConcepts/c1/study_allConcepts_c1.csv``; of a group of several files the others have their number
    before the suffix.
    """
    place = F.row_number().over(Window.partitionBy("study_id", "consent_label").orderBy("path"))
    first = concept_file(F.col("study_id"), F.substring("consent_label", 2, 20))
    later = F.concat(F.regexp_replace(first, "\\.csv$", "."), place, F.lit(".csv"))
    files = written_files(spark, root, "study_id", "consent_label").select("path", F.when(place == 1, first).otherwise(later).alias("name"))
    return move_files(files, target)


def write_csv_minimal(df: DataFrame, path: str, order: list[str], columns: list[str] | None = None) -> None:
    """One file with a header, cells quoted only where needed, rows in order. For reports. ``columns``: those to write, all if not given."""
    columns = columns or df.columns
    header = ",".join(columns)
    lines = df.select(F.lit(1).alias("_k"), *order, F.concat_ws(",", *[csv_quote(F.col(c)) for c in columns]).alias("value"))
    head = df.sparkSession.createDataFrame([(header,)], "value string").select(F.lit(0).alias("_k"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order], "value")
    head.unionByName(lines).repartition(1).sortWithinPartitions("_k", *order).select("value").write.mode("overwrite").text(path)


def vcf_lines(rows: DataFrame) -> DataFrame:
    """``consent_group, n, value``: the group's name, the header, and its 23 rows. The first row brings the two lines above it, so rows are made once."""
    cells = [F.col("vcf_path"), F.col("chromosome"), F.lit("TRUE"), F.lit("TRUE"), F.col("sample_ids"), F.col("patient_ids"), F.lit(""), F.lit("")]
    tops = [F.struct(F.lit(i).alias("n"), c.alias("value")) for i, c in enumerate((F.col("consent_group"), F.lit(VCF_HEADER)))]
    own = F.struct((F.col("n") + 2).alias("n"), F.concat_ws("\t", *cells).alias("value"))
    return rows.select("consent_group", F.explode(F.when(F.col("n") == 0, F.array(*tops, own)).otherwise(F.array(own))).alias("l")).select("consent_group", "l.*")


def gathered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a key's rows in one task, dealt by a hash of it. A repartition by the key itself is left out by Spark where frames, or all sides
    of a union, are dealt by it already; their partitions may then be put together or split each in their own way.
    """
    return df.repartition(F.xxhash64(key))


def write_vcf_indexes(rows: DataFrame, root: str) -> None:
    """One ordered file for each consent group."""
    gathered(vcf_lines(rows), "consent_group").sortWithinPartitions("consent_group", "n").select("consent_group", "value").write.mode("overwrite").partitionBy("consent_group").text(root)


def write_sample_ids(rows: DataFrame, root: str) -> None:
    """``person_id,abv,sample`` lines for each consent group, unquoted."""
    lines = rows.select("consent_group", F.concat_ws(",", "person_id", "abv", "source_sample_id").alias("value"))
    gathered(lines, "consent_group").sortWithinPartitions("consent_group", "value").write.mode("overwrite").partitionBy("consent_group").text(root)


def write_identity_map(rows: DataFrame, root: str, per_study: bool, files: int = 1) -> None:
    """``identity,study_id,consent_code`` in that order, with a header; one for each study, or ``files`` in order for all.

    One file means that its rows are sorted in one task; a large map is better written as several, each a range.
    """
    out = rows.select("identity", "study_id", "consent_code")
    order = ["identity", "study_id", "consent_code"]
    if per_study:
        out = out.withColumn("study", F.col("study_id")).repartition("study").sortWithinPartitions("study", *order)
        out.write.mode("overwrite").options(header=True, quote="").partitionBy("study").csv(root)
    else:
        dealt = out.repartition(1) if files == 1 else out.repartitionByRange(files, *order)
        dealt.sortWithinPartitions(*order).write.mode("overwrite").options(header=True, quote="").csv(root)


def write_identity_tables(spark: SparkSession, root: str, **tables: DataFrame) -> str:
    """All tables staged in a new snapshot, then named in ``root``'s pointer, with a number: readers see all of them or none."""
    name = f"snapshot-{uuid.uuid4().hex}"
    for t, df in tables.items():
        writer = df.write.mode("errorifexists")
        (writer.partitionBy("study_id") if "study_id" in df.columns else writer).parquet(f"{root}/{name}/{t}")
    last = pointers(spark, root).agg(F.max("n")).head()[0] if exists(spark, f"{root}/pointer") else 0
    spark.createDataFrame([(f"{last + 1} {name}",)], "value string").coalesce(1).write.mode("append").text(f"{root}/pointer")
    return name


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def pointers(spark: SparkSession, root: str) -> DataFrame:
    """``n, name`` of every snapshot that was named. Writers take turns: a store has one at a time."""
    parts = F.split("value", " ", 2)
    return spark.read.text(f"{root}/pointer").select(parts[0].cast("long").alias("n"), parts[1].alias("name"))


def read_identity_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table of the snapshot with the highest number."""
    snapshot = pointers(spark, root).agg(F.max_by("name", "n")).head()[0]
    return spark.read.option("basePath", f"{root}/{snapshot}/{name}").parquet(f"{root}/{snapshot}/{name}")


def write_reports(path: str, order: list[str], **tables: DataFrame) -> None:
    """Each table as CSV and as JSON, whole. All are written aside first, so that a failure leaves the reports that stood before."""
    stage = f"{path}/.staged-{uuid.uuid4().hex}"
    for name, df in tables.items():
        own = [c for c in order if c in df.columns]
        df.repartition(1).sortWithinPartitions(*own).write.json(f"{stage}/{name}.json")
        flat = df.select(*[F.concat_ws("; ", c).alias(c) if t.startswith("array") else F.col(c).cast("string").alias(c) for c, t in df.dtypes])
        write_csv_minimal(flat, f"{stage}/{name}.csv", own)
    for spark in [df.sparkSession for df in tables.values()][:1]:
        fs_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        fs = fs_path(path).getFileSystem(conf)
        for file in [f"{name}.{kind}" for name in tables for kind in ("json", "csv")]:
            fs.delete(fs_path(f"{path}/{file}"), True)
            if not fs.rename(fs_path(f"{stage}/{file}"), fs_path(f"{path}/{file}")):
                raise OSError(f"{path}/{file} could not be put in place")
        fs.delete(fs_path(stage), True)


def publish_manifest(rows: DataFrame, problems: DataFrame, root: str, run_id: str) -> bool:
    """The manifest and its copy, only if no problem is an error. The pointer to it is written last."""
    if not problems.where("severity = 'ERROR'").isEmpty():
        return False
    out = rows.select("partition", "uri", "version_id", "last_updated", "md5", (F.col("partition") != "global").alias("_later"))
    for path in (f"{root}/{run_id}/manifest", f"{root}/{run_id}/copy"):
        write_csv_minimal(out, path, ["_later", "partition"], [c for c in out.columns if c != "_later"])
    rows.sparkSession.createDataFrame([(run_id,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/current")
    return True
