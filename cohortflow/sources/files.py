"""Inventories of files, datasets by date, and job reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators.dedup import newest
from cohortflow.sources.delimited import BadFile
from cohortflow.sources.streams import md5_of_files

ISSUES = "struct<issues: array<struct<severity: string, code: string, message: string, location: string, context: map<string,string>>>, counts: struct<error: long, warning: long, info: long>>"
REPORT = f"jobName string, jobType string, runId string, exitCode string, status string, startedAt string, finishedAt string, durationMillis long, inputValidation {ISSUES}, outputValidation {ISSUES}, metrics map<string,string>, errorMessage string"


def listing(spark: SparkSession, *globs: str) -> DataFrame:
    """``path, size, last_modified`` of the files that patterns match, none if none does. No bytes are read, whatever the sizes."""
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for g in globs:
        at = spark._jvm.org.apache.hadoop.fs.Path(g)
        if len(at.getFileSystem(conf).globStatus(at) or []):
            found.append(g)
    if not found:
        return spark.createDataFrame([], "path string, size long, last_modified timestamp")
    return spark.read.format("binaryFile").load(found).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def file_inventory(spark: SparkSession, root: str, digests: bool = False) -> DataFrame:
    """``study_id, label, name, key, version_id, last_modified, size`` of the files directly in consent folders below ``root``.

    Without a store's version ids a file's version is its size and time, so nothing is read; with ``digests`` it is the MD5 of what it holds,
    read as a stream.
    """
    rows = listing(spark, f"{root}/*/allConcepts/c*/*")
    at = "([^/]+)/allConcepts/(c[^/]+)/[^/]+$"
    own = F.concat_ws("-", "size", F.unix_micros("last_modified"))
    if digests:
        rows, own = rows.join(md5_of_files(rows).select("path", "md5"), "path"), F.col("md5")
    return rows.select(
        F.regexp_extract("path", at, 1).alias("study_id"), F.regexp_extract("path", at, 2).alias("label"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path").alias("key"),
        own.alias("version_id"), "last_modified", "size")


def current_versions(versions: DataFrame) -> DataFrame:
    """The current version of each file that is not deleted, from a listing with ``is_latest`` and ``is_deleted``."""
    return versions.where("is_latest and not is_deleted").drop("is_latest", "is_deleted")


def latest_dataset(names: DataFrame, given: str | None = None) -> str:
    """The newest of the directories named ``…-YYYYMMDD``, unless one is given."""
    if given:
        return given
    found = names.where(F.col("name").rlike("-\\d{8}$")).agg(F.max_by("name", F.struct(F.regexp_extract("name", "(\\d{8})$", 1), "name")).alias("n")).head()["n"]
    if found is None:
        raise BadFile("no dated dataset")
    return found


def read_reports(spark: SparkSession, glob: str) -> DataFrame:
    """The newest report of each job and run folder, by time then name: its fields, ``folder`` and ``file``. Unreadable files are absent."""
    df = spark.read.schema(REPORT + ", _corrupt_record string").options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record").json(glob)
    rows = df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
    rows = rows.where("_corrupt_record is null and jobName is not null").drop("_corrupt_record").withColumn("folder", F.regexp_extract("file", "^(.*)/[^/]*$", 1))
    return newest(rows, ["folder", "jobName"], "file", "modified").drop("modified", "candidates")


def issues(reports: DataFrame) -> DataFrame:
    """``jobName, folder, phase, severity, code, message, location, context`` of every issue."""
    phases = F.array(*[F.struct(F.lit(p).alias("phase"), F.col(f"{p}Validation.issues").alias("issues")) for p in ("input", "output")])
    each = reports.select("jobName", "folder", F.explode(phases).alias("p")).select("jobName", "folder", "p.phase", F.explode("p.issues").alias("i"))
    return each.select("jobName", "folder", "phase", "i.*")
