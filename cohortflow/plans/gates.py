"""Data-quality gates: frames in, issues out (``severity, code`` and what they are about)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.studies import is_study_id
from cohortflow.operators.aggregates import SEVERITY, severity_rank
from cohortflow.operators.reshape import union


# The codes of issues in this file are fixed values: reports carry them.


def verdict(issues: DataFrame, keys: list[str]) -> DataFrame:
    """FAILED for any error, SUCCESS_WITH_WARNINGS for any warning, else SUCCESS."""
    top = F.max(severity_rank(F.col("severity")))
    return issues.groupBy(*keys).agg(F.when(top == SEVERITY["ERROR"], "FAILED").when(top == SEVERITY["WARNING"], "SUCCESS_WITH_WARNINGS").otherwise("SUCCESS").alias("verdict"))


def failed_checks(row: DataFrame, checks: dict[str, Column], severity: str = "ERROR", keys: list[str] | None = None) -> DataFrame:
    """An issue for each condition that a row of metrics does not meet; a null one is not met."""
    keys = keys or []
    each = F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks.items()])
    return row.select(*keys, F.explode(F.array_compact(each)).alias("code")).select(*keys, F.lit(severity).alias("severity"), "code")


def load_checks(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """What a subject-sample load must satisfy, over its row of counts (or one for each of ``keys``); no new people or samples is a warning."""
    hard = {
        "CONSENTS_NOT_PARTICIPANTS": F.col("consents_written") == F.col("distinct_participants"),
        "MORE_INSERTED_THAN_DISTINCT": F.col("participants_inserted") <= F.col("distinct_participants"),
        "MORE_SAMPLES_THAN_SEEN": F.col("samples_inserted") <= F.col("samples_seen"),
        "MORE_SAMPLES_THAN_ROWS": F.col("samples_seen") <= 2 * F.col("rows_read"),
        "NO_CONSENT_GROUPS": F.col("consent_groups") > 0,
    }
    soft = {"NO_NEW_PARTICIPANTS": F.col("participants_inserted") > 0, "NO_NEW_SAMPLES": F.col("samples_inserted") > 0}
    return failed_checks(counts, hard, keys=keys).unionByName(failed_checks(counts, soft, "WARNING", keys))


def manifest_shape(rows: DataFrame, scheme: str) -> DataFrame:
    """Exactly one global row, partitions of study and consent, 32 hex digits, no blanks, no repeats, URIs of one scheme."""
    part = F.col("partition")
    bad = {
        "BAD_PARTITION": (part == "global") | part.rlike("^phs\\d{6}\\.c\\d+$"),
        "BAD_MD5": F.col("md5").rlike("^[0-9a-f]{32}$"),
        "BLANK_CELL": (F.trim("version_id") != "") & (F.trim("last_updated") != ""),
        "BAD_URI": F.col("uri").startswith(scheme),
    }
    per = failed_checks(rows, bad, keys=["partition"])
    again = rows.groupBy("partition").agg(F.count("*").alias("n")).where("n > 1").select("partition", F.lit("ERROR").alias("severity"), F.lit("REPEATED_PARTITION").alias("code"))
    none = rows.agg(F.count_if(part == "global").alias("n")).where("n <> 1").select(F.lit("global").alias("partition"), F.lit("ERROR").alias("severity"), F.lit("NOT_ONE_GLOBAL_ROW").alias("code"))
    return union(per, again, none)


def merge_issues(folders: DataFrame, studies: DataFrame) -> DataFrame:
    """One issue for each suspect folder and each ready study without folders."""
    codes = {"NO_SOURCES": "FOLDER_WITHOUT_SOURCES", "ONLY_MERGED_COPIES": "ONLY_MERGED_COPIES", "REMOVED_NO_SOURCES": "MERGED_FILE_REMOVED", "CHANGED_DURING_RUN": "CHANGED_DURING_RUN"}
    named = F.try_element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), F.col("action"))
    code = F.coalesce(named, F.when((F.col("ignored") > 0) | (F.col("other_merged") > 0), "IGNORED_FILES"))
    rows = folders.withColumn("code", code).where("code is not null").select("study_id", "label", F.lit("WARNING").alias("severity"), "code")
    ids = studies.where("is_ready").select("study_id").distinct().join(folders.select("study_id"), "study_id", "left_anti")
    return rows.unionByName(ids.select("study_id", F.lit(None).cast("string").alias("label"), F.lit("WARNING").alias("severity"), F.lit("STUDY_WITHOUT_FOLDERS").alias("code")))


def merge_consistency(folders: DataFrame, actions: DataFrame) -> DataFrame:
    """One action for each folder, and the counts by action add up."""
    return failed_checks(
        folders.agg(F.count("*").alias("n"), F.count_distinct("study_id", "label").alias("d")).join(actions.agg(F.sum("folders").alias("s"))),
        {"SEVERAL_ACTIONS": F.col("n") == F.col("d"), "COUNTS_DIFFER": F.col("n") == F.coalesce("s", F.lit(0))})


def genomic_checks(groups: DataFrame, held: DataFrame, workload: int) -> DataFrame:
    """Held-back groups are errors; groups without samples too; nothing to do is a warning."""
    rows = held.select("consent_group", F.lit("ERROR").alias("severity"), F.lit("GROUP_HELD_BACK").alias("code"))
    empty = groups.where("samples = 0").select("consent_group", F.lit("ERROR").alias("severity"), F.lit("GROUP_WITHOUT_SAMPLES").alias("code"))
    out = rows.unionByName(empty)
    if workload == 0:
        out = out.unionByName(groups.sparkSession.createDataFrame([(None, "WARNING", "NOTHING_TO_INDEX")], "consent_group string, severity string, code string"))
    return out


def concept_checks(counts: DataFrame, missing: DataFrame, stale: DataFrame) -> DataFrame:
    """No rows at all is an error; unmapped patients, missing files and stale outputs are warnings. ``counts``: ``class, rows``."""
    written = counts.agg(F.sum(F.when(F.col("class") == "written", F.col("rows"))).alias("n"))
    none = failed_checks(written, {"NO_ROWS": F.col("n") > 0})
    odd = counts.where("class <> 'written' and rows > 0").select(F.lit("WARNING").alias("severity"), F.upper("class").alias("code"))
    return union(none, odd, *[df.limit(1).select(F.lit("WARNING").alias("severity"), F.lit(c).alias("code")) for df, c in ((missing, "FILES_MISSING"), (stale, "STALE_OUTPUTS"))])


def split_checks(counts: DataFrame) -> DataFrame:
    """``severity, code, percent`` from ``class, rows`` of a split: shares of all rows to one decimal."""
    total = counts.agg(F.sum("rows").alias("total"), F.sum(F.when(F.col("class") == "written", F.col("rows")).otherwise(0)).alias("written"))
    hard = failed_checks(total, {"NOTHING_READ": F.col("total") > 0, "NOTHING_WRITTEN": F.col("written") > 0}).withColumn("percent", F.lit(None).cast("double"))
    soft = counts.where("class <> 'written' and rows > 0").join(F.broadcast(total)).select(F.lit("WARNING").alias("severity"), F.upper("class").alias("code"), F.round(F.col("rows") * 100 / F.col("total"), 1).alias("percent"))
    return hard.unionByName(soft)


def migration_checks(results: DataFrame, mappings: DataFrame, ready: int) -> DataFrame:
    """Outcomes cover the ready studies and are of a known kind; successes have mapping rows, as many as they report, and
    no fewer than their subjects (column ``subjects``, if there is one); other studies have none, but for those to review."""
    rows = mappings.groupBy("study_id").agg(F.count("*").alias("n"))
    per = results.join(rows, "study_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    good, subjects = F.col("outcome") == "success", F.col("subjects") if "subjects" in results.columns else F.lit(0)
    bad = failed_checks(per, {
        "NO_MAPPING": ~good | (F.col("n") > 0), "MAPPING_ROWS_DIFFER": ~good | (F.col("n") == F.col("mapping_rows")), "SUBJECTS_NOT_COVERED": ~good | (F.col("n") >= subjects),
        "MAPPING_WITHOUT_RESULT": ~F.col("outcome").isin("skipped", "failed") | (F.col("n") == 0), "UNKNOWN_OUTCOME": F.col("outcome").isin("success", "needs_review", "skipped", "failed"),
    }, keys=["study_id"])
    total = results.agg(F.count("*").alias("n")).where(F.col("n") != ready)
    return bad.unionByName(total.select(F.lit(None).cast("string").alias("study_id"), F.lit("ERROR").alias("severity"), F.lit("OUTCOMES_NOT_READY_STUDIES").alias("code")))


def identity_checks(rows: DataFrame, crossed: DataFrame) -> DataFrame:
    none = failed_checks(rows.agg(F.count("*").alias("n")), {"NO_ROWS": F.col("n") > 0})
    return none.unionByName(crossed.limit(1).select(F.lit("WARNING").alias("severity"), F.lit("IDENTITY_IN_SEVERAL_CONSENTS").alias("code")))


def report_checks(reports: DataFrame, job: str | Column, run_id: str, keys: list[str] | None = None) -> DataFrame:
    """What any good report says."""
    none = F.col("inputValidation.counts.error") + F.col("outputValidation.counts.error") == 0
    return failed_checks(reports, {
        "WRONG_JOB": F.col("jobName") == job, "WRONG_RUN": F.col("runId") == run_id, "NOT_SUCCESSFUL": F.col("status") == "SUCCESS",
        "BAD_EXIT_CODE": F.col("exitCode").isin("SUCCESS", "SUCCESS_WITH_WARNINGS"), "ERRORS": none, "ERROR_MESSAGE": F.col("errorMessage").isNull(),
    }, keys=keys)


def input_guards(studies: DataFrame) -> DataFrame:
    """Bad study ids, and ids listed more than once."""
    bad = studies.where(~is_study_id(F.col("study_id"))).select("study_id", F.lit("ERROR").alias("severity"), F.lit("BAD_STUDY_ID").alias("code"))
    again = studies.groupBy("study_id").agg(F.count("*").alias("n")).where("n > 1").select("study_id", F.lit("WARNING").alias("severity"), F.lit("STUDY_LISTED_AGAIN").alias("code"))
    return bad.unionByName(again)


def global_checks(per_study: DataFrame) -> DataFrame:
    """Issues of a global run from ``study_id, rows, blank_abbreviations, issue``; no rows at all is an error."""
    rows = per_study.where("issue is not null").select("study_id", F.lit("WARNING").alias("severity"), F.col("issue").alias("code"))
    none = per_study.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).where("n = 0")
    return rows.unionByName(none.select(F.lit(None).cast("string").alias("study_id"), F.lit("ERROR").alias("severity"), F.lit("NO_ROWS").alias("code")))


def ready_gate(studies: DataFrame, error: bool) -> DataFrame:
    """No ready study: an error for jobs that need one, a warning for those that may have nothing to do."""
    none = studies.agg(F.count_if("is_ready").alias("n")).where("n = 0")
    return none.select(F.lit("ERROR" if error else "WARNING").alias("severity"), F.lit("NO_READY_STUDIES").alias("code"))


def folder_problems() -> Column:
    """``severity, code`` of a folder that can't be in the manifest, or null."""
    def p(severity: str, code: str) -> Column:
        return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))

    merged = F.col("merged_version").isNotNull()
    return (
        F.when((F.col("sources") == 0) & (F.col("other_merged") > 0), p("WARNING", "ONLY_MERGED_COPIES"))
        .when((F.col("sources") == 0) & merged, p("WARNING", "MERGED_WITHOUT_SOURCES"))
        .when(F.col("sources") == 0, p("WARNING", "NO_SOURCES"))
        .when(~merged, p("ERROR", "MERGED_MISSING"))
        .when(F.col("recorded_fingerprint").isNull(), p("ERROR", "MERGED_NOT_FINGERPRINTED"))
        .when(F.col("recorded_fingerprint") != F.col("fingerprint"), p("ERROR", "MERGED_STALE"))
        .when(F.trim(F.coalesce("recorded_md5", F.lit(""))) == "", p("ERROR", "MD5_MISSING"))
        .when(F.col("merged_size") == 0, p("WARNING", "MERGED_EMPTY"))
    )


def global_problems(global_file: DataFrame, groups: DataFrame) -> DataFrame:
    """What is wrong with the global file, and whether any consent group is left."""
    one = global_file.agg(F.count("*").alias("n"), F.max("version_id").alias("v"), F.max("size").alias("s")).join(groups.agg(F.count("*").alias("groups")))
    code = F.when(F.col("n") == 0, "GLOBAL_MISSING").when(F.coalesce(F.trim("v"), F.lit("")).isin("", "null"), "GLOBAL_NOT_VERSIONED").when(F.col("s") == 0, "GLOBAL_EMPTY")
    left = F.when(F.col("groups") == 0, "NO_CONSENT_GROUPS")
    return one.select(F.lit(None).cast("string").alias("study_id"), F.lit(None).cast("string").alias("label"), F.lit("ERROR").alias("severity"), F.explode(F.array_compact(F.array(code, left))).alias("code"))


def multi_issues(tally: DataFrame, has_dictionary: bool, readable: bool = True, has_variable: bool = True, samples_readable: bool = True) -> DataFrame:
    """A subject-and-sample load's tally (``code, count``) with what was found about its files."""
    found = [c for c, bad in (("NO_DATA_DICT", not has_dictionary), ("DATA_DICT_UNREADABLE", has_dictionary and not readable), ("CONSENT_VARIABLE_NOT_IN_DATA_DICT", has_dictionary and readable and not has_variable), ("SAMPLE_MULTI_UNREADABLE", not samples_readable)) if bad]
    rows = tally.where("count > 0").select(F.when(F.col("code") == "SUBJECTS_NOT_CONSENTED", "INFO").otherwise("WARNING").alias("severity"), "code", "count")
    if not found:
        return rows
    return rows.unionByName(tally.sparkSession.createDataFrame([("WARNING", c, 1) for c in found], "severity string, code string, count long"))
