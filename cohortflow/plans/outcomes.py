"""Outcome reports: what became of every study in a run, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.functions import studies as S
from cohortflow.functions.cells import one_line
from cohortflow.operators.aggregates import worst
from cohortflow.operators.reshape import union

# The stages that publish a run's outputs, and a migration's statuses, most severe first.
PUBLISHING = ("generate-global-all-concepts", "merge-allconcepts", "generate-allconcepts-manifest")
MIGRATION_ORDER = ["NOT_MIGRATED", "RERUN_NEEDED", "NOT_REACHED", "MIGRATED_WITH_GAPS", "MIGRATED"]
ITEM = "study_id string, stage string, severity string, code string, detail string"


def run_review(plan: DataFrame, outcomes: DataFrame, issues: DataFrame, stages: DataFrame, preflight: bool = False) -> DataFrame:
    """Review items ``study_id, stage, severity, code, detail`` of a run.

    ``plan``: ``study_id, abv, plan, reason``; ``outcomes``: ``study_id, stage, result, reason``, one row for each
    per-study stage that ran; ``issues``: ``study_id, stage, severity, code, message``; ``stages``: ``stage, ran,
    status, message`` of run-wide stages.
    """
    result = F.col("result")
    own = outcomes.select(
        "study_id", "stage", F.lit("outcome").alias("kind"), F.when(result == "NOT_RUN", "NOT_REACHED").when(result == "UNSTABLE", "WARNING").when(result != "SUCCESS", "FAILED").alias("severity"),
        F.when(result == "NOT_RUN", "NOT_STARTED").otherwise(result).alias("code"),
        F.when(result == "NOT_RUN", "the stage stopped first").when(result == "UNSTABLE", "completed with warnings").otherwise(F.coalesce(F.nullif("reason", F.lit("")), F.concat("stage", F.lit(" ended "), "result"))).alias("detail"),
    )
    found = issues.where("severity in ('ERROR', 'WARNING')").select("study_id", "stage", F.lit("issue").alias("kind"), F.when(F.col("severity") == "ERROR", "FAILED").otherwise("WARNING").alias("severity"), "code", F.col("message").alias("detail"))
    kind = F.col("kind")
    told = own.where("severity is not null").unionByName(found).join(plan.select("study_id", "plan"), "study_id")
    told = told.where(F.when(kind == "outcome", F.col("plan") == "load").otherwise(F.col("plan") != "excluded")).drop("plan")
    if not preflight:
        pairs = plan.where("plan <> 'excluded'").select("study_id", F.explode(F.array(*map(F.lit, PUBLISHING))).alias("stage"))
        pairs = pairs.join(F.broadcast(stages), "stage", "left").withColumn("ran", F.coalesce("ran", F.lit(False))).where("not ran or status <> 'SUCCESS'")
        late = pairs.select(
            "study_id", "stage", F.lit("stage").alias("kind"), F.when(F.col("ran"), "FAILED").otherwise("NOT_REACHED").alias("severity"), F.when(F.col("ran"), "STAGE_FAILED").otherwise("STAGE_NOT_RUN").alias("code"),
            F.when(F.col("ran"), F.coalesce("message", F.lit("see its report"))).otherwise("outputs not published").alias("detail"))
        told = told.unionByName(late)
    # What a stage's own issues tell already is not told again by its outcome, nor a failure that is named by its stage.
    mine = Window.partitionBy("study_id", "stage")
    warned = F.max((kind == "issue") & (F.col("severity") == "WARNING")).over(mine)
    named = F.max((kind != "stage") & (F.col("severity") == "FAILED")).over(mine)
    told = told.withColumns({"_warned": warned, "_named": named}).where(~((F.col("code") == "UNSTABLE") & (kind == "outcome") & F.col("_warned")) & ~((F.col("code") == "STAGE_FAILED") & (kind == "stage") & F.col("_named")))
    excluded = plan.where("plan = 'excluded'").select("study_id", F.lit("resolve-studies").alias("stage"), F.lit("EXCLUDED").alias("severity"), F.lit("MISSING_INPUTS").alias("code"), F.col("reason").alias("detail"))
    return union(told.select(*excluded.columns), excluded).withColumn("detail", one_line(F.col("detail")))


def run_outcomes(plan: DataFrame, review: DataFrame) -> DataFrame:
    """``study_id, abv, plan, status, review_items, reasons`` of every planned study."""
    per = review.groupBy("study_id").agg(
        F.count("*").alias("review_items"), *[F.max(F.col("severity") == s).alias(s) for s in ("FAILED", "NOT_REACHED", "WARNING")],
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "stage", "code", "detail"))), "; ").alias("reasons"))
    rows = plan.join(per, "study_id", "left")
    status = (
        F.when(F.col("FAILED"), "FAILED").when(F.col("plan") == "excluded", "EXCLUDED").when(F.col("NOT_REACHED"), "NOT_REACHED")
        .when(F.col("WARNING"), "COMPLETE_WITH_WARNINGS").when(F.col("plan") == "already_processed", "ALREADY_PROCESSED").otherwise("COMPLETE")
    )
    return rows.select("study_id", "abv", "plan", status.alias("status"), F.coalesce("review_items", F.lit(0).cast("long")).alias("review_items"), F.coalesce("reasons", F.lit("")).alias("reasons"))


def study_results(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Every planned study's result, ``NOT_RUN`` where there is none."""
    return plan.select("study_id").join(outcomes.select("study_id", "result"), "study_id", "left").withColumn("result", F.coalesce("result", F.lit("NOT_RUN")))


def consent_counts(loaded: DataFrame, split: DataFrame, manifest: DataFrame) -> DataFrame:
    """``study_id, consent_code, participants_loaded, participants_split, split_rows, in_manifest`` of every consent group that any stage met."""
    keys = ["study_id", "consent_code"]
    rows = loaded.select(*keys, "participants_loaded").join(split.select(*keys, "participants_split", "split_rows"), keys, "full_outer")
    there = manifest.select(F.col("partition").alias("_p")).withColumn("in_manifest", F.lit(True))
    return rows.join(there, S.partition_name(F.col("study_id"), F.col("consent_code")) == F.col("_p"), "left").select(*keys, "participants_loaded", "participants_split", "split_rows", F.coalesce("in_manifest", F.lit(False)).alias("in_manifest"))


def migration_review(participants: DataFrame, split: DataFrame, issues: DataFrame) -> DataFrame:
    """``study_id, stage, category, code`` of a migration.

    ``participants``: ``study_id, outcome, unresolved_rows``; ``split``: ``study_id, outcome, stage, exit_label,
    unmapped, no_consent, malformed``; ``issues``: ``study_id, stage, severity, code`` of later stages.
    """
    def item(category: str, code: str) -> Column:
        return F.struct(F.lit(category).alias("category"), F.lit(code).alias("code"))

    kind = (
        F.when(F.col("outcome") == "skipped", item("MISSING_DATA", "NO_PARTICIPANT_FILES"))
        .when(F.col("outcome") == "needs_review", item("DATA_MISMATCH", "NEEDS_DATA_REVIEW"))
        .when(F.col("outcome") == "failed", item("MALFORMED_DATA", "STUDY_FAILED"))
        .when(F.col("unresolved_rows") > 0, item("PARTIAL_DATA", "SUBJECTS_NOT_MIGRATED"))
    )
    first = participants.select("study_id", F.lit("participants-migration").alias("stage"), kind.alias("k")).where("k is not null").select("study_id", "stage", "k.*")
    data = S.is_data_failure(F.col("stage"), F.col("exit_label"))
    at_split = F.lit("split-allconcepts").alias("stage")
    unusable = split.where((F.col("outcome") == "FAILED") & data).select("study_id", at_split, F.lit("MALFORMED_DATA").alias("category"), F.when(F.col("stage") == "preflight", "SPLIT_INPUT_UNUSABLE").otherwise("SPLIT_DATA_REJECTED").alias("code"))
    broken = split.where(((F.col("outcome") == "FAILED") & ~data) | (F.col("outcome") == "NOT_STARTED")).select("study_id", at_split, F.lit("PIPELINE_FAILURE").alias("category"), F.when(F.col("outcome") == "NOT_STARTED", "SPLIT_NOT_STARTED").otherwise(F.concat(F.lit("SPLIT_"), F.coalesce("exit_label", F.lit("FAILED")))).alias("code"))
    fine = split.where("outcome not in ('FAILED', 'NOT_STARTED')")
    gaps = union(*[fine.where(f"{c} > 0").select("study_id", at_split, F.lit("PARTIAL_DATA").alias("category"), F.lit(code).alias("code")) for c, code in (("unmapped", "SPLIT_UNMAPPED_IDS"), ("no_consent", "SPLIT_ROWS_WITHOUT_CONSENT"), ("malformed", "SPLIT_MALFORMED_ROWS"))])
    known = participants.select("study_id").union(split.select("study_id")).distinct()
    later = issues.where("severity in ('ERROR', 'WARNING')").join(known, "study_id").select("study_id", "stage", F.when(F.col("severity") == "ERROR", "PIPELINE_FAILURE").otherwise("OUTPUT_WARNING").alias("category"), "code")
    return union(first, unusable, broken, gaps, later)


def migration_outcomes(participants: DataFrame, split: DataFrame, review: DataFrame) -> DataFrame:
    """``study_id, status, review_items``: the worst that any item stands for; NOT_REACHED where a stage has no result."""
    known = participants.select("study_id", "outcome").join(split.select("study_id", F.lit(True).alias("_split")), "study_id", "full_outer")
    unreached = known.where("outcome is null or (outcome = 'success' and _split is null)").select("study_id", F.lit("NOT_REACHED").alias("status"))
    statuses = union(review.select("study_id", S.review_status(F.col("category")).alias("status")), unreached, known.select("study_id", F.lit("MIGRATED").alias("status")))
    items = review.groupBy("study_id").agg(F.count("*").alias("review_items"))
    return worst(statuses, ["study_id"], "status", MIGRATION_ORDER).join(items, "study_id", "left").withColumn("review_items", F.coalesce("review_items", F.lit(0).cast("long")))


def consent_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("consent_groups"), F.count_if("in_manifest").alias("published"), F.coalesce(F.sum("participants_loaded"), F.lit(0).cast("long")).alias("participants_loaded"), F.coalesce(F.sum("participants_split"), F.lit(0).cast("long")).alias("participants_split"))


def split_results(runs: DataFrame) -> DataFrame:
    """``study_id, outcome, stage, exit_label`` from ``study_id, stage, exit_code, validation_code``: a stage named is where it stopped."""
    stopped = F.coalesce(F.col("stage"), F.lit("")) != ""
    ok, rc = F.col("exit_code") == 0, F.col("validation_code")
    outcome = (
        F.when(stopped, F.when(F.col("stage") == "not-started", "NOT_STARTED").otherwise("FAILED"))
        .when(ok & (rc == 0), "SUCCESS").when(ok & (rc == 10), "SUCCESS_WITH_WARNINGS").otherwise("FAILED")
    )
    stage = F.when(stopped, F.col("stage")).when(outcome == "FAILED", F.when(ok, "validation").otherwise("run"))
    return runs.select("study_id", outcome.alias("outcome"), stage.alias("stage"), F.when(F.col("exit_code").isNotNull(), S.exit_name(F.col("exit_code"))).alias("exit_label"))


def review_totals(review: DataFrame) -> DataFrame:
    """``category, review_items, status`` of a migration's review."""
    return review.groupBy("category").agg(F.count("*").alias("review_items")).withColumn("status", S.review_status(F.col("category")))


def split_summary(results: DataFrame, metrics: list[str], by: list[str] | None = None) -> DataFrame:
    """One row, or one for each of ``by`` (the lane): studies by outcome, those left out for their data, those to run again, and sums of the row counts."""
    data = S.is_data_failure(F.col("stage"), F.col("exit_label"))
    failed = F.col("outcome") == "FAILED"
    return results.groupBy(*by or []).agg(
        F.count("*").alias("studies"), F.count_if(F.col("outcome") == "SUCCESS").alias("succeeded"), F.count_if(F.col("outcome") == "SUCCESS_WITH_WARNINGS").alias("succeeded_with_warnings"),
        F.count_if(failed).alias("failed"), F.count_if(F.col("outcome") == "NOT_STARTED").alias("not_started"), F.count_if(failed & data).alias("excluded"),
        F.count_if((failed & ~data) | (F.col("outcome") == "NOT_STARTED")).alias("to_run_again"), *[F.coalesce(F.sum(m), F.lit(0).cast("long")).alias(m) for m in metrics],
    )


def failures_by(results: DataFrame, column: str) -> DataFrame:
    return results.where("outcome = 'FAILED'").groupBy(F.coalesce(column, F.lit("unknown")).alias(column)).agg(F.count("*").alias("failed"))
