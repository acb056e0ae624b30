"""A migration of all studies at once, from their raw files to each study's outcome, with fallback and isolation.

A study's mapping must be whole; it is then loaded from its subject-sample table, or where that is unusable from its
subject and sample tables. Failures are rows: a bad file turns only its own study away, and nothing of a study that
is turned away is loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import studies as S
from cohortflow.operators import aggregates as A
from cohortflow.operators import dedup as E
from cohortflow.operators import identity as I
from cohortflow.operators import joins as J
from cohortflow.operators import reshape as R
from cohortflow.plans import gates as V
from cohortflow.sources import files as FI
from cohortflow.sources import own_headers as H
from cohortflow.sources.scratch import written

#: Issues that name what is wrong with a file, by kind of file.
KINDS = ("sstr", "subject", "sample", "dictionary", "mapping")
PROBLEMS = "study_id string, kind string, problem string"


def chosen_files(studies: DataFrame, files: DataFrame) -> DataFrame:
    """``studies`` with each one's ``sstr_file, subject_file, sample_file, dictionary`` and how many candidates there were (``sstr_candidates`` and so on).

    ``files``: ``study_id, name`` of raw files. The subject-sample table of the plain name comes first, then by name; of the others
    the newest by the numbers in its name, a dictionary that belongs to the subject table before others.
    """
    kinds = files.withColumn("kind", S.raw_file_class(F.col("name"), F.col("study_id"))).where("kind is not null")
    key = ["study_id"]

    def named(df: DataFrame, kind: str, column: str) -> DataFrame:
        return df.select("study_id", F.col("name").alias(column), F.col("candidates").alias(f"{kind}_candidates"))

    table = named(E.preferred(kinds.where("kind in ('sstr', 'sstr_copy')"), key, F.col("kind") == "sstr_copy", "name"), "sstr", "sstr_file")
    subject, sample = (named(E.newest(kinds.where(F.col("kind") == k).select("study_id", "name"), key, "name"), k, f"{k}_file") for k in ("subject", "sample"))
    own = kinds.where("kind = 'dictionary'").select("study_id", "name").join(subject.select("study_id", "subject_file"), key, "left").withColumn("subject_file", F.coalesce("subject_file", F.lit("")))
    paired = named(E.paired_dictionaries(own, key, "name", "subject_file"), "dictionary", "dictionary")
    out = studies
    for df in (table, subject, sample, paired):
        out = out.join(df, key, "left")
    return out


def judged(chosen: DataFrame, mapping: DataFrame, problems: DataFrame) -> DataFrame:
    """``chosen`` with each kind's problem (``sstr_problem`` and so on), the ``source`` that a study is loaded from, null for none, and ``refused``, the code of why."""
    per = problems.groupBy("study_id").agg(*[F.max(F.when(F.col("kind") == k, F.col("problem"))).alias(f"{k}_problem") for k in KINDS])
    rows = chosen.join(per, "study_id", "left").join(mapping.select("study_id").distinct().withColumn("_mapped", F.lit(True)), "study_id", "left")
    rows = rows.withColumn("mapping_problem", F.coalesce("mapping_problem", F.when(F.col("_mapped").isNull(), "EMPTY"))).drop("_mapped")
    table, subject = (F.col(f"{k}_file").isNotNull() for k in ("sstr", "subject"))
    refused = (
        F.when(F.col("mapping_problem").isNotNull(), "PATIENT_MAPPING_UNUSABLE").when(table & F.col("sstr_problem").isNull(), F.lit(None))
        .when(~table & ~subject, "NO_PARTICIPANT_FILES").when(~subject, "NO_PARTICIPANT_SOURCE").when(F.col("subject_problem").isNotNull(), "MULTI_LOAD_FAILED")
    )
    source = F.when(refused.isNotNull(), F.lit(None)).when(table & F.col("sstr_problem").isNull(), "SSTR").otherwise("MULTI")
    return rows.withColumns({"source": source, "refused": refused})


def migrate_studies(
    studies: DataFrame, files: DataFrame, sstr: DataFrame, subjects: DataFrame, tubes: DataFrame, decodings: DataFrame, mapping: DataFrame,
    participants: DataFrame, consents: DataFrame, samples: DataFrame, prior: DataFrame, folder: str, problems: DataFrame | None = None, chosen: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """A whole migration: files chosen, studies loaded, patient mappings resolved, every study's outcome told.

    Ready studies count once. Those that ``prior`` has for the same ``folder`` are not done again. Of the others each is
    loaded from its subject-sample table, else, if that has a problem or is not there, from its subject table with the sample table.
    A study without a whole mapping, with an unusable table and no subject table, or with an unusable subject table fails; one
    without either table is skipped; one whose mapping resolves to nothing needs a review. None of these stops another.

    ``files``: ``study_id, name``; ``problems``: ``study_id, kind, problem`` of files that can't be used (``KINDS``); the other inputs are
    as their readers give them, with ``study_id``. Returns ``participants, consents, samples, mappings, outcomes, unresolved, issues``
    (``study_id, severity, code, count, examples``) and ``checks``, what the gates of loads and outcomes say.
    """
    spark = studies.sparkSession
    problems = problems if problems is not None else spark.createDataFrame([], PROBLEMS)
    listed = J.ready(studies).select("ord", "study_id", "abv").dropDuplicates(["study_id"])
    todo, reused = J.to_resume(listed, prior, folder)
    chosen = written(judged(chosen if chosen is not None else chosen_files(todo, files), mapping, problems), "chosen")

    def of(df: DataFrame, source: str) -> DataFrame:
        return df.join(chosen.where(F.col("source") == source).select("study_id"), "study_id", "left_semi")

    by_table, by_subject = of(sstr, "SSTR"), of(subjects, "MULTI")
    people, own, held, counts = I.load_sstr(participants, consents, samples, by_table)
    people = written(people, "people")
    good_tubes = of(tubes, "MULTI").join(chosen.where("sample_problem is not null").select("study_id"), "study_id", "left_anti")
    people, own, held, found = I.load_multi(people, own, held, by_subject, good_tubes, decodings.join(chosen.where("source = 'MULTI'").select("study_id"), "study_id", "left_semi"))
    people = written(people, "people")
    yes, no = E.first_usable_consent(by_subject, ["study_id", "dbgap_id"], "code", "ord", "subject_id")
    ids = R.union(by_table.select("study_id", F.col("dbgap_subject_id").alias("dbgap_id"), "subject_id"), yes.select("study_id", "dbgap_id", "subject_id")).distinct()
    # A mapping may name either id of a subject, so those without consent are known by both.
    none = R.union(no.select("study_id", F.col("dbgap_id").alias("subject_id")), no.select("study_id", "subject_id").where("subject_id <> ''"))
    rows = J.resolve_patients(mapping.join(chosen.where("source is not null").select("study_id"), "study_id", "left_semi"), ids.select("study_id", "dbgap_id"), ids.where("subject_id <> ''"), none, people)
    rows = written(rows, "resolved")
    per = rows.groupBy("study_id").agg(F.count_if(F.col("resolution") == "mapped").alias("mapping_rows"), F.count_if(F.col("resolution") != "mapped").alias("unresolved_rows"))
    n = F.coalesce("mapping_rows", F.lit(0).cast("long"))
    out = chosen.join(per, "study_id", "left")
    codes = F.array_compact(F.array("refused", F.when(F.col("source").isNotNull() & (n == 0), "NEEDS_DATA_REVIEW")))
    out = out.withColumn("codes", codes)
    good = F.size("codes") == 0
    out = out.select("ord", "study_id", "abv", "source", n.alias("mapping_rows"), F.coalesce("unresolved_rows", F.lit(0).cast("long")).alias("unresolved_rows"),
                     S.study_outcome(good, F.col("codes")).alias("outcome"), S.outcome_class(good, F.col("source"), F.col("sstr_file"), F.col("codes")).alias("class"))
    again = reused.join(listed, "study_id").select("ord", "study_id", "abv", F.lit(None).cast("string").alias("source"), F.col("mapping_rows").cast("long").alias("mapping_rows"), F.lit(0).cast("long").alias("unresolved_rows"), F.lit("success").alias("outcome"), F.lit("reused").alias("class"))
    outcomes = written(out.unionByName(again), "outcomes")
    mappings = rows.where("resolution = 'mapped'").select("study_id", "old_id", "person_id", "dbgap_id")
    done = outcomes.where("class <> 'reused'")
    checks = V.load_checks(counts, ["study_id"]).unionByName(V.migration_checks(done, mappings, chosen.count()))
    return {
        "participants": people, "consents": own, "samples": held, "mappings": mappings, "outcomes": outcomes, "unresolved": A.unresolved(rows),
        "issues": migration_issues(chosen, rows, found), "checks": checks,
    }


def migration_issues(chosen: DataFrame, resolved: DataFrame, found: DataFrame) -> DataFrame:
    """``study_id, severity, code, count, examples`` of a migration: what a study's files, its load and its mapping gave cause to say."""
    tried = chosen.where("mapping_problem is null")
    multi = tried.where("subject_file is not null and (sstr_file is null or sstr_problem is not null)")

    def told(df: DataFrame, severity: str, code: Column | str, example: Column | None = None, count: Column | None = None) -> DataFrame:
        shown = F.array_compact(F.array(example)) if example is not None else F.array().cast("array<string>")
        return df.select("study_id", F.lit(severity).alias("severity"), (F.lit(code) if isinstance(code, str) else code).alias("code"), (count if count is not None else F.lit(1)).cast("long").alias("count"), shown.alias("examples"))

    def several(df: DataFrame, kind: str, column: str) -> DataFrame:
        return told(df.where(f"{kind}_candidates > 1"), "WARNING", f"MULTIPLE_{'DATA_DICT' if kind == 'dictionary' else 'SSTR' if kind == 'sstr' else kind.upper() + '_MULTI'}_CANDIDATES", F.col(column), F.col(f"{kind}_candidates"))

    tally = found.where("count > 0").select("study_id", F.when(F.col("code").isin("SUBJECTS_NOT_CONSENTED", "SAMPLES_OF_UNCONSENTED_SUBJECTS"), "INFO").otherwise("WARNING").alias("severity"), "code", "count", "examples")
    used = multi.where("source = 'MULTI'")
    lost = A.unresolved(resolved)
    not_consented = lost.where("resolution = 'not_consented'").select("study_id", F.lit("INFO").alias("severity"), F.lit("PATIENT_MAPPING_NOT_CONSENTED").alias("code"), "count", "examples")
    gone = A.first_examples(resolved.where("resolution in ('not_in_file', 'no_participant')"), ["study_id"], "old_id", "old_id", 10)
    gone = gone.select("study_id", F.lit("WARNING").alias("severity"), F.lit("PATIENT_MAPPING_UNRESOLVED").alias("code"), "count", "examples")
    return R.union(
        told(chosen.where("mapping_problem is not null"), "ERROR", "PATIENT_MAPPING_UNUSABLE", F.col("mapping_problem")),
        several(tried, "sstr", "sstr_file"), told(tried.where("sstr_file is not null and sstr_problem is not null"), "WARNING", "SSTR_MALFORMED", F.col("sstr_problem")),
        told(tried.where("refused = 'NO_PARTICIPANT_FILES'"), "WARNING", "NO_PARTICIPANT_FILES"), told(tried.where("refused = 'NO_PARTICIPANT_SOURCE'"), "ERROR", "NO_PARTICIPANT_SOURCE", F.col("sstr_file")),
        several(multi, "subject", "subject_file"), several(multi, "sample", "sample_file"), several(multi, "dictionary", "dictionary"),
        told(multi.where("sample_file is null"), "INFO", "NO_SAMPLE_MULTI"), told(multi.where("refused = 'MULTI_LOAD_FAILED'"), "ERROR", "MULTI_LOAD_FAILED", F.col("subject_problem")),
        told(used.where("sample_problem is not null"), "WARNING", "SAMPLE_MULTI_UNREADABLE", F.col("sample_problem")), told(used.where("dictionary is null"), "WARNING", "NO_DATA_DICT"),
        told(used.where("dictionary is not null and dictionary_problem is not null"), "WARNING", F.col("dictionary_problem"), F.col("dictionary")), tally, not_consented, gone)


def migrate_folders(spark: SparkSession, base: str, studies: DataFrame, participants: DataFrame, consents: DataFrame, samples: DataFrame, prior: DataFrame, folder: str) -> dict[str, DataFrame]:
    """``migrate_studies`` from the files below ``base``: ``study/rawData/…`` and ``study/legacy/data/ABV_PatientMapping.v2.csv``.

    Names are listed first; only files that a study needs are then read: its subject table only if it has no usable subject-sample
    table, a sample table and a dictionary only with that. Each kind is read by one scan of all studies' files and written as a
    table, so its lines are not parsed again for each result. The chosen paths, a few for each study, go through the driver.
    """
    raw = FI.listing(spark, f"{base}/*/rawData/*").select(F.regexp_extract("path", "([^/]+)/rawData/[^/]+$", 1).alias("study_id"), F.element_at(F.split("path", "/"), -1).alias("name"))
    listed = J.ready(studies).select("ord", "study_id", "abv").dropDuplicates(["study_id"])
    todo, _ = J.to_resume(listed, prior, folder)
    chosen = written(chosen_files(todo, raw), "named")

    def owned(paths: list[str], table: tuple[DataFrame, DataFrame], kind: str) -> tuple[DataFrame, DataFrame]:
        """The rows with their study, written once since every step of a load reads them, and the problems of files, those without any line among them."""
        rows, verdict = table
        study = H.study_of()
        asked = spark.createDataFrame([(p.split("/")[-3 if kind != "mapping" else -4],) for p in paths], "study_id string")
        seen = verdict.select(study.alias("study_id"), F.coalesce("problem", F.lit("")).alias("problem"))
        found = asked.join(seen, "study_id", "left").select("study_id", F.lit(kind).alias("kind"), F.coalesce("problem", F.lit("NO_LINES")).alias("problem")).where("problem <> ''")
        return written(rows.withColumn("study_id", study).drop("file"), f"{kind}-rows"), written(found, "problems")

    def paths(of: DataFrame, column: str) -> list[str]:
        return [f"{base}/{r['study_id']}/rawData/{r[column]}" for r in of.where(F.col(column).isNotNull()).select("study_id", column).collect()]

    there = FI.listing(spark, f"{base}/*/legacy/data/*_PatientMapping.v2.csv").select(F.regexp_extract("path", "([^/]+)/legacy/data/[^/]+$", 1).alias("study_id"), F.element_at(F.split("path", "/"), -1).alias("name"))
    mapped = chosen.join(there, "study_id").where(F.col("name") == F.concat(F.upper("abv"), F.lit("_PatientMapping.v2.csv"))).select("study_id", "name").collect()
    at = [f"{base}/{r['study_id']}/legacy/data/{r['name']}" for r in mapped]
    mapping, bad_mapping = owned(at, H.patient_mapping_files(spark, at), "mapping")
    whole = chosen.join(bad_mapping.select("study_id"), "study_id", "left_anti").join(mapping.select("study_id").distinct(), "study_id", "left_semi")
    at = paths(whole, "sstr_file")
    sstr, bad_sstr = owned(at, H.sstr_files(spark, at), "sstr")
    fallen = written(whole.join(bad_sstr.select("study_id"), "study_id", "left_semi").unionByName(whole.where("sstr_file is null")), "fallen")
    at = paths(fallen, "subject_file")
    subjects, bad_subject = owned(at, H.subject_files(spark, at), "subject")
    names = H.consent_columns(spark, at)
    used = fallen.where("subject_file is not null")
    at = paths(used, "sample_file")
    tubes, bad_sample = owned(at, H.sample_files(spark, at), "sample")
    at = paths(used, "dictionary")
    labels, bad_dictionary = owned(at, H.decoding_files(spark, at, names), "dictionary")
    problems = R.union(bad_mapping, bad_sstr, bad_subject, bad_sample, bad_dictionary)
    return migrate_studies(studies, raw, sstr, subjects, tubes, labels, mapping, participants, consents, samples, prior, folder, problems, chosen)
