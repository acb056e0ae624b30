"""The jobs a user runs, each a composition of operators over frames: what to write, and what went wrong.

Every job takes all studies at once; a study's verdict is a grouped result, not control flow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import studies as S
from cohortflow.functions.cells import has_separator, is_null_word, is_number, is_patient_cell, trimmed
from cohortflow.operators import aggregates as A
from cohortflow.operators import joins as J
from cohortflow.operators import reshape as R
from cohortflow.sources.files import file_inventory, listing
from cohortflow.sources.scratch import written
from cohortflow.sources.streams import merge_bytes, remove_files


def study_concepts(wide: DataFrame, mapping: DataFrame, patient: str, participants: DataFrame, consents: DataFrame, study: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Concept rows (``study_id, consent_code, person_id, path, numeric, text``) of a file's wide rows, and counts of what was dropped.

    Two passes: the first profiles the columns, so that fields without values are left out of the second's plan
    and declared types give way to observed ones. ``study``: keep only its consents.
    """
    fields = [r["field"] for r in mapping.select("field").collect()]
    used = mapping.where(F.col("field").isin(*[c for c in wide.columns]))
    profile = A.wide_profile(wide.where(is_patient_cell(F.col(patient))), [f for f in fields if f in wide.columns])
    types = [r.asDict() for r in A.profiled_mapping(used, profile).select("field", "path", "type").collect()]
    own = consents if study is None else J.of_study(consents, study)
    # Rows meet their patient while they are wide, so that one row is shuffled for all its concepts, and once.
    kept = wide.where(is_patient_cell(F.col(patient))).withColumn("_person", trimmed(F.col(patient)))
    known = J.with_consents(kept.select(*{patient: 0, **dict.fromkeys(t["field"] for t in types)}, "_person"), participants, own, "_person")
    rows = R.to_concepts(known, types, patient, ["study_id", "consent_code", "person_id"])
    good = rows.where("consent_code is not null")
    counts = rows.groupBy(F.when(F.col("person_id").isNull(), "unmapped").when(F.col("consent_code").isNull(), "no_consent").otherwise("written").alias("class"))
    counts = counts.agg(F.count("*").alias("rows"), F.count_distinct("patient").alias("patients"))
    return good.select("study_id", "consent_code", "person_id", "path", "numeric", "text"), counts


def file_counts(wide: DataFrame, mapping: list[dict], patient: str, file: str, participants: DataFrame) -> DataFrame:
    """Per data file: rows, rows whose first cell names no patient, cells emitted, cells dropped, and patients not known."""
    fields = [m["field"] for m in mapping if m["field"] in wide.columns]
    rows = wide.withColumn("_ok", is_patient_cell(F.col(patient)))
    cells = F.lit(0)
    for m in (m for m in mapping if m["field"] in fields):
        v = trimmed(F.col(m["field"]).cast("string"))
        there = F.coalesce((v != "") & ~is_null_word(v), F.lit(False))
        cells = cells + (there & is_number(v) if m["type"] == "NUMERIC" else there).cast("int")
    rows = J.to_people(rows.withColumn("_cells", F.when(F.col("_ok"), cells).otherwise(0)), participants, patient)
    known = F.col("person_id").isNotNull()
    return rows.groupBy(file).agg(
        F.count("*").alias("rows"), F.count_if(~F.col("_ok")).alias("not_patients"), F.sum(F.when(known, F.col("_cells")).otherwise(0)).alias("emitted"),
        F.sum(F.when(F.col("_ok") & ~known, F.lit(len(fields))).otherwise(0)).cast("long").alias("skipped"), F.count_distinct(F.when(F.col("_ok") & ~known, trimmed(F.col(patient)))).alias("unmapped_ids"),
    )


def global_concepts(studies: DataFrame, participants: DataFrame, consents: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all ready studies, and per study ``rows, blank_abbreviations, issue``."""
    rows = R.global_concepts(studies, participants, consents, samples)
    ids = J.ready(studies).select("study_id").distinct()
    blank = consents.groupBy("study_id").agg(F.count_if(F.trim(F.coalesce("consent_abbreviation", F.lit(""))) == "").alias("blank_abbreviations"))
    per = ids.join(rows.groupBy("study_id").agg(F.count("*").alias("rows")), "study_id", "left").join(blank, "study_id", "left")
    issue = F.when(F.col("rows").isNull(), "STUDY_WITHOUT_CONSENTS").when(F.col("blank_abbreviations") > 0, "BLANK_ABBREVIATION")
    return rows, per.select("study_id", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.coalesce("blank_abbreviations", F.lit(0).cast("long")).alias("blank_abbreviations"), issue.alias("issue"))


def genomic_groups(studies: DataFrame, consents: DataFrame, samples: DataFrame, processed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sequenced samples of good consent groups (``consent_group, study_id, consent_code, abv, person_id, source_sample_id, sample_source``), and the groups held back.

    Held back: ``consent_group, study_id, reasons, bad_samples, examples``. A bad group doesn't stop the others.
    """
    chosen = J.ready(studies, processed).where(S.is_genomic(F.col("data_type"))).select("study_id", "abv").distinct()
    own = J.study_samples(samples, consents).join(consents.select("study_id", "person_id", "consent_code"), ["study_id", "person_id"]).join(chosen, "study_id")
    rows = own.where(S.consented(F.col("consent_code")) & S.sequenced(F.col("source_sample_id"))).withColumn("consent_group", S.partition_name(F.col("study_id"), F.col("consent_code")))
    rows = rows.withColumns({"_bad_id": has_separator(F.col("source_sample_id"), ",\t\n\r"), "_bad_abv": has_separator(F.col("abv"), ",\n\r")})
    groups = rows.groupBy("consent_group", "study_id").agg(F.count_if("_bad_id").alias("bad_samples"), F.max("_bad_abv").alias("_bad_abv"))
    held = groups.where("bad_samples > 0 or _bad_abv")
    shown = A.first_examples(rows.where("_bad_id"), ["consent_group"], "source_sample_id", "source_sample_id", 10).drop("count")
    reasons = F.array_compact(F.array(F.when(F.col("_bad_abv"), "BAD_STUDY_ABV"), F.when(F.col("bad_samples") > 0, "ID_COUNT_MISMATCH")))
    held = held.join(shown, "consent_group", "left").select("consent_group", "study_id", reasons.alias("reasons"), "bad_samples", "examples")
    return rows.join(held.select("consent_group"), "consent_group", "left_anti").drop("_bad_id", "_bad_abv"), held


def genomic_indexes(rows: DataFrame) -> DataFrame:
    """The 23 index rows of each group: one list of samples and one of people, in the same order."""
    lists = A.ordered_lists(rows, ["consent_group"], ["source_sample_id", "person_id", "sample_source"], {"sample_ids": "source_sample_id", "patient_ids": "person_id"})
    return R.chromosomes(lists, "consent_group")


def identity_map(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct ``identity, study_id, consent_code``, and issues per study: ids in several consents, blank cells, repeats within a ``file`` (or, without that column, a consent group)."""
    file = [c for c in ("file",) if c in raw.columns]
    each = R.identity_rows(raw.select("study_id", "consent_code", *file, "raw"))
    rows = each.select("identity", "study_id", "consent_code").distinct()
    crossed = A.cross_consent(rows).groupBy("study_id").agg(F.count("*").alias("count")).select("study_id", F.lit("IDENTITY_IN_SEVERAL_CONSENTS").alias("code"), "count")
    blank = raw.groupBy("study_id").agg(F.count_if(F.size(S.identities(F.col("raw"))) == 0).alias("count")).where("count > 0").select("study_id", F.lit("BLANK_IDENTITY").alias("code"), "count")
    repeats = A.duplicates_in_group(each, ["study_id", "consent_code", *file], "identity").groupBy("study_id").agg(F.sum("duplicates").alias("count")).where("count > 0").select("study_id", F.lit("DUPLICATE_IDENTITY").alias("code"), "count")
    return rows, R.union(crossed, blank, repeats)


def split_concepts(rows: DataFrame, id_mapping: DataFrame, consents: DataFrame, study: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Legacy concept rows under new ids by consent, and counts of each class of row.

    ``rows``: ``old_id, path, numeric, text`` and ``malformed``. Rows of ids that the mapping lacks, or of people without a consent, are counted, not written.
    """
    own = consents if study is None else J.of_study(consents, study)
    bad = F.coalesce(F.col("malformed"), F.lit(False)) if "malformed" in rows.columns else F.lit(False)
    keyed = J.to_consents(J.rekeyed(rows.withColumn("_bad", bad), id_mapping), own)
    kind = F.when(F.col("_bad"), "malformed").when(F.col("person_id").isNull(), "unmapped").when(F.col("consent_code").isNull(), "no_consent").otherwise("written")
    keyed = keyed.withColumn("class", kind)
    counts = keyed.groupBy("class").agg(F.count("*").alias("rows"), F.count_distinct("old_id").alias("ids"))
    return keyed.where("class = 'written'").select("study_id", "consent_code", "person_id", "path", "numeric", "text"), counts


def consent_folders(files: DataFrame, recorded: DataFrame | None = None) -> DataFrame:
    """One row for each consent folder: its sources' fingerprint and count, its merged file, and what else is there.

    ``files``: ``study_id, label, name, version_id, size`` (current versions). ``recorded``: ``study_id, label,
    recorded_fingerprint, recorded_md5`` of merged files.
    """
    keys = ["study_id", "label"]
    kind = S.file_class(F.col("name"), F.col("study_id"), F.col("label"))
    rows = files.withColumn("kind", kind)
    sources = A.fingerprint(rows.where("kind = 'source'"), keys)
    others = rows.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == "merged", F.col("version_id"))).alias("merged_version"), F.max(F.when(F.col("kind") == "merged", F.col("size"))).alias("merged_size"),
        F.count_if(F.col("kind") == "other_merged").alias("other_merged"), F.count_if(F.col("kind") == "ignored").alias("ignored"),
    )
    out = others.join(sources, keys, "left").withColumns({"sources": F.coalesce("sources", F.lit(0).cast("long")), "bytes": F.coalesce("bytes", F.lit(0).cast("long"))})
    if recorded is None:
        return out.withColumns({"recorded_fingerprint": F.lit(None).cast("string"), "recorded_md5": F.lit(None).cast("string")})
    return out.join(recorded.select(*keys, "recorded_fingerprint", "recorded_md5"), keys, "left")


def merge_action(changed: Column | None = None) -> Column:
    """What a merge does with a folder. ``changed``: the merged file was rewritten since the listing."""
    there = F.col("merged_version").isNotNull()
    return (
        F.when((F.col("sources") == 0) & ~there, "NO_SOURCES")
        .when((F.col("sources") == 0) & (F.col("other_merged") > 0), "ONLY_MERGED_COPIES")
        .when((F.col("sources") == 0) & (changed if changed is not None else F.lit(False)), "CHANGED_DURING_RUN")
        .when(F.col("sources") == 0, "REMOVED_NO_SOURCES")
        .when(~there, "MISSING")
        .when(F.col("recorded_fingerprint").isNull() | F.col("recorded_md5").isNull(), "NO_FINGERPRINT")
        .when(F.col("recorded_fingerprint") != F.col("fingerprint"), "SOURCES_CHANGED")
        .otherwise("UP_TO_DATE")
    )


def merge_plan(folders: DataFrame) -> DataFrame:
    """Folders with ``action`` and ``merge``; ``merge_files`` opens no source of the others. ``largest_first`` orders them for a report."""
    rows = folders.withColumn("action", merge_action(F.col("changed") if "changed" in folders.columns else None))
    return rows.withColumn("merge", F.col("action").isin("MISSING", "NO_FINGERPRINT", "SOURCES_CHANGED"))


def to_merge(lines: DataFrame, plan: DataFrame) -> DataFrame:
    """The lines (``study_id, label, name, line, value``) of folders that must be merged, sorted as their files stand."""
    return lines.join(plan.where("merge").select("study_id", "label"), ["study_id", "label"], "left_semi").orderBy("study_id", "label", "name", "line")


def merge_files(files: DataFrame, plan: DataFrame, target: str, chunk: int = 0) -> DataFrame:
    """Merge the folders that ``plan`` says to, each its sources in name order, to one file each below ``target``.

    ``files``: an inventory with ``key``, where a file is. Returns ``study_id, label, files, bytes, md5, error``. Only sources of
    folders to be merged are opened. A folder whose source can't be read has an error and keeps what stood before; it stops no other.
    The format asks for one ordered file a folder, which one task streams; folders are merged side by side.
    """
    chosen = files.join(plan.where("merge").select("study_id", "label"), ["study_id", "label"], "left_semi").where(S.file_class(F.col("name"), F.col("study_id"), F.col("label")) == "source")
    to = F.concat(F.lit(f"{target}/"), "study_id", F.lit("/allConcepts/"), "label", F.lit("/"), S.merged_file(F.col("study_id"), F.col("label")))
    done = written(merge_bytes(chosen.withColumn("_to", to), "_to", "key", "name", chunk), "merged")
    at = "([^/]+)/allConcepts/(c[^/]+)/[^/]+$"
    return done.select(F.regexp_extract("target", at, 1).alias("study_id"), F.regexp_extract("target", at, 2).alias("label"), "files", "bytes", "md5", "error")


def merge_run(spark: SparkSession, root: str, recorded: DataFrame, digests: bool = False) -> tuple[DataFrame, DataFrame]:
    """A whole merge of the folders below ``root``: what became of each, and what to record of merged files for the next run.

    Folders: ``study_id, label, action, sources, ignored, other_merged, files_merged, md5, error``. ``action`` is that of ``merge_action``, or
    ``FAILED``. A merged file without sources is removed, unless a second listing, made just before, shows another version of it.
    Recorded: ``study_id, label, recorded_fingerprint, recorded_md5``. ``digests``: versions are digests of the files' bytes.
    """
    keys = ["study_id", "label"]
    files = written(file_inventory(spark, root, digests), "inventory")
    plan = written(merge_plan(consent_folders(files, recorded)), "plan")
    done = merge_files(files, plan, root)
    ours = files.join(plan.where("action = 'REMOVED_NO_SOURCES'").select(*keys), keys, "left_semi").where(S.file_class(F.col("name"), F.col("study_id"), F.col("label")) == "merged")
    again = listing(spark, *[r["key"] for r in ours.select("key").toLocalIterator()]).select(F.col("path").alias("key"), F.struct("size", "last_modified").alias("now"))
    looked = written(ours.join(again, "key", "left").select(*keys, "key", F.coalesce(F.col("now") != F.struct("size", "last_modified"), F.lit(True)).alias("changed")), "looked")
    removed = written(remove_files(looked.where("not changed").select(F.col("key").alias("path"))), "removed")
    gone = looked.join(removed.select(F.col("path").alias("key"), F.col("error").alias("_left")), "key", "left").select(*keys, "changed", "_left")
    out = plan.join(done, keys, "left").join(gone, keys, "left")
    action = F.when(F.col("changed"), "CHANGED_DURING_RUN").when(F.coalesce("error", "_left").isNotNull(), "FAILED").otherwise(F.col("action"))
    told = out.select(*keys, action.alias("action"), "sources", "ignored", "other_merged", F.when(F.col("error").isNull(), F.coalesce("files", F.lit(0).cast("long"))).otherwise(0).alias("files_merged"),
                      F.coalesce("md5", F.when(F.col("action") == "UP_TO_DATE", F.col("recorded_md5"))).alias("md5"), F.coalesce("error", "_left").alias("error"), "fingerprint")
    told = written(told, "told")
    keep = told.where("md5 is not null").select(*keys, F.col("fingerprint").alias("recorded_fingerprint"), F.col("md5").alias("recorded_md5"))
    failed = recorded.join(told.where("action = 'FAILED'").select(*keys), keys, "left_semi").select(*keys, "recorded_fingerprint", "recorded_md5")
    return told.drop("fingerprint"), keep.unionByName(failed)


def manifest(studies: DataFrame, folders: DataFrame, files: DataFrame, global_file: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``partition, uri, version_id, last_updated, md5`` and problems ``study_id, label, severity, code``.

    ``files``: ``study_id, label, name, last_modified`` for the merged files' times; ``global_file``: ``uri,
    version_id, last_modified, size, md5``, at most one row. Only ready studies' folders count.
    """
    from cohortflow.plans.gates import folder_problems, global_problems

    ids = J.ready(studies).select("study_id").distinct()
    own = folders.join(ids, "study_id")
    judged = own.withColumn("problem", folder_problems())
    name = S.merged_file(F.col("study_id"), F.col("label"))
    times = files.where(F.col("name") == name).select("study_id", "label", "last_modified")
    good = judged.where("problem is null").join(times, ["study_id", "label"], "left").select(
        F.concat_ws(".", "study_id", "label").alias("partition"), F.concat(F.lit(root), F.col("study_id"), F.lit("/allConcepts/"), F.col("label"), F.lit("/"), name).alias("uri"),
        F.col("merged_version").alias("version_id"), F.col("last_modified").cast("string").alias("last_updated"), F.col("recorded_md5").alias("md5"))
    whole = global_file.where("version_id is not null and version_id not in ('', 'null') and size > 0").select(
        F.lit("global").alias("partition"), "uri", "version_id", F.col("last_modified").cast("string").alias("last_updated"), "md5")
    found = judged.where("problem is not null").select("study_id", "label", "problem.severity", "problem.code")
    without = ids.join(folders.select("study_id").distinct(), "study_id", "left_anti").select("study_id", F.lit(None).cast("string").alias("label"), F.lit("ERROR").alias("severity"), F.lit("NO_CONSENT_FOLDERS").alias("code"))
    absent = own.select("study_id").distinct().join(good.select(F.substring("partition", 1, 9).alias("study_id")).distinct(), "study_id", "left_anti")
    absent = absent.select("study_id", F.lit(None).cast("string").alias("label"), F.lit("WARNING").alias("severity"), F.lit("STUDY_NOT_IN_MANIFEST").alias("code"))
    return whole.unionByName(good), R.union(found, without, absent, global_problems(global_file, good))


def migrate(studies: DataFrame, mapping: DataFrame, loaded: DataFrame, subjects: DataFrame, not_consented: DataFrame, participants: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Id mappings (``study_id, old_id, person_id, dbgap_id``), each study's outcome, and what did not resolve.

    ``files``: ``study_id, name`` of raw files. A study is loaded from its subject-sample rows, else from its
    subject and sample tables, else skipped; one whose mapping resolves to nothing needs a review.
    """
    kinds = files.withColumn("kind", S.raw_file_class(F.col("name"), F.col("study_id")))
    source = kinds.groupBy("study_id").agg(F.max(F.col("kind").isin("sstr", "sstr_copy")).alias("_sstr"), F.max(F.col("kind") == "subject").alias("_multi"))
    rows = J.resolve_patients(mapping, loaded, subjects, not_consented, participants)
    per = rows.groupBy("study_id").agg(F.count_if(F.col("resolution") == "mapped").alias("mapping_rows"), F.count_if(F.col("resolution") != "mapped").alias("unresolved_rows"))
    out = J.ready(studies).select("study_id", "abv", "ord").dropDuplicates(["study_id"]).join(source, "study_id", "left").join(per, "study_id", "left")
    chosen = F.when(F.col("_sstr"), "SSTR").when(F.col("_multi"), "MULTI")
    codes = F.array_compact(F.array(F.when(chosen.isNull(), "NO_PARTICIPANT_FILES"), F.when(chosen.isNotNull() & (F.coalesce("mapping_rows", F.lit(0)) == 0), "NEEDS_DATA_REVIEW")))
    out = out.withColumns({"source": chosen, "codes": codes})
    out = out.select("ord", "study_id", "abv", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("mapping_rows", "unresolved_rows")], S.study_outcome(F.size("codes") == 0, F.col("codes")).alias("outcome"))
    return rows.where("resolution = 'mapped'").select("study_id", "old_id", "person_id", "dbgap_id"), out, A.unresolved(rows)


def resolve_studies(studies: DataFrame, inputs: DataFrame) -> DataFrame:
    """``study_id, abv, plan, reason, decoded_bytes, csv_count``: load, already_processed, or excluded with all its reasons.

    ``inputs``: ``study_id, has_sstr, csv_count, decoded_bytes, has_mapping``.
    """
    rows = J.ready(studies).select("study_id", "abv", "is_processed", "ord").join(inputs, "study_id", "left")
    reasons = F.concat_ws("; ",
        F.when(~F.coalesce("has_sstr", F.lit(False)), "no subject-sample file"), F.when(F.coalesce("csv_count", F.lit(0)) == 0, "no decoded data file"),
        F.when(~F.coalesce("has_mapping", F.lit(False)), "no concept mapping"))
    plan = F.when(F.col("is_processed"), "already_processed").when(reasons != "", "excluded").otherwise("load")
    return rows.select("ord", "study_id", "abv", plan.alias("plan"), F.when(plan == "excluded", reasons).otherwise("").alias("reason"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("decoded_bytes", "csv_count")])


def exclude_studies(studies: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The study list with excluded ones not ready, and excluded ids that it lacks."""
    marked = excluded.select("study_id").distinct().withColumn("_out", F.lit(True))
    rows = studies.join(marked, "study_id", "left").withColumn("is_ready", F.col("is_ready") & F.col("_out").isNull()).drop("_out")
    return rows.select(*studies.columns), marked.select("study_id").join(studies.select("study_id"), "study_id", "left_anti")
