"""Studies, consents, concepts and files: parsing their names and codes. Arguments and results are columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.cells import is_number, trimmed

SEP = "µ"
# Concept paths.
CONSENTS, SUBJECT_ID, SAMPLE_ID, STUDY_CONSENTS = "µ_consentsµ", "µ_source_subject_idµ", "µ_source_sample_idµ", "µ_studies_consentsµ"
STUDY_ID = "phs\\d{6}"
# Exit codes of a job and their names.
EXIT_NAMES = {0: "SUCCESS", 2: "VALIDATION_FAILED", 3: "DATA_ERROR", 4: "INFRASTRUCTURE_ERROR", 5: "CONFIG_ERROR", 124: "TIMEOUT"}
MARKER = "_allConcepts_"


def concept_path(c: Column) -> Column:
    """Backslashes become separators; one at either end is added where missing."""
    path = F.translate(c, "\\", SEP)
    path = F.when(path.startswith(SEP), path).otherwise(F.concat(F.lit(SEP), path))
    return F.when(path.endswith(SEP) & (F.length(path) > 1), path).otherwise(F.concat(path, F.lit(SEP)))


def mapping_key(c: Column) -> Column:
    """``file:column`` as a struct ``file, column``; null unless it has just those parts and a whole column number."""
    parts = F.split(c, ":", -1)
    number = trimmed(F.get(parts, F.lit(1))).try_cast("int")
    good = (F.size(parts) == 2) & (trimmed(F.get(parts, F.lit(0))) != "") & (number >= 0)
    return F.when(good, F.struct(trimmed(F.get(parts, F.lit(0))).alias("file"), number.alias("column")))


def patient_column(options: Column) -> Column:
    """The number under ``patientcol`` in ``k=v;k=v``: the first there is; 0 if it is none or bad."""
    pairs = F.transform(F.split(F.coalesce(options, F.lit("")), ";"), lambda x: F.split(x, "=", 2))
    named = F.filter(pairs, lambda p: (F.size(p) == 2) & (F.lower(trimmed(p[0])) == "patientcol"))
    number = trimmed(F.get(F.get(named, F.lit(0)), F.lit(1))).try_cast("int")
    return F.when(number >= 0, number).otherwise(0)


def data_type(c: Column) -> Column:
    return F.when(F.upper(trimmed(c)) == "NUMERIC", "NUMERIC").otherwise("TEXT")


def consent_code(c: Column) -> Column:
    """Digits without leading zeros; null for anything else."""
    cell = trimmed(c)
    return F.when(cell.rlike("^\\d+$"), F.regexp_replace(cell, "^0+(?=\\d)", ""))


def abbreviation(label: Column) -> Column:
    """What stands in the parentheses at the label's end; empty if there are none."""
    return F.regexp_extract(label, "\\(([^()]+)\\)\\s*$", 1)


def group_name(name: Column) -> Column:
    """Study and consent of a consent group's directory, as a struct; null if either is missing."""
    study = F.regexp_extract(name, STUDY_ID, 0)
    code = F.regexp_extract(name, "[-_]c(\\d+)$", 1)
    return F.when((study != "") & (code != ""), F.struct(study.alias("study_id"), code.alias("consent_code")))


def identities(raw: Column) -> Column:
    """The ids in an identity cell: a bare id, or a list in JSON's manner with single quotes.

    Scalars stand for themselves. An object gives its field ``value``, found in any case, or else all its
    fields. A null is the text ``null``; a list in the list gives nothing. What can't be
    parsed is stripped of brackets and quotes and split at commas.
    """
    cell = trimmed(F.coalesce(raw, F.lit("")))
    parsed = F.from_json(F.translate(cell, "'", '"'), "array<string>")

    def of(x: Column) -> Column:
        fields = F.from_json(x, "map<string,string>")
        value = F.filter(F.map_entries(fields), lambda e: F.lower(trimmed(e["key"])) == "value")
        many = F.when(F.size(value) > 0, F.transform(value, lambda e: e["value"])).otherwise(F.map_values(fields))
        return F.when(x.isNull(), F.array(F.lit("null"))).when(x.startswith("["), F.array().cast("array<string>")).when(x.startswith("{") & fields.isNotNull(), many).otherwise(F.array(x))

    listed = F.flatten(F.transform(parsed, of))
    bare = F.split(F.regexp_replace(cell, "[\\[\\]{}'\" ]", ""), ",")
    ids = F.when(cell.startswith("[") & parsed.isNotNull(), listed).otherwise(bare)
    return F.filter(F.transform(ids, lambda x: trimmed(F.coalesce(x, F.lit("null")))), lambda x: x != "")


def is_genomic(kind: Column) -> Column:
    """Whether one of the parts between slashes is G, in any case."""
    return F.exists(F.split(F.coalesce(kind, F.lit("")), "/"), lambda x: F.upper(trimmed(x)) == "G")


def is_study_id(c: Column) -> Column:
    return F.coalesce(c.rlike(f"^{STUDY_ID}$"), F.lit(False))


def consent_label(code: Column) -> Column:
    return F.concat(F.lit("c"), code)


def partition_name(study: Column, code: Column) -> Column:
    return F.concat(study, F.lit(".c"), code)


def concept_file(study: Column, code: Column) -> Column:
    """Where a consent group's concept rows are kept, below the root."""
    return F.concat(study, F.lit("/allConcepts/c"), code, F.lit("/"), study, F.lit("_allConcepts_c"), code, F.lit(".csv"))


def merged_file(study: Column, label: Column) -> Column:
    return F.concat(study, F.lit("_"), label, F.lit("_allConcepts_MERGED.csv"))


def is_merged_name(name: Column) -> Column:
    return F.lower(name).endswith("_merged.csv")


def file_class(name: Column, study: Column, label: Column) -> Column:
    """``merged`` (this group's), ``source``, ``other_merged`` or ``ignored``."""
    marked = name.contains(MARKER)
    return F.when(name == merged_file(study, label), "merged").when(marked & ~is_merged_name(name), "source").when(marked, "other_merged").otherwise("ignored")


def raw_file_class(name: Column, study: Column) -> Column:
    """``sstr``, ``sstr_copy`` (a flattened copy), ``subject``, ``sample``, ``dictionary``, or null."""
    low, own = F.lower(name), F.lower(study)
    sstr = low.endswith(".txt") & low.contains(own) & (low.startswith("sstr_") | low.startswith("bdc-ingestion-only__sstr_"))
    mine = low.startswith(own)
    return (
        F.when(sstr, F.when(low.startswith("sstr_") & ~low.startswith("sstr__"), "sstr").otherwise("sstr_copy"))
        .when(mine & low.endswith("subject.multi.txt"), "subject")
        .when(mine & low.endswith("sample.multi.txt"), "sample")
        .when(mine & low.endswith("subject.data_dict.xml"), "dictionary")
    )


def natural_key(name: Column) -> Column:
    """An array to order names by: runs of digits as numbers of any length, the rest in any case, then shorter first."""
    runs = F.regexp_extract_all(F.lower(name), F.lit("(\\d+|\\D+)"), F.lit(1))

    def number(x: Column) -> Column:
        digits = F.ltrim(x, F.lit("0"))
        return F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)  # a longer number is a larger one

    keys = F.transform(runs, lambda x: F.when(x.rlike("^\\d"), number(x)).otherwise(x))
    return F.concat(keys, F.array(F.lpad(F.length(name).cast("string"), 10, "0")))


def resolve_column(df: DataFrame, names: list[str]) -> str | None:
    """The frame's column that the first of ``names`` to be there stands for, headers trimmed, in any case."""
    known = {}
    for c in df.columns:
        known.setdefault(c.strip().lower(), c)
    return next((known[n.lower()] for n in names if n.lower() in known), None)


def consented(code: Column) -> Column:
    return F.coalesce(code != "0", F.lit(False))


def sequenced(sample: Column) -> Column:
    return sample.startswith("NWD")


def exit_name(code: Column) -> Column:
    pairs = [x for k, v in EXIT_NAMES.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit("UNKNOWN"))


def issue_study(context: Column, location: Column, message: Column) -> Column:
    """The study an issue is about: from its context, or the first study id in folder, location or message."""
    def first(c: Column) -> Column:
        return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), STUDY_ID, 0), F.lit(""))

    named = F.nullif(F.try_element_at(context, F.lit("studyId")), F.lit(""))
    return F.coalesce(named, first(F.try_element_at(context, F.lit("folder"))), first(location), first(message))


# Fixed values in the next two: issue codes, and the outcomes and classes of studies that reports carry.


def study_outcome(success: Column, codes: Column) -> Column:
    """``success``, ``needs_review``, ``skipped`` or ``failed`` from a study's issue codes."""
    return (
        F.when(success, "success").when(F.array_contains(codes, "NEEDS_DATA_REVIEW"), "needs_review")
        .when(F.array_contains(codes, "NO_PARTICIPANT_FILES"), "skipped").otherwise("failed")
    )


def outcome_class(success: Column, source: Column, sstr_file: Column, codes: Column) -> Column:
    """The report's class of a study: how it was loaded, or why it was not."""
    return (
        F.when(success & (source == "SSTR"), "loaded_sstr")
        .when(success & sstr_file.isNull(), "loaded_multi")
        .when(success, "loaded_multi_sstr_malformed")
        .when(F.array_contains(codes, "NEEDS_DATA_REVIEW"), "skipped_needs_review")
        .when(F.array_contains(codes, "NO_PARTICIPANT_FILES"), "skipped_no_files")
        .when(F.array_contains(codes, "NO_PARTICIPANT_SOURCE"), "failed_no_source")
        .when(F.array_contains(codes, "MULTI_LOAD_FAILED"), "failed_multi")
        .otherwise("failed_other")
    )


def is_data_failure(stage: Column, exit_label: Column) -> Column:
    """Whether the study's data, not the run, was at fault."""
    return F.coalesce(stage.isin("preflight", "validation"), F.lit(False)) | F.coalesce(exit_label.isin("DATA_ERROR", "VALIDATION_FAILED"), F.lit(False))


# The status that each category of review item stands for.
REVIEW = {
    "MISSING_DATA": "NOT_MIGRATED", "MALFORMED_DATA": "NOT_MIGRATED", "DATA_MISMATCH": "NOT_MIGRATED",
    "PIPELINE_FAILURE": "RERUN_NEEDED", "PARTIAL_DATA": "MIGRATED_WITH_GAPS", "OUTPUT_WARNING": "MIGRATED_WITH_GAPS",
}
#: What a status asks of its reader.
ACTIONS = {"NOT_MIGRATED": "needs other input", "RERUN_NEEDED": "needs another run", "MIGRATED_WITH_GAPS": "needs a look at its counts"}


def looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def review_status(category: Column) -> Column:
    return looked_up(REVIEW, category)


def review_action(category: Column) -> Column:
    return F.coalesce(looked_up(ACTIONS, review_status(category)), F.lit(""))


def row_violation(row_id: Column, path: Column, numeric: Column, text: Column) -> Column:
    """Why a concept row is not allowed, or null: no id, a path without its ends, both values or a bad number."""
    return (
        F.when(F.coalesce(trimmed(row_id), F.lit("")) == "", "NO_ID")
        .when(~F.coalesce(path.startswith(SEP) & path.endswith(SEP) & (F.length(path) > 1), F.lit(False)), "BAD_PATH")
        .when((F.coalesce(numeric, F.lit("")) != "") & (F.coalesce(text, F.lit("")) != ""), "TWO_VALUES")
        .when((F.coalesce(numeric, F.lit("")) != "") & ~is_number(numeric), "BAD_NUMBER")
    )
