"""The files of clinical studies, each read into the shape that operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import studies as S
from cohortflow.functions.cells import trimmed, yes_no
from cohortflow.operators.dedup import first_usable_consent, last_per_key, with_row_order
from cohortflow.sources.delimited import BadFile, read_commented, read_delimited, read_positional, require_columns, require_none

# The names that the columns of subject and sample tables go by, the first found counts.
DBGAP_SUBJECT = ["dbGaP_Subject_ID", "dbGaP SubjID"]
OWN_SUBJECT = ["SUBJECT_ID", "SUBJID", "submitted_subject_id", "subj_id"]
CONSENT = ["consent", "consent_1217", "consentcol", "gencons", "consent_code", "consent_group"]
DBGAP_SAMPLE = ["dbGaP_Sample_ID", "dbGaP SampID"]
OWN_SAMPLE = ["SAMPLE_ID", "SAMPID", "submitted_sample_id"]
# Columns of an id mapping.
OLD_ID, NEW_ID = "old_hpds_id", "new_hpds_id"
# The headings of the study list.
ABV, STUDY, KIND, READY, PROCESSED = "Study Abbreviated Name", "Study Identifier", "Data Type", "Data is ready to process", "Data Processed"
HEADINGS = [
    ABV, STUDY, "Version", "Phase", "Version Update", "Previous Version", "Previous Phase", "Study Full Name", "Study Type", "BDC Program(s)", KIND, "DCC Harmonized", "Has Multi",
    "Use Manual Table Methods", "More Info Link", "Additional Information Link (URL)", "Additional Information Link (Label)", "Request Access Text", "Pheno Ingest NHLBI Account",
    "Pheno Ingest buckets", "Gen3 Authz Program Name", "Gen3 Authz Project Name", "Subject Type(s)", READY, PROCESSED,
]


def empty(c):
    return trimmed(F.coalesce(c, F.lit(""))) == ""


def read_managed_inputs(spark: SparkSession, path: str) -> DataFrame:
    """The study list: all columns, trimmed, with ``ord, study_id, abv, data_type, is_ready, is_processed``.

    All headings must be there. Rows without abbreviation or id are dropped. A flag that is neither yes, no nor blank is an error.
    """
    df = require_columns(read_delimited(spark, path), HEADINGS, "the study list")
    df = with_row_order(df).select(*[trimmed(F.col(f"`{c}`")).alias(c) for c in df.columns], "ord")
    df = df.where((F.col(f"`{ABV}`") != "") & (F.col(f"`{STUDY}`") != ""))
    df = require_none(df, yes_no(F.col(f"`{READY}`")).isNull() | yes_no(F.col(f"`{PROCESSED}`")).isNull(), "flags that are neither yes nor no")
    return df.withColumns({
        "study_id": F.col(f"`{STUDY}`"), "abv": F.col(f"`{ABV}`"), "data_type": F.col(f"`{KIND}`"),
        "is_ready": yes_no(F.col(f"`{READY}`")), "is_processed": yes_no(F.col(f"`{PROCESSED}`")),
    })


def read_concept_mapping(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``file, column, path, declared, patient_column`` of a mapping's rows, and the rows dropped, with ``reason``.

    A first row whose key is a bare word, without a colon, is a header. An error if no row is left.
    """
    df = with_row_order(spark.read.schema("c0 string, c1 string, c2 string, c3 string, c4 string").options(quote='"', escape='"', mode="PERMISSIVE").csv(path))
    df = df.select("ord", *[F.translate(trimmed(F.coalesce(F.col(f"c{i}"), F.lit(""))), '"', "").alias(f"c{i}") for i in range(5)], F.col("c3").isNull().alias("short"))
    df = df.where(F.concat(*[F.col(f"c{i}") for i in range(5)]) != "")
    first = df.agg(F.min("ord")).head()[0]
    at_first = F.lit(False) if first is None else (F.col("ord.file_path") == first["file_path"]) & (F.col("ord.file_block_start") == first["file_block_start"]) & (F.col("ord.n") == first["n"])
    header = at_first & ~F.col("c0").contains(":") & F.col("c0").rlike("^[A-Za-z_ ]+$")
    df = df.where(~header)
    key = S.mapping_key(F.col("c0"))
    reason = F.when(F.col("short"), "TOO_FEW_COLUMNS").when(key.isNull(), "BAD_KEY").when(F.col("c1") == "", "NO_ROOT")
    df = df.withColumns({"key": key, "reason": reason})
    path_text = F.when(F.col("c2") == "", F.col("c1")).otherwise(F.concat("c1", F.lit(S.SEP), "c2"))
    good = df.where("reason is null").select(
        "key.file", "key.column", F.regexp_replace(S.concept_path(path_text), f"{S.SEP}+", S.SEP).alias("path"), S.data_type(F.col("c3")).alias("declared"), S.patient_column(F.col("c4")).alias("patient_column"))
    if good.isEmpty():
        raise BadFile(f"{path}: no usable mapping row")
    return good, df.where("reason is not null").select("c0", "reason")


def read_sstr(spark: SparkSession, path: str) -> DataFrame:
    """Subject and sample rows with ``ord``. A blank subject or consent fails the load; the sample columns may lack."""
    df = require_columns(read_delimited(spark, path, "\t"), ["SUBJECT_ID", "CONSENT", "consent_abbreviation", "dbgap_subject_id", "dbgap_sample_id"], path)
    sample = F.col("SAMPLE_ID") if "SAMPLE_ID" in df.columns else F.lit("")
    df = with_row_order(df).select("ord", trimmed(F.col("SUBJECT_ID")).alias("subject_id"), trimmed(sample).alias("sample_id"), trimmed(F.col("CONSENT")).alias("consent"),
                   trimmed(F.col("consent_abbreviation")).alias("consent_abbreviation"), trimmed(F.col("dbgap_subject_id")).alias("dbgap_subject_id"), trimmed(F.col("dbgap_sample_id")).alias("dbgap_sample_id"))
    return require_none(df, empty(F.col("dbgap_subject_id")) | empty(F.col("consent")), f"{path}: subject or consent is blank")


def column(df: DataFrame, names: list[str], what: str):
    found = S.resolve_column(df, names)
    if found is None:
        raise BadFile(f"none of the columns {', '.join(names)} for {what}")
    return trimmed(F.col(f"`{found}`"))


def read_subjects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Consented (``dbgap_id, code, conflicts, subject_id``), not consented (``dbgap_id, subject_id``), and issues (``ord, code, example``).

    Not consented are those who say 0 and never another code; those without any usable code are only issues.
    """
    df = read_commented(spark, path)
    own = S.resolve_column(df, OWN_SUBJECT)
    rows = with_row_order(df).select("ord", column(df, DBGAP_SUBJECT, "the repository's subject id").alias("dbgap_id"),
                     (trimmed(F.col(f"`{own}`")) if own else F.lit("")).alias("subject_id"), column(df, CONSENT, "the consent").alias("code"))
    blank = empty(F.col("dbgap_id"))
    code = S.consent_code(F.col("code"))
    kind = F.when(blank, "BLANK_SUBJECT").when(empty(F.col("code")), "BLANK_CONSENT").when(code.isNull(), "CONSENT_NOT_A_NUMBER").when(code == "0", "CONSENT_ZERO")
    issues = rows.select("ord", kind.alias("code"), F.concat_ws(":", "dbgap_id", "code").alias("example")).where("code is not null")
    rows = rows.where(~blank)
    return *first_usable_consent(rows, ["dbgap_id"], "code", "ord", "subject_id"), issues


def read_samples(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``ord, subject_id, dbgap_sample_id, sample_id`` of rows with a subject and an id, and issues for the others."""
    df = read_commented(spark, path)
    own = S.resolve_column(df, OWN_SAMPLE)
    rows = with_row_order(df).select("ord", column(df, DBGAP_SUBJECT, "the subject").alias("subject_id"), column(df, DBGAP_SAMPLE, "the sample").alias("dbgap_sample_id"),
                     (trimmed(F.col(f"`{own}`")) if own else F.lit("")).alias("sample_id"))
    kind = F.when(empty(F.col("subject_id")), "BLANK_SUBJECT").when(empty(F.col("dbgap_sample_id")) & empty(F.col("sample_id")), "NO_SAMPLE_ID")
    return rows.where(kind.isNull()), rows.select("ord", kind.alias("code"), F.col("subject_id").alias("example")).where("code is not null")


VARIABLE = "name string, value array<struct<_VALUE:string,_code:string>>"


def read_consent_decodings(spark: SparkSession, path: str, consent: str) -> DataFrame:
    """``consent_code, label`` from the dictionary's first variable of that name, in any case; the first label of a code counts.

    A document type declaration, or a file that is no XML, is refused. Codes are read as text: 02 is not 2.0.
    """
    raw = spark.read.text(path, wholetext=True)
    if not raw.where(F.col("value").contains("<!DOCTYPE") | ~F.trim(F.col("value")).startswith("<")).isEmpty():
        raise BadFile(f"{path} is no plain XML document")
    df = spark.read.format("xml").options(rowTag="variable", inferSchema=False, mode="FAILFAST").schema(VARIABLE).load(path)
    df = df.where(F.lower(trimmed(F.col("name"))) == consent.lower()).withColumn("n", F.monotonically_increasing_id())
    first = df.orderBy("n").limit(1).select(F.posexplode("value").alias("pos", "v"))
    rows = first.select("pos", S.consent_code(F.col("v._code")).alias("consent_code"), trimmed(F.col("v._VALUE")).alias("label")).where("consent_code is not null")
    return rows.groupBy("consent_code").agg(F.min_by("label", "pos").alias("label"))


def read_patient_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``id, old_id`` of a headerless mapping; a row of fewer than three cells or with a blank id fails."""
    df = read_positional(spark, path, 3)
    df = require_none(df, F.col("c2").isNull() | empty(F.col("c0")) | empty(F.col("c2")), f"{path}: rows that are short or blank")
    return df.select(trimmed(F.col("c0")).alias("id"), trimmed(F.col("c2")).alias("old_id"))


def read_id_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``old_id, new_id``; the last row of an old id counts."""
    df = with_row_order(read_delimited(spark, path)).select("ord", trimmed(F.col(OLD_ID)).alias("old_id"), trimmed(F.col(NEW_ID)).alias("new_id"))
    return last_per_key(df.where("old_id <> '' and new_id <> ''"), ["old_id"], "ord").drop("ord")


def read_person_tree(spark: SparkSession, base: str, dataset: str, column_name: str = "identity") -> DataFrame:
    """``study_id, consent_code, file, raw`` of every mapped person file below a dataset's consent groups."""
    opts = {"header": True, "sep": "\t", "quote": "", "recursiveFileLookup": True, "pathGlobFilter": "Person.tsv"}
    df = spark.read.options(**opts).csv(f"{base}/{dataset}")
    found = next((c for c in df.columns if c.strip().lower() == column_name), None)
    if found is None:
        raise BadFile(f"{base}/{dataset}: no person file with a column {column_name}")
    file = F.col("_metadata.file_path")
    group = F.regexp_extract(file, "/consent_groups/([^/]+)/(?:.*/)?mapped-data/Person\\.tsv$", 1)
    rows = df.select(file.alias("file"), S.group_name(group).alias("g"), F.col(f"`{found}`").alias("raw"))
    return rows.where("g is not null").select("g.*", "file", "raw")


def read_all_concepts(spark: SparkSession, path: str) -> DataFrame:
    """Concept rows of headerless files, split by line: ``person_id, path, numeric, text, timestamp, malformed``."""
    df = read_positional(spark, path, 5)
    bad = F.col("c4").isNull() | empty(F.col("c0"))
    return df.select(F.col("c0").alias("person_id"), F.col("c1").alias("path"), *[F.coalesce(F.col(f"c{i}"), F.lit("")).alias(n) for i, n in ((2, "numeric"), (3, "text"), (4, "timestamp"))], bad.alias("malformed"))
