"""Many delimited files in one scan, each by its own header, with a verdict for each instead of an error for all.

Files of a kind differ in their columns and their order. They are read as lines; a file's header is its first
line, and cells are found by the header's names. Files are split like any text, so a hot file is read by many tasks. Cells
don't hold line breaks. Nothing here fails because of what a file holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.cells import trimmed
from cohortflow.functions.studies import consent_code
from cohortflow.sources.scratch import written
from cohortflow.sources.study_files import CONSENT, DBGAP_SAMPLE, DBGAP_SUBJECT, OWN_SAMPLE, OWN_SUBJECT

# The columns of a subject and sample table.
SSTR = ["SUBJECT_ID", "CONSENT", "consent_abbreviation", "dbgap_subject_id", "dbgap_sample_id"]


def lines(spark: SparkSession, paths: list[str], comment: str | None = None) -> DataFrame:
    """``file, ord, value``: all lines but blank ones and comments, with their place; none for no paths."""
    if not paths:
        return spark.createDataFrame([], "file string, ord struct<file_path:string,file_block_start:long,n:long>, value string")
    place = F.struct(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), F.monotonically_increasing_id().alias("n"))
    df = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), place.alias("ord"), "value")
    kept = F.trim("value") != ""
    return df.where(kept & ~F.col("value").startswith(comment) if comment else kept)


def quoted_cells(value: Column, sep: str) -> Column:
    """The cells of a line that are quoted where needed, a quote inside doubled. Spark's own parser does not tell a missing cell from an empty one."""
    quoted = '"[^"]*(?:""[^"]*)*"'
    each = F.regexp_extract_all(F.concat(F.lit(sep), value), F.lit(f"{sep}(?:{quoted}[^{sep}]*|[^{sep}]*)"), F.lit(0))

    def clean(x: Column) -> Column:
        x = F.substr(x, F.lit(2))
        inner = F.replace(F.regexp_replace(x, f"^\"([^\"]*(?:\"\"[^\"]*)*)\"[^{sep}]*$", "$1"), F.lit('""'), F.lit('"'))
        return F.when(x.rlike(f"^{quoted}"), inner).otherwise(x)

    # Most lines hold no quote: these are only split.
    return F.when(F.contains(value, F.lit('"')), F.transform(each, clean)).otherwise(F.split(value, sep, -1))


def own_headers(spark: SparkSession, paths: list[str], sep: str, comment: str | None = None, quoted: bool = False, trim: bool = False) -> tuple[DataFrame, DataFrame]:
    """``file, header, ord, cells`` of every row below its file's header, and ``file, header`` of every file with a line. ``trim``: cells are trimmed."""
    every = lines(spark, paths, comment)
    # The place of a file's first line, by numbers alone, so that no lines are sorted. Places hold within one reading only: each finds its own.
    blocks = every.groupBy("file", F.col("ord.file_block_start").alias("block")).agg(F.min("ord.n").alias("n"))
    firsts = blocks.groupBy("file").agg(F.min_by("n", "block").alias("at"))

    def cells(c: Column) -> Column:
        return quoted_cells(c, sep) if quoted else F.split(c, sep, -1)

    # Written, since every use would read all lines for them. A row for each file, whose paths the driver has named: broadcast, else a file's lines would meet in one task.
    heads = written(every.join(F.broadcast(firsts), "file").where(F.col("ord.n") == F.col("at")).select("file", F.transform(cells(F.col("value")), trimmed).alias("header")), "headers")
    own = cells(F.col("value"))
    if trim:
        # Most lines hold no blank: none of their cells does.
        own = F.when(F.col("value").rlike("[\\x00-\\x20]"), F.transform(own, trimmed)).otherwise(own)
    rows = every.join(F.broadcast(heads.join(firsts, "file")), "file").where(F.col("ord.n") != F.col("at")).select("file", "header", "ord", own.alias("cells"))
    return rows, heads


def place_of(names: list[str], exact: bool = False) -> Column:
    """Where in the header the first of ``names`` to be there stands, from 1; null for none. In any case, unless ``exact``."""
    header = F.col("header") if exact else F.transform("header", F.lower)
    return F.coalesce(*[F.nullif(F.array_position(header, n if exact else n.lower()), F.lit(0)) for n in names])


def cell(names: list[str], exact: bool = False) -> Column:
    """The row's cell below the first of ``names``; empty if there is none."""
    return trimmed(F.coalesce(F.try_element_at("cells", place_of(names, exact).cast("int")), F.lit("")))


def verdicts(heads: DataFrame, rows: DataFrame, needs: dict[str, Column], bad: dict[str, Column]) -> DataFrame:
    """``file, problem, bad_rows``: null for a good file, else the first of ``needs`` that its header lacks, or of the kinds of ``bad`` rows it has, or NO_ROWS."""
    lacks = F.coalesce(*[F.when(c.isNull(), F.lit(k)) for k, c in needs.items()])
    kind = F.coalesce(*[F.when(c, F.lit(k)) for k, c in bad.items()]) if bad else F.lit(None).cast("string")
    per = rows.withColumn("_k", kind).groupBy("file").agg(F.count("*").alias("_n"), F.min("_k").alias("_bad"), F.count("_k").alias("bad_rows"))
    joined = heads.withColumn("_lacks", lacks).join(per, "file", "left")
    problem = F.coalesce("_lacks", "_bad", F.when(F.col("_n").isNull(), "NO_ROWS"))
    return joined.select("file", problem.alias("problem"), F.when(F.col("_lacks").isNull(), F.coalesce("bad_rows", F.lit(0).cast("long"))).otherwise(0).alias("bad_rows"))


def sstr_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of subject and sample tables, ``file, ord`` and ``read_sstr``'s columns; and ``file, problem, bad_rows``.

    A table is unusable if it lacks a column, a subject or a consent, or any row.
    """
    rows, heads = own_headers(spark, paths, "\t", quoted=True)
    named = {"subject_id": "SUBJECT_ID", "sample_id": "SAMPLE_ID", "consent": "CONSENT", "consent_abbreviation": "consent_abbreviation", "dbgap_subject_id": "dbgap_subject_id", "dbgap_sample_id": "dbgap_sample_id"}
    out = rows.select("file", "ord", *[cell([c], True).alias(k) for k, c in named.items()])
    return out, verdicts(heads, out, {f"NO_COLUMN_{c.upper()}": place_of([c], True) for c in SSTR}, {"BLANK_SUBJECT": F.col("dbgap_subject_id") == "", "BLANK_CONSENT": F.col("consent") == ""})


def subject_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of subject tables, ``file, ord, dbgap_id, subject_id, code``; and ``file, problem, bad_rows``: no column of a subject or a consent, a row wider than the header, no rows, or nobody with a usable consent."""
    rows, heads = own_headers(spark, paths, "\t", comment="#")
    out = rows.select("file", "ord", cell(DBGAP_SUBJECT).alias("dbgap_id"), cell(OWN_SUBJECT).alias("subject_id"), cell(CONSENT).alias("code"), (F.size("cells") > F.size("header")).alias("wide"))
    per = verdicts(heads, out, {"NO_COLUMN_SUBJECT": place_of(DBGAP_SUBJECT), "NO_COLUMN_CONSENT": place_of(CONSENT)}, {"ROW_TOO_WIDE": F.col("wide")})
    usable = out.where((F.col("dbgap_id") != "") & (consent_code(F.col("code")) != "0")).select("file").distinct().withColumn("_some", F.lit(True))
    per = per.join(usable, "file", "left").select("file", F.coalesce("problem", F.when(F.col("_some").isNull(), "NOBODY_CONSENTED")).alias("problem"), "bad_rows")
    return out.drop("wide"), per


def sample_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of sample tables with a subject and an id, ``file, ord, subject_id, dbgap_sample_id, sample_id``; and ``file, problem, bad_rows``."""
    rows, heads = own_headers(spark, paths, "\t", comment="#")
    out = rows.select("file", "ord", cell(DBGAP_SUBJECT).alias("subject_id"), cell(DBGAP_SAMPLE).alias("dbgap_sample_id"), cell(OWN_SAMPLE).alias("sample_id"), (F.size("cells") > F.size("header")).alias("wide"))
    per = verdicts(heads, out, {"NO_COLUMN_SUBJECT": place_of(DBGAP_SUBJECT), "NO_COLUMN_SAMPLE": place_of(DBGAP_SAMPLE)}, {"ROW_TOO_WIDE": F.col("wide")})
    return out.where("subject_id <> '' and (dbgap_sample_id <> '' or sample_id <> '')").drop("wide"), per


def patient_mapping_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of headerless patient mappings, ``file, id, old_id``; and ``file, problem, bad_rows``: rows of fewer than three cells or with a blank id."""
    every = lines(spark, paths)
    cells = quoted_cells(F.col("value"), ",")
    out = every.select("file", (F.size(cells) < 3).alias("short"), *[trimmed(F.coalesce(F.get(cells, i), F.lit(""))).alias(n) for i, n in ((0, "id"), (2, "old_id"))])
    bad = F.col("short") | (F.col("id") == "") | (F.col("old_id") == "")
    per = out.groupBy("file").agg(F.count_if(bad).alias("bad_rows")).select("file", F.when(F.col("bad_rows") > 0, "SHORT_OR_BLANK_ROW").alias("problem"), "bad_rows")
    return out.where(~bad).select("file", "id", "old_id"), per


def study_of(file: str | Column = "file") -> Column:
    """The study whose folder a raw file or a mapping is in."""
    return F.regexp_extract(file, "([^/]+)/(?:rawData|legacy/data)/[^/]+$", 1)


def decoding_files(spark: SparkSession, paths: list[str], consents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``file, consent_code, label`` of dictionaries, from the first variable that a study's consent column names; and ``file, problem``.

    ``consents``: ``study_id, consent``, the name that a dictionary's variable must have, in any case. A declaration of a document
    type, or text that is no XML, makes a dictionary unusable; a variable that is not there is a problem too.
    Dictionaries are small: each is held whole by a task.
    """
    if not paths:
        return spark.createDataFrame([], "file string, consent_code string, label string"), spark.createDataFrame([], "file string, problem string")
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    raw = raw.withColumn("study_id", study_of()).join(consents, "study_id", "left")
    table = T.StructType([T.StructField("variable", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.ArrayType(T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_code", T.StringType())])))])))])
    table = T.StructType([*table.fields, T.StructField("_corrupt_record", T.StringType())])
    plain = F.trim("value").startswith("<") & ~F.contains("value", F.lit("<!DOCTYPE"))
    parsed = raw.withColumn("x", F.when(plain, F.from_xml("value", table, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})))
    fits = F.filter("x.variable", lambda v: F.lower(trimmed(v["name"])) == F.lower("consent"))
    parsed = parsed.select("file", (~plain | F.col("x").isNull() | F.col("x._corrupt_record").isNotNull()).alias("bad"), F.get(fits, 0).alias("v"))
    problem = F.when(F.col("bad"), "DATA_DICT_UNREADABLE").when(F.col("v").isNull(), "CONSENT_VARIABLE_NOT_IN_DATA_DICT")
    each = parsed.where("not bad").select("file", F.posexplode("v.value").alias("pos", "e")).select("file", "pos", consent_code(F.col("e._code")).alias("consent_code"), trimmed(F.col("e._VALUE")).alias("label"))
    labels = each.where("consent_code is not null and label <> ''").groupBy("file", "consent_code").agg(F.min_by("label", "pos").alias("label"))
    return labels, parsed.select("file", problem.alias("problem"))


def consent_columns(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``study_id, consent``: the name of the consent column in the header of each study's subject table."""
    _, heads = own_headers(spark, paths, "\t", comment="#")
    return heads.select(study_of().alias("study_id"), F.try_element_at("header", place_of(CONSENT).cast("int")).alias("consent"))
