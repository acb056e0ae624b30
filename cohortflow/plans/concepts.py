"""Concepts of a study, from its mapping and data files to its named concept files.

All data files are one scan of lines, each row parsed by its own file's header; what the mapping says of a file stands beside
its rows as one list. A first pass counts what the columns hold, a second makes concepts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import studies as S
from cohortflow.functions.cells import NULL_WORDS, NUMBER, names_patient, text_value
from cohortflow.operators import joins as J
from cohortflow.operators import reshape as R
from cohortflow.operators.identity import EmptyInput
from cohortflow.plans import gates as V
from cohortflow.sources import files as FI
from cohortflow.sources import sinks
from cohortflow.sources.own_headers import own_headers
from cohortflow.sources.scratch import new_path, written
from cohortflow.sources.streams import remove_files
from cohortflow.sources.study_files import read_concept_mapping

#: Where a row's own counts stand among those of its columns.
ROW = -1
CLASSES = ("written", "unmapped", "no_consent")


def held(value: Column) -> Column:
    """Whether a trimmed cell holds a value."""
    return F.coalesce((value != "") & ~F.lower(value).isin(*NULL_WORDS), F.lit(False))


def concepts_of_rows(rows: DataFrame, heads: DataFrame, mapping: DataFrame, participants: DataFrame, consents: DataFrame, study: str | None = None, only_written: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Concept rows with their ``class``, counts for each file, and the files that the mapping names and ``heads`` lacks.

    ``rows, heads``: of ``own_headers``, cells trimmed; ``mapping``: ``file, column, path, declared, patient_column``. A row that is wider or narrower
    than its header is malformed: it gives no concepts, but its cells count for the types, which are observed for each column of each file.
    Mapping rows of columns beyond a file's width are passed over. Rows: ``file, patient, path, numeric, text, study_id, consent_code,
    person_id, class`` (``CLASSES``); ``only_written``: those of other classes are counted, not kept. Counts: ``file, rows, malformed, not_patients, written, unmapped, no_consent, unmapped_ids``.
    """
    spark = rows.sparkSession
    heads = heads.select(F.col("file").alias("_at"), F.element_at(F.split("file", "/"), -1).alias("file"), F.size("header").alias("_width"))
    rows = rows.withColumnRenamed("file", "_at")
    used = written(mapping.join(heads, "file").where(F.greatest("column", "patient_column") < F.col("_width")).drop("_width", "_at"), "used-mapping")
    if used.isEmpty():
        raise EmptyInput("no mapping row names a column of a file that is there")

    def of_file(said: DataFrame) -> DataFrame:
        """Rows with what the mapping says of their file. That is a row, and small: broadcast, else a file's rows would meet in one task."""
        return rows.join(F.broadcast(heads.select("_at", "file").join(said, "file")), "_at")

    per_file = used.groupBy("file").agg(F.min("patient_column").alias("first"), F.collect_set("column").alias("columns"))
    wide = F.size("cells") != F.size("header")
    # What holds for a row is found before there is a row for each of its columns, and a cell is looked at once.
    own = of_file(per_file).select("file", wide.alias("wide"), (~names_patient(F.coalesce(F.get("cells", F.col("first")), F.lit("")))).alias("other"), "cells", F.concat("columns", F.array(F.lit(ROW))).alias("columns"))
    value = F.when(F.col("column") >= 0, F.get("cells", F.col("column")))
    each = own.select("file", "wide", "other", "cells", F.explode("columns").alias("column")).select("file", "column", "wide", "other", value.alias("v"))
    each = each.select("file", "column", "wide", "other", F.when(held(F.col("v")), F.when(F.col("v").rlike(NUMBER), "NUMERIC").otherwise("TEXT")).alias("kind"))
    seen = each.groupBy("file", "column").agg(
        F.count("*").alias("rows"), F.count_if("wide").alias("malformed"), F.count_if("other").alias("not_patients"), F.count("kind").alias("n_values"), F.count_if(F.col("kind") == "TEXT").alias("n_text"))
    seen = written(seen, "column-profile")

    typed = used.join(seen.where(F.col("column") >= 0).select("file", "column", "n_values", "n_text"), ["file", "column"], "left").where("n_values is null or n_values > 0")
    kind = F.when(F.col("n_values").isNull(), F.col("declared")).when(F.col("n_text") > 0, "TEXT").otherwise("NUMERIC")
    entries = typed.groupBy("file", "patient_column").agg(F.collect_list(F.struct("column", "path", (kind == "NUMERIC").alias("number"))).alias("entries"))

    def concept(e: Column) -> Column:
        return F.struct(e["path"].alias("path"), e["number"].alias("number"), F.coalesce(F.get("cells", e["column"]), F.lit("")).alias("v"))

    # A row meets its patient before concepts are made rows of their own. People are written first, so that their size is known: few, as a study's, need no shuffle of the rows.
    # A column is numeric only if the first pass found nothing but numbers in it, so its cells aren't tested again.
    made = F.filter(F.transform("entries", concept), lambda c: held(c["v"]))
    patient = F.coalesce(F.get("cells", F.col("patient_column")), F.lit(""))
    # Rows that give no concepts stay without any: a filter would have their cells parsed once more for it.
    cells = of_file(entries).select("file", patient.alias("patient"), F.when(~wide & names_patient(patient), made).alias("made"))
    people = written(J.consents_of_sources(participants, consents if study is None else J.of_study(consents, study)), "people")
    of = F.when(F.col("person_id").isNull(), "unmapped").when(F.col("consent_code").isNull(), "no_consent").otherwise("written")
    classed = J.to_sources(cells, people).select("file", "patient", "made", F.size("made").alias("n"), "study_id", "consent_code", "person_id", of.alias("class"))
    classed = written(classed.withColumn("made", F.when(F.col("class") == "written", F.col("made"))) if only_written else classed, "concepts")
    found = classed.withColumn("c", F.explode("made")).select("file", "patient", "c.path", F.when(F.col("c.number"), F.col("c.v")).otherwise("").alias("numeric"), F.when(F.col("c.number"), F.lit("")).otherwise(text_value(F.col("c.v"))).alias("text"), "study_id", "consent_code", "person_id", "class")

    per = classed.where("n > 0").groupBy("file").agg(*[F.sum(F.when(F.col("class") == k, F.col("n"))).alias(k) for k in CLASSES], F.count_distinct(F.when(F.col("class") == "unmapped", F.col("patient"))).alias("unmapped_ids"))
    sizes = heads.select("file").join(per_file.select("file"), "file").join(seen.where(F.col("column") == ROW).select("file", "rows", "malformed", "not_patients"), "file", "left")
    counts = sizes.join(per, "file", "left").select("file", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("rows", "malformed", "not_patients", *CLASSES, "unmapped_ids")])
    missing = mapping.select("file").distinct().join(heads.select("file"), "file", "left_anti")
    return found, counts, missing if not missing.isEmpty() else spark.createDataFrame([], "file string")


def concepts_of_files(spark: SparkSession, data: str, mapping: DataFrame, participants: DataFrame, consents: DataFrame, study: str | None = None, only_written: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``concepts_of_rows`` of the files of the folder ``data`` that the mapping names; others are not read."""
    there = FI.listing(spark, f"{data}/*").select("path", F.element_at(F.split("path", "/"), -1).alias("file"))
    paths = [r["path"] for r in there.join(mapping.select("file").distinct(), "file").select("path").collect()]
    rows, heads = own_headers(spark, paths, ",", quoted=True, trim=True)
    return concepts_of_rows(rows, heads, mapping, participants, consents, study, only_written)


def generate_concepts(spark: SparkSession, study: str, data: str, mapping: str, participants: DataFrame, consents: DataFrame, output: str, files_per_group: int = 1) -> dict[str, DataFrame]:
    """A study's concept files below ``output`` from its data files and mapping file, and what to tell of it.

    Each consent group's rows are written to the name that readers look for. A file that an earlier run left for a group without rows now
    is removed, unless a file that the mapping names is missing, which may be why; then all such files stay. No row at all, or a row that
    ``row_violation`` does not allow, is an error, and nothing is written or removed. Returns ``counts`` (for each file), ``groups`` (``consent_code, rows, people``), ``missing``, ``dropped`` (mapping rows),
    ``stale`` (``path, removed``) and ``checks`` (``severity, code``), which the published set passed.
    """
    own = J.of_study(consents, study)
    if own.isEmpty():
        raise EmptyInput(f"{study} has no consents")
    people = participants.join(own.select("person_id").distinct(), "person_id", "left_semi")
    if people.isEmpty():
        raise EmptyInput(f"{study} has no participants")
    good, dropped = read_concept_mapping(spark, mapping)
    rows, counts, missing = concepts_of_files(spark, data, good, people, own, only_written=True)
    counts = written(counts, "concept-counts")
    kept = written(rows, "own-concepts")
    groups = written(kept.groupBy("consent_code").agg(F.count("*").alias("rows"), F.count_distinct("person_id").alias("people")), "concept-groups")
    there = FI.listing(spark, f"{output}/{study}/allConcepts/c*/{study}_allConcepts_c*.csv").select("path", F.regexp_extract("path", "/c([^/]+)/[^/]+$", 1).alias("consent_code"))
    old = written(there.join(groups.select("consent_code"), "consent_code", "left_anti").select("path"), "stale")
    totals = counts.selectExpr("stack(4, 'written', written, 'unmapped', unmapped, 'no_consent', no_consent, 'malformed', malformed) as (class, rows)").groupBy("class").agg(F.sum("rows").alias("rows"))
    bad = kept.where(S.row_violation(F.col("person_id").cast("string"), F.col("path"), F.col("numeric"), F.col("text")).isNotNull()).limit(1)
    checks = written(V.concept_checks(totals, missing, old).unionByName(bad.select(F.lit("ERROR").alias("severity"), F.lit("BAD_CONCEPT_ROWS").alias("code"))), "concept-checks")
    told = {"counts": counts, "groups": groups, "missing": missing, "dropped": dropped, "checks": checks}
    if not checks.where("severity = 'ERROR'").isEmpty():
        return told | {"stale": old.select("path", F.lit(False).alias("removed"))}
    stage = new_path(spark, "concept-files")
    sinks.write_concepts(kept.withColumns({"person_id": F.col("person_id").cast("string"), "timestamp": F.lit("0")}), stage, files_per_group)
    files = sinks.publish_concepts(spark, stage, output)
    if not groups.count() <= files <= groups.count() * files_per_group:
        raise OSError(f"{study}: {files} files for {groups.count()} consent groups")
    keep = not missing.isEmpty()
    if keep:
        return told | {"stale": old.select("path", F.lit(False).alias("removed"))}
    return told | {"stale": written(remove_files(old), "removed").select("path", F.col("error").isNull().alias("removed"))}
