"""Wide to long, unions, expansions, orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions import studies as S
from cohortflow.functions.cells import is_null_word, is_number, is_patient_cell, text_value, trimmed

#: The chromosomes of an index, and its path template and header.
CHROMOSOMES = [str(i) for i in range(1, 23)] + ["X"]
VCF_PATH = "data/vcfInput/{}.chr{}.annotated_remove_modifiers.hpds.vcf.gz"
VCF_HEADER = "vcf_path\tchromosome\tisAnnotated\tisGzipped\tsample_ids\tpatient_ids\tsample_relationship\trelated_sample_ids"


def cells(wide: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    """``keep, field, value``: one row for each field of a row."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return wide.select(*keep, F.explode(pairs).alias("_c")).select(*keep, "_c.field", "_c.value")


def to_concepts(wide: DataFrame, mapping: list[dict], patient: str, keep: list[str]) -> DataFrame:
    """``keep, patient, path, numeric, text`` of the cells that hold a value of their field's type.

    ``mapping``: ``field, path, type`` of the fields to take, a study's own, so it goes into the plan; fields
    that the frame lacks are passed over. Empty cells are dropped inside the row, before rows are made of them.
    """
    entries, used = [], [m for m in mapping if m["field"] in wide.columns]
    for i, m in enumerate(used):
        v = F.col(f"_v{i}")
        there = F.coalesce((v != "") & ~is_null_word(v), F.lit(False))
        numeric = m["type"] == "NUMERIC"
        if numeric:
            there = there & is_number(v)
        entry = F.struct(F.lit(m["path"]).alias("path"), (v if numeric else F.lit("")).alias("numeric"), (F.lit("") if numeric else text_value(v)).alias("text"))
        entries.append(F.when(there, entry))
    # Cells are trimmed once, before they are tested.
    rows = wide.where(is_patient_cell(F.col(patient)))
    rows = rows.select(*keep, trimmed(F.col(patient)).alias("patient"), *[trimmed(F.col(m["field"]).cast("string")).alias(f"_v{i}") for i, m in enumerate(used)])
    if not entries:
        return rows.limit(0).select(*keep, "patient", *[F.lit("").alias(c) for c in ("path", "numeric", "text")])
    rows = rows.select(*keep, "patient", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_e"))
    return rows.select(*keep, "patient", "_e.*")


def chromosomes(groups: DataFrame, group: str) -> DataFrame:
    """Each group's 23 index rows, in order: ``vcf_path, chromosome, n`` beside its columns."""
    each = groups.select("*", F.posexplode(F.array(*map(F.lit, CHROMOSOMES))).alias("n", "chromosome"))
    before, mid, after = VCF_PATH.split("{}")
    return each.withColumn("vcf_path", F.concat(F.lit(before), F.col(group), F.lit(mid), F.col("chromosome"), F.lit(after)))


def identity_rows(raw: DataFrame, column: str = "raw") -> DataFrame:
    """One row for each id in an identity cell."""
    return raw.withColumn("identity", F.explode(S.identities(F.col(column)))).drop(column)


def blank_identities(raw: DataFrame, column: str = "raw") -> DataFrame:
    return raw.agg(F.count_if(F.size(S.identities(F.col(column))) == 0).alias("blank_rows"))


def concept_entry(person: Column, path: Column, text: Column) -> Column:
    return F.struct(person.cast("string").alias("person_id"), path.alias("path"), F.lit("").alias("numeric"), text.alias("text"), F.lit("0").alias("timestamp"))


def global_concepts(studies: DataFrame, participants: DataFrame, consents: DataFrame, samples: DataFrame) -> DataFrame:
    """The five kinds of rows that every ready study contributes; studies without consents have none.

    A study that is listed twice contributes twice. The three kinds that a consent gives are made in one pass.
    """
    listed = studies.where("is_ready").groupBy("study_id").agg(F.count("*").alias("times"))
    own = consents.join(listed, "study_id")
    person = F.col("person_id")
    flag = F.concat(F.lit(S.STUDY_CONSENTS), F.col("study_id"), F.lit(S.SEP))
    short = F.coalesce("consent_abbreviation", F.lit(""))
    of_consent = F.array_compact(F.array(
        concept_entry(person, F.lit(S.CONSENTS), S.partition_name(F.col("study_id"), F.col("consent_code"))), concept_entry(person, flag, F.lit("TRUE")),
        F.when(F.trim(short) != "", concept_entry(person, F.concat(flag, short, F.lit(S.SEP)), F.lit("TRUE"))),
    ))
    members = own.select("study_id", "person_id", "times")
    people = members.join(participants, "person_id").select("study_id", "person_id", "source_id", "source", "times").distinct()
    tubes = members.join(samples, "person_id").select("study_id", "person_id", "source_sample_id", "sample_source", "times").distinct()

    def entries(df: DataFrame, made: Column) -> DataFrame:
        repeated = F.when(F.col("times") == 1, made).otherwise(F.flatten(F.array_repeat(made, F.col("times").cast("int"))))
        return df.select("study_id", F.explode(repeated).alias("_e")).select("study_id", "_e.*")

    return union(
        entries(own, of_consent),
        entries(people, F.array(concept_entry(person, F.lit(S.SUBJECT_ID), F.col("source_id")))),
        entries(tubes, F.array(concept_entry(person, F.lit(S.SAMPLE_ID), F.col("source_sample_id")))),
    )


def sample_sources(sstr: DataFrame) -> DataFrame:
    """``study_id, subject_id, source_sample_id, sample_source``: a row for each of a row's two sample ids that is there."""
    pairs = F.array(F.struct(F.col("dbgap_sample_id").alias("source_sample_id"), F.lit("DBGap").alias("sample_source")), F.struct(F.col("sample_id").alias("source_sample_id"), F.lit("submitted").alias("sample_source")))
    rows = sstr.select("study_id", "subject_id", F.explode(pairs).alias("s")).select("study_id", "subject_id", "s.*")
    return rows.where(F.trim(F.coalesce("source_sample_id", F.lit(""))) != "")


def union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def distinct_union(*frames: DataFrame) -> DataFrame:
    return union(*frames).distinct()


def minus(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, with ``side``: empty if both hold the same rows."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def consent_order(label: Column) -> list[Column]:
    """c2 before c10: shorter labels first."""
    return [F.length(label), label]


def largest_first(df: DataFrame, size: str, order: str) -> DataFrame:
    return df.orderBy(F.col(size).desc(), order)


def concatenated(spark, folder: str) -> DataFrame:
    """The lines of a folder's files in name order: ``name, line, value``, sorted. Every line ends by itself, so files join cleanly."""
    from cohortflow.operators.dedup import with_row_order

    rows = with_row_order(spark.read.text(folder), "place")
    return rows.select(F.element_at(F.split(F.col("place.file_path"), "/"), -1).alias("name"), "place", "value").orderBy("name", "place")
