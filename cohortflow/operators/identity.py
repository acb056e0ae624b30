"""Keeping the identity tables: participants, consents and samples as snapshots that are replaced whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.functions.cells import trimmed
from cohortflow.functions.studies import consent_code as usable_code
from cohortflow.operators.aggregates import first_examples
from cohortflow.operators.dedup import first_per_key, last_per_key
from cohortflow.operators.joins import new_ids
from cohortflow.operators.reshape import sample_sources, union
from cohortflow.sources.scratch import written

#: Ids numbered in one task at a time.
RUN = 1 << 16


class EmptyInput(ValueError):
    """A load without subjects, which would have emptied a study."""


def dense_numbers(ids: DataFrame, order: str, out: str) -> DataFrame:
    """Numbers from 1 in order of a column, by ranges: only one row for each range is numbered in one task."""
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranges")  # drawn from a sample, they must be the same for both uses below
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    base = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return ranged.withColumn("_local", local).join(F.broadcast(base), "_part").withColumn(out, F.col("_base") + F.col("_local")).drop("_part", "_local", "_base")


def resolve_or_create(participants: DataFrame, ids: DataFrame, source: str) -> DataFrame:
    """The table with a row for every id of ``ids``: known ones keep theirs, new ones get the next numbers in sorted order."""
    new = dense_numbers(new_ids(ids, participants, source), "source_id", "_n")
    top = participants.agg(F.coalesce(F.max("person_id"), F.lit(0).cast("long"))).head()[0]
    rows = new.select((F.col("_n") + top).alias("person_id"), "source_id", F.lit(source).alias("source"))
    return participants.select("person_id", "source_id", "source").unionByName(rows)


def lookup_ids(participants: DataFrame, ids: DataFrame, source: str) -> DataFrame:
    return ids.select("source_id").distinct().join(participants.where(F.col("source") == source).select("source_id", "person_id"), "source_id")


def purge_and_reload(consents: DataFrame, study: str | None, new: DataFrame) -> DataFrame:
    """A study's consents replaced; refused when there is nothing to put in their place. Without ``study``, those of all studies in ``new``."""
    if study is None:
        return consents.join(new.select("study_id").distinct(), "study_id", "left_anti").select(*new.columns).unionByName(new).select(*consents.columns)
    if new.isEmpty():
        raise EmptyInput(f"{study}: no subjects in the new input; its consents stay")
    return consents.where(F.col("study_id") != study).unionByName(new.select(*consents.columns))


def upsert_consents(consents: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """Consents with ``new`` put in or over those of the same person and study; of repeats the last counts."""
    latest = last_per_key(new, ["person_id", "study_id"], order).drop(order)
    return consents.join(latest.select("person_id", "study_id"), ["person_id", "study_id"], "left_anti").unionByName(latest.select(*consents.columns))


def insert_samples(samples: DataFrame, new: DataFrame) -> DataFrame:
    return samples.unionByName(new.select(*samples.columns)).dropDuplicates()


def of_studies(df: DataFrame, study: str | None) -> DataFrame:
    return df if study is None else df.withColumn("study_id", F.lit(study))


def load_sstr(participants: DataFrame, consents: DataFrame, samples: DataFrame, sstr: DataFrame, study: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Subject and sample rows loaded into the three tables; the fourth frame is a row of counts for each study.

    ``sstr``: ``ord, subject_id, sample_id, consent, consent_abbreviation, dbgap_subject_id, dbgap_sample_id`` of
    ``study``, or with ``study_id`` of several. A subject's first row gives its consent. No table is changed here: the
    caller swaps all three snapshots or none.
    """
    sstr = of_studies(sstr, study)
    first = first_per_key(sstr.select("study_id", "dbgap_subject_id", "consent", "consent_abbreviation", "ord"), ["study_id", "dbgap_subject_id"], "ord")
    first = written(first, "first-rows")  # a row for each subject, which all three tables and the counts need
    ids = first.select(F.col("dbgap_subject_id").alias("source_id"))
    people = resolve_or_create(participants, ids, "DBGap")
    known = lookup_ids(people, ids, "DBGap")
    rows = first.join(known, first["dbgap_subject_id"] == known["source_id"])
    new = rows.select("person_id", "study_id", F.col("consent").alias("consent_code"), "consent_abbreviation")
    tubes = sample_sources(sstr.withColumn("subject_id", F.col("dbgap_subject_id")))
    tubes = tubes.join(known, tubes["subject_id"] == known["source_id"]).select("study_id", "person_id", "source_sample_id", "sample_source").distinct()
    key = ["person_id", "source_sample_id", "sample_source"]
    fresh = first.withColumnRenamed("dbgap_subject_id", "source_id").join(participants.where("source = 'DBGap'").select("source_id"), "source_id", "left_anti")
    counted = {
        "rows_read": sstr, "distinct_participants": first, "participants_inserted": fresh, "consents_written": new,
        "consents_purged": consents.join(first.select("study_id").distinct(), "study_id", "left_semi"), "consent_groups": new.select("study_id", "consent_code").distinct(),
        "samples_seen": tubes, "samples_inserted": tubes.join(samples.select(*key).distinct(), key, "left_anti"),
    }
    each = union(*[df.groupBy("study_id").agg(F.count("*").alias("n")).select("study_id", F.lit(name).alias("name"), "n") for name, df in counted.items()])
    counts = each.groupBy("study_id").agg(*[F.coalesce(F.max(F.when(F.col("name") == name, F.col("n"))), F.lit(0).cast("long")).alias(name) for name in counted])
    return people, purge_and_reload(consents, study, new), insert_samples(samples, tubes.select(*key)), counts


def load_multi(participants: DataFrame, consents: DataFrame, samples: DataFrame, subjects: DataFrame, tubes: DataFrame, decodings: DataFrame, study: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Subject and sample tables loaded; the fourth frame is their issues (``study_id, code, count, examples``, ten at most).

    ``subjects``: ``ord, dbgap_id, subject_id, code``; ``tubes``: ``ord, subject_id`` (the repository's),
    ``dbgap_sample_id, sample_id``; ``decodings``: ``consent_code, label``; all of ``study``, or with ``study_id`` of several.
    """
    from cohortflow.operators.dedup import first_usable_consent
    from cohortflow.operators.joins import decoded_consents, samples_of_subjects

    subjects, tubes, decodings = (of_studies(df, study) for df in (subjects, tubes, decodings))
    subjects = subjects.where(trimmed(F.coalesce("dbgap_id", F.lit(""))) != "")
    yes, no = first_usable_consent(subjects, ["study_id", "dbgap_id"], "code", "ord")
    coded = yes.select("study_id", "dbgap_id", F.col("code").alias("consent_code"), "conflicts")
    named = decoded_consents(coded, decodings)
    ids = yes.select(F.col("dbgap_id").alias("source_id"))
    people = resolve_or_create(participants, ids, "DBGap")
    known = lookup_ids(people, ids, "DBGap")
    new = named.join(known, named["dbgap_id"] == known["source_id"]).select("person_id", "study_id", "consent_code", "consent_abbreviation")
    classed = samples_of_subjects(tubes, *[df.select("study_id", F.col("dbgap_id").alias("subject_id")) for df in (coded, no)])
    rows = sample_sources(classed.where("subject_class = 'consented'").select("study_id", "subject_id", "dbgap_sample_id", "sample_id"))
    rows = rows.join(known, rows["subject_id"] == known["source_id"]).select("person_id", "source_sample_id", "sample_source")

    def counted(df: DataFrame, code: Column | str, example: Column, order: str) -> DataFrame:
        each = df.select("study_id", (F.lit(code) if isinstance(code, str) else code).alias("code"), example.alias("example"), F.col(order).alias("o"))
        return first_examples(each, ["study_id", "code"], "example", "o", 10)

    odd = subjects.withColumn("_code", usable_code(F.col("code"))).join(coded.where("conflicts > 0").select("study_id", "dbgap_id", "consent_code"), ["study_id", "dbgap_id"])
    odd = odd.where("_code <> '0' and _code <> consent_code")
    issues = union(
        counted(named.where("issue is not null").select("study_id", "consent_code", "issue").distinct(), F.col("issue"), F.col("consent_code"), "consent_code"),
        counted(odd, "CONSENT_CONFLICT", F.concat("dbgap_id", F.lit("="), "consent_code", F.lit("/"), "_code"), "ord"),
        counted(no, "SUBJECTS_NOT_CONSENTED", F.col("dbgap_id"), "dbgap_id"),
        counted(classed.where("subject_class = 'not_consented'"), "SAMPLES_OF_UNCONSENTED_SUBJECTS", F.col("subject_id"), "ord"),
        counted(classed.where("subject_class = 'unknown'"), "SAMPLES_OF_UNKNOWN_SUBJECTS", F.col("subject_id"), "ord"),
    )
    return people, purge_and_reload(consents, study, new), insert_samples(samples, rows), issues


def changes(before: dict[str, DataFrame], people: DataFrame, consents: DataFrame, samples: DataFrame, studies: DataFrame) -> dict[str, tuple[str, DataFrame]]:
    """What a load changes in the three tables, for ``store.write_changes``: new people and samples are added, the loaded ``studies``' consents replaced.

    ``people, consents, samples``: the tables after the load.
    """
    own = consents.join(studies.select("study_id").distinct(), "study_id", "left_semi").select(*consents.columns)
    if not before:
        return {"participants": ("whole", people), "consents": ("studies", consents), "samples": ("whole", samples)}
    key = ["person_id", "source_sample_id", "sample_source"]
    return {
        "participants": ("append", people.join(before["participants"].select("person_id"), "person_id", "left_anti").select(*people.columns)),
        "consents": ("studies", own), "samples": ("append", samples.join(before["samples"].select(*key), key, "left_anti").select(*samples.columns)),
    }
