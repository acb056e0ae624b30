"""Equi-joins of studies, people, consents, samples, files and reports.

No side is broadcast by name unless its rows are counted by a setting (ranges, stages): which sides are small is
left to Spark, which checks their sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def study_participants(participants: DataFrame, consents: DataFrame) -> DataFrame:
    """Distinct ``study_id, person_id, source_id, source`` of people with a consent, for all studies at once."""
    return consents.select("study_id", "person_id").join(participants, "person_id").select("study_id", "person_id", "source_id", "source").distinct()


def study_samples(samples: DataFrame, consents: DataFrame) -> DataFrame:
    """Distinct ``study_id, person_id, source_sample_id, sample_source``."""
    return consents.select("study_id", "person_id").join(samples, "person_id").select("study_id", "person_id", "source_sample_id", "sample_source").distinct()


def person_of_source(participants: DataFrame) -> DataFrame:
    """One person for each source id, over all sources: the highest id."""
    return participants.groupBy("source_id").agg(F.max("person_id").alias("person_id"))


def to_people(cells: DataFrame, participants: DataFrame, patient: str = "patient") -> DataFrame:
    """Cells with ``person_id``, null where the patient is not known."""
    people = person_of_source(participants).withColumnRenamed("source_id", "_patient")
    return cells.join(people, F.trim(F.col(patient)) == F.col("_patient"), "left").drop("_patient")


def to_consents(rows: DataFrame, consents: DataFrame) -> DataFrame:
    """Rows with ``study_id`` and ``consent_code`` of their person, null where there is none."""
    return rows.join(consents.select("person_id", "study_id", "consent_code"), "person_id", "left")


def consents_of_sources(participants: DataFrame, consents: DataFrame) -> DataFrame:
    """``source_id, person_id, study_id, consent_code``: each source id's person, with their consents, null where there is none."""
    return to_consents(person_of_source(participants), consents)


def to_sources(rows: DataFrame, own: DataFrame, patient: str = "patient") -> DataFrame:
    """Rows with what ``consents_of_sources`` says of their patient, null where the patient is not known."""
    return rows.join(own.withColumnRenamed("source_id", "_patient"), F.trim(F.col(patient)) == F.col("_patient"), "left").drop("_patient")


def with_consents(rows: DataFrame, participants: DataFrame, consents: DataFrame, patient: str = "patient") -> DataFrame:
    """``to_people`` and ``to_consents`` in one join: rows, which are many, are shuffled once, by their patient."""
    return to_sources(rows, consents_of_sources(participants, consents), patient)


def missing_files(mapping: DataFrame, files: DataFrame) -> DataFrame:
    """Files that a mapping names and the inventory lacks."""
    return mapping.select("file").distinct().join(files.select("file"), "file", "left_anti")


def rekeyed(rows: DataFrame, id_mapping: DataFrame) -> DataFrame:
    """Rows with the new id of their old one, null where the mapping has none."""
    return rows.join(id_mapping.select("old_id", "person_id"), "old_id", "left")


def resolve_patients(mapping: DataFrame, loaded: DataFrame, subjects: DataFrame, not_consented: DataFrame, participants: DataFrame) -> DataFrame:
    """``study_id, id, old_id, dbgap_id, person_id, resolution`` of patient mapping rows.

    An id is a loaded repository id, else a subject's own id, else one of a subject without consent. ``loaded``:
    ``study_id, dbgap_id``; ``subjects``: ``study_id, subject_id, dbgap_id``; ``not_consented``: ``study_id, subject_id``.
    """
    direct = loaded.select("study_id", F.col("dbgap_id").alias("id"), F.col("dbgap_id").alias("_direct")).distinct()
    own = subjects.groupBy("study_id", F.col("subject_id").alias("id")).agg(F.min("dbgap_id").alias("_own"))
    none = not_consented.select("study_id", F.col("subject_id").alias("id"), F.lit(True).alias("_none")).distinct()
    people = participants.where("source = 'DBGap'").groupBy(F.col("source_id").alias("dbgap_id")).agg(F.max("person_id").alias("person_id"))
    rows = mapping.join(direct, ["study_id", "id"], "left").join(own, ["study_id", "id"], "left").join(none, ["study_id", "id"], "left")
    rows = rows.withColumn("dbgap_id", F.coalesce("_direct", "_own")).join(people, "dbgap_id", "left")
    kind = (
        F.when(F.col("person_id").isNotNull(), "mapped").when(F.col("dbgap_id").isNotNull(), "no_participant")
        .when(F.coalesce("_none", F.lit(False)), "not_consented").otherwise("not_in_file")
    )
    return rows.select("study_id", "id", "old_id", "dbgap_id", "person_id", kind.alias("resolution"))


def samples_of_subjects(samples: DataFrame, consented: DataFrame, not_consented: DataFrame) -> DataFrame:
    """Samples with ``subject_class``: consented, not_consented or unknown."""
    yes = consented.select("study_id", "subject_id").distinct().withColumn("_yes", F.lit(True))
    no = not_consented.select("study_id", "subject_id").distinct().withColumn("_no", F.lit(True))
    rows = samples.join(yes, ["study_id", "subject_id"], "left").join(no, ["study_id", "subject_id"], "left")
    return rows.withColumn("subject_class", F.when(F.col("_yes"), "consented").when(F.col("_no"), "not_consented").otherwise("unknown")).drop("_yes", "_no")


def decoded_consents(codes: DataFrame, decodings: DataFrame) -> DataFrame:
    """Codes with ``consent_abbreviation`` and ``issue``: none, CONSENT_CODE_NOT_DECODED or CONSENT_LABEL_WITHOUT_ABBREVIATION."""
    from cohortflow.functions.studies import abbreviation

    # The codes of the two issues.
    rows = codes.join(decodings.select("study_id", "consent_code", "label"), ["study_id", "consent_code"], "left")
    short = abbreviation(F.col("label"))
    return rows.withColumn("consent_abbreviation", F.when(F.col("label").isNull(), "").when(short == "", F.col("label")).otherwise(short)).withColumn(
        "issue", F.when(F.col("label").isNull(), "CONSENT_CODE_NOT_DECODED").when(short == "", "CONSENT_LABEL_WITHOUT_ABBREVIATION")).drop("label")


def ready(studies: DataFrame, processed: bool = True) -> DataFrame:
    """Studies that are ready; without those processed, unless asked for."""
    return studies.where("is_ready") if processed else studies.where("is_ready and not is_processed")


def of_ready(studies: DataFrame, facts: DataFrame, repeat: bool = False) -> DataFrame:
    """Facts of ready studies. A study that is listed twice counts twice only with ``repeat``."""
    ids = ready(studies).select("study_id")
    return (ids if repeat else ids.distinct()).join(facts, "study_id")


def of_study(df: DataFrame, study: str) -> DataFrame:
    """One study's rows: a partition filter where tables are stored by study."""
    return df.where(F.col("study_id") == study)


def new_ids(ids: DataFrame, participants: DataFrame, source: str) -> DataFrame:
    """Source ids without a participant of that source."""
    known = participants.where(F.col("source") == source).select("source_id")
    return ids.select("source_id").distinct().join(known, "source_id", "left_anti")


def stale(existing: DataFrame, written: DataFrame, keys: list[str]) -> DataFrame:
    """Outputs there are that this run did not write."""
    return existing.join(written.select(*keys).distinct(), keys, "left_anti")


def not_ready(requested: DataFrame, studies: DataFrame) -> DataFrame:
    return requested.select("study_id").distinct().join(ready(studies).select("study_id"), "study_id", "left_anti")


def to_resume(studies: DataFrame, prior: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Studies still to do, and earlier results that stand: of the same data folder, with mapped rows and their file."""
    stands = prior.where((F.col("data_folder") == folder) & (F.col("mapping_rows") > 0) & F.col("has_mapping_file"))
    return studies.join(stands.select("study_id"), "study_id", "left_anti"), stands.withColumn("issue", F.lit("REUSED"))
