"""Versions of tables and sets of files, with several writers."""

import os

import pytest

from cohortflow.operators import identity as I
from cohortflow.sources import sinks
from cohortflow.sources import store as ST

PEOPLE = "person_id long, source_id string, source string"
CONSENTS = "person_id long, study_id string, consent_code string, consent_abbreviation string"
SAMPLES = "person_id long, source_sample_id string, sample_source string"
SSTR = "ord int, study_id string, subject_id string, sample_id string, consent string, consent_abbreviation string, dbgap_subject_id string, dbgap_sample_id string"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def load(spark, sstr):
    """A change of a store that loads subject-sample rows."""

    def change(before):
        people, consents, samples = (before.get(t, spark.createDataFrame([], s)) for t, s in (("participants", PEOPLE), ("consents", CONSENTS), ("samples", SAMPLES)))
        p, c, s, _ = I.load_sstr(people, consents, samples, sstr)
        return I.changes(before, p, c, s, sstr)

    return change


def subjects(spark, study, *ids):
    return spark.createDataFrame([(i, study, f"s{d}", "", "1", "GRU", d, f"T{d}") for i, d in enumerate(ids)], SSTR)


def test_a_load_touches_its_study_alone(spark, tmp_path):
    root = str(tmp_path / "store")
    both = subjects(spark, "phs000001", "D1", "D2").unionByName(subjects(spark, "phs000002", "D2", "D3"))
    assert ST.write_changes(spark, root, load(spark, both)) == 1
    before = {p for d, _, fs in os.walk(root) for p in (os.path.join(d, f) for f in fs)}
    assert ST.write_changes(spark, root, load(spark, subjects(spark, "phs000002", "D3", "D9"))) == 2
    after = {p for d, _, fs in os.walk(root) for p in (os.path.join(d, f) for f in fs)}
    assert before <= after and not any("phs000001" in p for p in after - before)
    now, old = ST.tables(spark, root), ST.tables(spark, root, 1)
    assert rows(now["consents"], "study_id", "person_id") == [("phs000001", 1), ("phs000001", 2), ("phs000002", 3), ("phs000002", 4)]
    assert rows(old["consents"], "study_id", "person_id") == [("phs000001", 1), ("phs000001", 2), ("phs000002", 2), ("phs000002", 3)]
    assert rows(now["participants"], "person_id", "source_id") == [(1, "D1"), (2, "D2"), (3, "D3"), (4, "D9")] and now["samples"].count() == 4


def test_two_writers_never_take_the_same_number(spark, tmp_path):
    root, tried = str(tmp_path / "store"), []
    ST.write_changes(spark, root, load(spark, subjects(spark, "phs000001", "D1")))
    mine, other = load(spark, subjects(spark, "phs000002", "D5", "D6")), load(spark, subjects(spark, "phs000003", "D7", "D5"))

    def slow(before):
        out = mine(before)
        if not tried:  # another writer is done before this one is
            tried.append(ST.write_changes(spark, root, other))
        return out

    assert ST.write_changes(spark, root, slow) == 3 and tried == [2]
    people = ST.tables(spark, root)["participants"]
    assert people.select("person_id").distinct().count() == people.count() == 4 and people.select("source_id").distinct().count() == 4
    assert rows(ST.tables(spark, root)["consents"].groupBy("study_id").count(), "study_id", "count") == [("phs000001", 1), ("phs000002", 2), ("phs000003", 2)]
    assert len(os.listdir(f"{root}/data")) == 3  # what the lost try wrote is gone


def test_a_writer_gives_up_at_last(spark, tmp_path):
    root = str(tmp_path / "store")

    def late(content):
        ST.create_version(spark, root, ST.newest(spark, root) + 1, {"n": 1})
        return content

    with pytest.raises(ST.Conflict):
        ST.update(spark, root, late, tries=2)
    assert ST.newest(spark, root) == 2 and not [f for f in os.listdir(f"{root}/versions") if f.startswith(".") and not f.endswith(".crc")]


def test_many_additions_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "ADDITIONS", 2)
    root = str(tmp_path / "store")
    for i in range(4):
        ST.write_changes(spark, root, lambda before, i=i: {"t": ("append", spark.createDataFrame([(i,)], "x int"))})
    assert rows(ST.tables(spark, root)["t"], "x") == [(0,), (1,), (2,), (3,)]
    assert len(ST.read_version(spark, root, 4)["tables"]["t"]["folders"][""]) <= 2


def test_readers_see_whole_sets(spark, tmp_path):
    """A held-back group has no file in the new set, and a reader during a write sees the old one."""
    root, stage = str(tmp_path / "sets"), tmp_path / "staged"
    assert ST.read_set(spark, root).count() == 0

    def files(run, groups):
        df = spark.createDataFrame([(g, f"{run} {g}") for g in groups], "consent_group string, value string")
        df.repartition("consent_group").write.partitionBy("consent_group").text(str(stage / run))
        return sinks.written_files(spark, str(stage / run)).selectExpr("concat(consent_group, '.tsv') as name", "path")

    first = files("one", ["phs000001.c1", "phs000001.c2"])
    assert ST.publish_set(spark, root, first) == 1
    seen = ST.read_set(spark, root)
    second = files("two", ["phs000001.c1"])
    assert rows(ST.read_set(spark, root), "name") == [("phs000001.c1.tsv",), ("phs000001.c2.tsv",)]  # written, not yet named
    assert ST.publish_set(spark, root, second) == 2
    assert rows(ST.read_set(spark, root), "name") == [("phs000001.c1.tsv",)]
    text = spark.read.text([r["path"] for r in ST.read_set(spark, root).collect()])
    assert rows(text, "value") == [("two phs000001.c1",)] and rows(seen, "name") == rows(ST.read_set(spark, root, 1), "name")


def test_a_write_without_rows_is_an_empty_set(spark, tmp_path):
    """All groups held back: no partition folder tells of their column."""
    root, stage = str(tmp_path / "sets"), str(tmp_path / "stage")
    none = spark.createDataFrame([], "consent_group string, vcf_path string, chromosome string, sample_ids string, patient_ids string, n int")
    sinks.write_vcf_indexes(none, stage)
    assert sinks.written_lines(spark, stage, "consent_group").select("consent_group", "value").collect() == []
    ST.publish_set(spark, root, sinks.written_files(spark, stage, "consent_group").selectExpr("consent_group as name", "path"))
    assert ST.read_set(spark, root, 1).collect() == []
