"""Bytes in order, files by their own headers, and merges of folders."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import aggregates as A
from cohortflow.plans import jobs as K
from cohortflow.plans import migration as M
from cohortflow.sources import files as FI
from cohortflow.sources import own_headers as H
from cohortflow.sources import streams as ST

KEYS = ["study_id", "label"]
RECORDED = "study_id string, label string, recorded_fingerprint string, recorded_md5 string"


def put(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_digests_in_chunks(spark, tmp_path):
    data = {"a": b"", "b": os.urandom(100_001), "c": b"line\r\nno end"}
    paths = {n: put(tmp_path, n, d) for n, d in data.items()}
    df = spark.createDataFrame([(f"file://{p}",) for p in paths.values()] + [(f"file://{tmp_path}/gone",)], "path string")
    got = {r["path"].rsplit("/")[-1]: r for r in ST.md5_of_files(df, chunk=1000).collect()}
    assert all(got[n]["md5"] == hashlib.md5(d).hexdigest() and got[n]["bytes"] == len(d) for n, d in data.items())
    assert got["gone"]["md5"] is None and "FileNotFoundError" in got["gone"]["error"]


@pytest.mark.parametrize("name", ["at=legacy%2Fdata%2Fa.csv", "a b.csv", "ä#?&[1].csv", "100%.csv"])
def test_names_stand_for_themselves(spark, tmp_path, name):
    at = put(tmp_path, name, "x")
    assert ST.md5_of_files(spark.createDataFrame([(f"file:{at}",)], "path string")).head()["md5"] == hashlib.md5(b"x").hexdigest()
    moved = spark.createDataFrame([(f"file:{at}", f"file://{tmp_path}/to/{name}")], "path string, to string")
    assert ST.move(moved).head()["error"] is None and (tmp_path / "to" / name).read_text() == "x" and not os.path.exists(at)
    assert ST.remove_files(spark.createDataFrame([(f"{tmp_path}/to/{name}",)], "path string")).head()["error"] is None and not (tmp_path / "to" / name).exists()


def test_bytes_are_put_together_as_they_are(spark, tmp_path):
    a, b, c = (put(tmp_path, n, d) for n, d in (("1", b"x\r\ny"), ("2", b""), ("3", b"z\n\n")))
    target = tmp_path / "out" / "all.csv"
    put(tmp_path, "out/kept.csv", "before")
    files = [(str(target), a, 1), (str(target), b, 2), (str(target), c, 3), (str(tmp_path / "out" / "kept.csv"), a, 1), (str(tmp_path / "out" / "kept.csv"), str(tmp_path / "gone"), 2)]
    got = {r["target"]: r for r in ST.merge_bytes(spark.createDataFrame(files, "target string, path string, o int"), "target", "path", "o", 1).collect()}
    assert target.read_bytes() == b"x\r\ny\nz\n\n" and got[str(target)]["md5"] == hashlib.md5(target.read_bytes()).hexdigest() and got[str(target)]["bytes"] == 8
    assert got[files[3][0]]["error"] and (tmp_path / "out" / "kept.csv").read_text() == "before"
    assert sorted(os.listdir(tmp_path / "out")) == [".all.csv.crc", "all.csv", "kept.csv"] or sorted(f for f in os.listdir(tmp_path / "out") if not f.endswith(".crc")) == ["all.csv", "kept.csv"]


def test_fingerprint_gathers_nothing(spark):
    files = spark.createDataFrame([("s", "c1", f"f{i:03}", f"v{i}", i) for i in range(300)] + [("s", "c2", "f", "v", 5), (None, "c2", "f", "w", 7)], "study_id string, label string, name string, version_id string, size long")
    out = A.fingerprint(files, KEYS)
    got = {(r["study_id"], r["label"]): (r["fingerprint"], r["sources"], r["bytes"]) for r in out.where("study_id is not null").collect()}
    assert got["s", "c1"] == (hashlib.sha256("".join(f"f{i:03}\tv{i}\n" for i in range(300)).encode()).hexdigest(), 300, sum(range(300)))
    assert got["s", "c2"][0] == hashlib.sha256(b"f\tv\n").hexdigest()
    plan = K.merge_plan(K.consent_folders(files))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "collect_set" not in plan


def test_digest_of_joined_lines(spark):
    rows = spark.createDataFrame([("a", x) for x in ("z", "ä", "", "b", "b")] + [("b", "x")], "k string, v string")
    got = {r["k"]: r["fingerprint"] for r in ST.digest_of_lines(rows, ["k"], "v", "v", "md5", "\n").collect()}
    assert got == {"a": hashlib.md5("\nb\nb\nz\nä".encode()).hexdigest(), "b": hashlib.md5(b"x").hexdigest()}


def test_concatenated_sources_gathers_no_group(spark, sf_dir):
    from cohortflow.plans.file_queries import concatenated_sources

    assert "collect_list" not in concatenated_sources(spark, sf_dir)._jdf.queryExecution().toString()


def folder(study, label):
    return f"{study}/allConcepts/{label}"


def test_a_merge_run(spark, tmp_path):
    def source(study, label, name, data):
        return put(tmp_path, f"{folder(study, label)}/{study}_allConcepts_{name}.csv", data)

    def merged(study, label):
        return tmp_path / folder(study, label) / f"{study}_{label}_allConcepts_MERGED.csv"

    source("phs000001", "c1", "b", "2\n")
    source("phs000001", "c1", "a", "1")
    source("phs000001", "c2", "a", "only\n")
    bad = source("phs000002", "c1", "a", "x\n")
    source("phs000002", "c2", "a", "y\n")
    put(tmp_path, f"{folder('phs000003', 'c1')}/notes.txt", "-")
    none = spark.createDataFrame([], RECORDED)

    first, recorded = K.merge_run(spark, str(tmp_path), none)
    assert rows(first, "study_id", "label", "action", "files_merged") == [("phs000001", "c1", "MISSING", 2), ("phs000001", "c2", "MISSING", 1), ("phs000002", "c1", "MISSING", 1), ("phs000002", "c2", "MISSING", 1), ("phs000003", "c1", "NO_SOURCES", 0)]
    assert merged("phs000001", "c1").read_text() == "1\n2\n"
    assert {(r["study_id"], r["label"]): r["recorded_md5"] for r in recorded.collect()}["phs000001", "c1"] == hashlib.md5(b"1\n2\n").hexdigest()

    # One folder changes, one loses its sources, one has a source that can't be read, one is up to date.
    source("phs000001", "c1", "c", "3\n")
    os.remove(tmp_path / folder("phs000001", "c2") / "phs000001_allConcepts_a.csv")
    source("phs000002", "c1", "b", "more\n")
    os.remove(bad)
    os.symlink(tmp_path / "nowhere", bad)
    stamp = merged("phs000002", "c2").stat().st_mtime_ns
    asked = []
    again = K.merge_files
    files = FI.file_inventory(spark, str(tmp_path))
    plan = K.merge_plan(K.consent_folders(files, recorded))
    assert rows(plan.where("merge"), *KEYS) == [("phs000001", "c1"), ("phs000002", "c1")]
    second, recorded = K.merge_run(spark, str(tmp_path), recorded)
    got = {(r["study_id"], r["label"]): r for r in second.collect()}
    assert got["phs000001", "c1"]["action"] == "SOURCES_CHANGED" and merged("phs000001", "c1").read_text() == "1\n2\n3\n"
    assert got["phs000001", "c2"]["action"] == "REMOVED_NO_SOURCES" and not merged("phs000001", "c2").exists()
    assert got["phs000002", "c2"]["action"] == "UP_TO_DATE" and merged("phs000002", "c2").stat().st_mtime_ns == stamp
    assert got["phs000002", "c1"]["action"] in ("FAILED", "SOURCES_CHANGED")
    assert asked == [] and again is K.merge_files
    assert ("phs000001", "c2") not in rows(recorded, *KEYS)


def test_a_source_that_goes_away_fails_its_folder_alone(spark, tmp_path):
    files = spark.createDataFrame(
        [("phs000001", "c1", "phs000001_allConcepts_a.csv", put(tmp_path, "a", "a\n")), ("phs000001", "c2", "phs000001_allConcepts_b.csv", str(tmp_path / "gone")), ("phs000001", "c3", "phs000001_allConcepts_c.csv", str(tmp_path / "gone"))],
        "study_id string, label string, name string, key string")
    plan = spark.createDataFrame([("phs000001", "c1", True), ("phs000001", "c2", True), ("phs000001", "c3", False)], "study_id string, label string, merge boolean")
    got = {r["label"]: r for r in K.merge_files(files, plan, str(tmp_path / "out")).collect()}
    assert got["c1"]["error"] is None and "FileNotFoundError" in got["c2"]["error"] and "c3" not in got


def test_a_merged_file_that_changed_meanwhile_stays(spark, tmp_path, monkeypatch):
    at = put(tmp_path, f"{folder('phs000001', 'c1')}/phs000001_c1_allConcepts_MERGED.csv", "old\n")
    plain = K.listing

    def late(session, *globs):
        with open(at, "a") as f:
            f.write("new\n")
        return plain(session, *globs)

    monkeypatch.setattr(K, "listing", late)
    told, _ = K.merge_run(spark, str(tmp_path), spark.createDataFrame([], RECORDED))
    assert rows(told, "action") == [("CHANGED_DURING_RUN",)] and os.path.exists(at)


@pytest.mark.parametrize("sep", [",", "\t"])
def test_quoted_cells(spark, sep):
    lines = {'a,b,c': ["a", "b", "c"], ',,': ["", "", ""], '"a,b",c': ["a,b", "c"], '"say ""x""",,"" ': ['say "x"', "", ""], 'a"b,"c': ['a"b', '"c'], "": [""], '"x"y,z': ["x", "z"]}
    df = spark.createDataFrame([(k.replace(",", sep), [v.replace(",", sep) for v in vs]) for k, vs in lines.items()], "line string, want array<string>")
    assert df.where(H.quoted_cells(F.col("line"), sep) != F.col("want")).count() == 0


def test_verdicts_of_files(spark, tmp_path):
    head = "SUBJECT_ID\tCONSENT\tconsent_abbreviation\tdbgap_subject_id\tdbgap_sample_id\n"
    texts = {"good": head + 'a\t1\tGRU\t"1"\t\n', "blank": head + "a\t1\tGRU\t1\t2\nb\t\tGRU\t2\t2\n", "lacks": "SUBJECT_ID\nx\n", "none": head, "empty": ""}
    paths = [put(tmp_path, f"phs000001/rawData/{n}", t) for n, t in texts.items()]
    found, verdict = H.sstr_files(spark, paths)
    assert {r["file"].rsplit("/")[-1]: r["problem"] for r in verdict.collect()} == {"good": None, "blank": "BLANK_CONSENT", "lacks": "NO_COLUMN_CONSENT", "none": "NO_ROWS"}
    assert rows(found.where("file like '%good'"), "dbgap_subject_id", "dbgap_sample_id") == [("1", "")]
    texts = {"good": "# c\nother\tSUBJID\tgencons\tdbGaP SubjID\nx\ts\t2\t1\n", "wide": "dbGaP_Subject_ID\tconsent\n1\t1\t1\n", "zero": "dbGaP_Subject_ID\tconsent\n1\t0\n2\tx\n"}
    found, verdict = H.subject_files(spark, [put(tmp_path, f"s/rawData/{n}", t) for n, t in texts.items()])
    assert {r["file"].rsplit("/")[-1]: r["problem"] for r in verdict.collect()} == {"good": None, "wide": "ROW_TOO_WIDE", "zero": "NOBODY_CONSENTED"}
    assert rows(found.where("file like '%good'"), "dbgap_id", "subject_id", "code") == [("1", "s", "2")]
    assert H.sstr_files(spark, [])[0].count() == 0
    xml = {"good": '<t><variable><name> CONSENT </name><value code="01">A (B)</value><value code="1">late</value><value code="2"> </value></variable></t>', "doctype": "<!DOCTYPE x><t/>", "bad": "<t><variable>", "other": "<t><variable><name>x</name></variable></t>"}
    consents = spark.createDataFrame([(n, "consent") for n in xml], "study_id string, consent string")
    labels, verdict = H.decoding_files(spark, [put(tmp_path, f"{n}/rawData/d.xml", t) for n, t in xml.items()], consents)
    assert rows(labels, "consent_code", "label") == [("1", "A (B)")]
    assert {r["file"].split("/")[-3]: r["problem"] for r in verdict.collect()} == {"good": None, "doctype": "DATA_DICT_UNREADABLE", "bad": "DATA_DICT_UNREADABLE", "other": "CONSENT_VARIABLE_NOT_IN_DATA_DICT"}


def test_files_are_moved_by_tasks(spark, tmp_path):
    a, b = put(tmp_path, "a", "1"), put(tmp_path, "b", "2")
    to = [str(tmp_path / "out" / n) for n in "xyz"]
    put(tmp_path, "out/x", "old")
    put(tmp_path, "out/.x.crc", "of the old one")
    files = spark.createDataFrame([(a, to[0]), (b, to[1]), (str(tmp_path / "gone"), to[2])], "path string, to string")
    got = {r["to"]: r["error"] for r in ST.move(files).collect()}
    assert got[to[0]] is None and got[to[1]] is None and got[to[2]]
    assert [(tmp_path / "out" / n).read_text() for n in "xy"] == ["1", "2"] and not (tmp_path / "out/.x.crc").exists()
    again = ST.move(files.where("path like '%/a'")).collect()  # a task that is run again
    assert again[0]["error"] is None and (tmp_path / "out/x").read_text() == "1"


def test_files_are_dealt_to_several_tasks(spark):
    paths = spark.createDataFrame([(f"/f{i}",) for i in range(12)], "path string")
    assert ST.dealt(paths, "path").rdd.getNumPartitions() == 48
    assert ST.dealt(paths.limit(0), "path").rdd.getNumPartitions() == 1


def test_a_files_rows_stay_spread_over_tasks(spark, tmp_path):
    """Headers come to the rows, not a file's rows to its header's task; a line without a quote has the cells of one with."""
    at = put(tmp_path, "a.csv", "id,v,w\n" + "".join(f"{i},,x{i}\n" for i in range(4000)) + 'q,"a ""b"", c",\n')
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(kept, ("8192", "0", "-1"), strict=True):
            spark.conf.set(k, v)
        got, _ = H.own_headers(spark, [at], ",", quoted=True)
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        cells = {r["cells"][0]: r["cells"][1:] for r in got.collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(cells) == 4001 and cells["7"] == ["", "x7"] and cells["q"] == ['a "b", c', ""]


def test_a_migrations_raw_files_are_not_read_again_for_each_result(spark, tmp_path):
    put(tmp_path, "s1/rawData/SSTR_s1.txt", "SUBJECT_ID\tSAMPLE_ID\tCONSENT\tconsent_abbreviation\tdbgap_subject_id\tdbgap_sample_id\nS1\tT1\t1\tGRU\tD1\t1\n")
    put(tmp_path, "s2/rawData/s2.v1.pht000001.Subject.MULTI.txt", "dbGaP_Subject_ID\tSUBJECT_ID\tCONSENT\nD2\tS2\t1\nD2\tS2\t2\nD3\tS3\t0\n")
    put(tmp_path, "s2/rawData/s2.pht000002.Sample.MULTI.txt", "dbGaP_Subject_ID\tdbGaP_Sample_ID\tSAMPLE_ID\nD2\t7\tT7\n")
    for study, n in (("s1", 1), ("s2", 2)):
        put(tmp_path, f"{study}/legacy/data/A{n}_PatientMapping.v2.csv", f"D{n},A{n},10{n}\n")
    studies = spark.createDataFrame([(1, "s1", "A1", True, False), (2, "s2", "A2", True, False)], "ord long, study_id string, abv string, is_ready boolean, is_processed boolean")
    tables = ("person_id long, source_id string, source string", "person_id long, study_id string, consent_code string, consent_abbreviation string", "person_id long, source_sample_id string, sample_source string")
    prior = "study_id string, data_folder string, mapping_rows long, has_mapping_file boolean"
    got = M.migrate_folders(spark, f"file:{tmp_path}", studies, *[spark.createDataFrame([], t) for t in (*tables, prior)], "now")
    assert rows(got["outcomes"], "study_id", "source", "mapping_rows", "outcome") == [("s1", "SSTR", 1, "success"), ("s2", "MULTI", 1, "success")]
    assert rows(got["consents"], "study_id", "consent_code") == [("s1", "1"), ("s2", "1")]
    assert rows(got["issues"].where("code = 'CONSENT_CONFLICT'"), "study_id", "count", "examples") == [("s2", 1, ["D2=1/2"])]
    for name, df in got.items():
        assert not [f for f in df.inputFiles() if str(tmp_path) in f], name
