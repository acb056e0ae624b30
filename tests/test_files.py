import json

import pytest

from cohortflow.operators import reshape as R
from cohortflow.plans import concepts as G
from cohortflow.plans import jobs as K
from cohortflow.sources import files as FI
from cohortflow.sources import sinks
from cohortflow.sources import study_files as SF
from cohortflow.sources.delimited import BadFile, read_commented, read_delimited, read_positional, read_run_tsv, read_wide
from cohortflow.sources.own_headers import own_headers


def put(tmp_path, name, text):
    p = tmp_path / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_bytes(text.encode())
    return str(p)


def lines(spark, path):
    return [r[0] for r in spark.read.text(path).collect()]


def test_delimited(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b,c\r\n1,"x ""y"", z",\r\n2\r\n')
    assert [tuple(r) for r in read_delimited(spark, path).orderBy("a").collect()] == [("1", 'x "y", z', ""), ("2", "", "")]


def test_commented(spark, tmp_path):
    path = put(tmp_path, "a.txt", '# one\n#two\n\nid\tv\n1\t"x\n2\n')
    assert [tuple(r) for r in read_commented(spark, path).orderBy("id").collect()] == [("1", '"x'), ("2", "")]
    with pytest.raises(Exception, match="wider"):
        read_commented(spark, put(tmp_path, "b.txt", "id\tv\n1\t2\t3\n")).collect()


def test_positional(spark, tmp_path):
    path = put(tmp_path, "a.csv", "1,2,3\n1,2\n1,2,3,4\n")
    assert [r["malformed"] for r in read_positional(spark, path, 3).collect()] == [False, True, True]
    assert read_positional(spark, path, 3).where("malformed").count() == 2  # also where no cell is asked for
    with pytest.raises(Exception, match="wider"):
        read_commented(spark, put(tmp_path, "b.txt", "id\tv\n1\t2\t3\n")).select("id").collect()


def test_run_tsv(spark, tmp_path):
    assert read_run_tsv(spark, put(tmp_path, "r.tsv", 'study_id\tresult\nphs000001\t"ok\n')).head()["result"] == '"ok'


def test_managed_inputs(spark, tmp_path):
    def table(*rows):
        cells = [dict(zip((SF.ABV, SF.STUDY, SF.KIND, SF.READY, SF.PROCESSED), r)) for r in rows]
        return "\n".join([",".join(SF.HEADINGS), *(",".join(c.get(h, "") for h in SF.HEADINGS) for c in cells), ""])

    df = SF.read_managed_inputs(spark, put(tmp_path, "m.csv", table(("A", "phs000001", "P/G", "YES", "no"), ("", "phs000002", "P", "Yes", "No"), ("C", "phs000003", "P", "", ""))))
    assert [(r.study_id, r.is_ready, r.is_processed) for r in df.orderBy("ord").collect()] == [("phs000001", True, False), ("phs000003", False, False)]
    with pytest.raises(BadFile):
        SF.read_managed_inputs(spark, put(tmp_path, "n.csv", table(("A", "phs000001", "P", "perhaps", "no"))))
    with pytest.raises(BadFile, match="Subject Type"):
        SF.read_managed_inputs(spark, put(tmp_path, "o.csv", table(("A", "phs000001", "P", "yes", "no")).replace("Subject Type(s)", "x")))


def test_order_over_files_of_unequal_sizes(spark, tmp_path):
    old = "old_hpds_id,new_hpds_id,common\n"
    put(tmp_path, "ids/a.csv", old + "1,first,x\n")
    put(tmp_path, "ids/b.csv", old + "".join(f"9{i},{i},{'long ' * 20}\n" for i in range(200)) + "1,last,x\n")
    put(tmp_path, "ids/c.csv", old + "2,only,x\n")
    assert dict(SF.read_id_mapping(spark, str(tmp_path / "ids")).where("length(old_id) = 1").collect()) == {"1": "last", "2": "only"}
    head = "SUBJECT_ID\tCONSENT\tconsent_abbreviation\tdbgap_subject_id\tdbgap_sample_id\n"
    put(tmp_path, "sstr/a.txt", head + "s\t1\tGRU\t11\t\n")
    put(tmp_path, "sstr/b.txt", head + "".join(f"s\t2\tHMB\t11\t{'x' * 50}{i}\n" for i in range(300)))
    assert SF.read_sstr(spark, str(tmp_path / "sstr")).groupBy("subject_id").agg({"ord": "min"}).count() == 1
    from cohortflow.operators.aggregates import consent_groups

    assert [r["consent"] for r in consent_groups(SF.read_sstr(spark, str(tmp_path / "sstr")).selectExpr("*", "'s' as study_id")).collect()] == ["1"]


def test_concept_mapping(spark, tmp_path):
    text = 'key,root node,sup path,data type,options\nd.csv:1,\\s\\,a,NUMERIC,\n\nd.csv:2,s,"b",word,patientcol=3\nbad,s,x,TEXT,\nd.csv:4\nd.csv:5,,x,TEXT,\n'
    good, dropped = SF.read_concept_mapping(spark, put(tmp_path, "map.csv", text))
    assert sorted(tuple(r) for r in good.collect()) == [("d.csv", 1, "µsµaµ", "NUMERIC", 0), ("d.csv", 2, "µsµbµ", "TEXT", 3)]
    assert sorted(r["reason"] for r in dropped.collect()) == ["BAD_KEY", "NO_ROOT", "TOO_FEW_COLUMNS"]
    with pytest.raises(BadFile):
        SF.read_concept_mapping(spark, put(tmp_path, "none.csv", "bad,s,x,TEXT,\n"))


def test_sstr(spark, tmp_path):
    head = "SUBJECT_ID\tSAMPLE_ID\tCONSENT\tconsent_abbreviation\tdbgap_subject_id\tdbgap_sample_id\n"
    assert SF.read_sstr(spark, put(tmp_path, "s.txt", head + "a\t\t1\tGRU\t11\t21\n")).count() == 1
    with pytest.raises(BadFile):
        SF.read_sstr(spark, put(tmp_path, "t.txt", head + "a\tb\t\tGRU\t11\t21\n"))
    with pytest.raises(BadFile):
        SF.read_sstr(spark, put(tmp_path, "u.txt", "SUBJECT_ID\nx\n"))


def test_subjects(spark, tmp_path):
    text = "# c\ndbGaP SubjID\tSUBJID\tgencons\n1\ta\t0\n1\ta\t02\n1\ta\t3\n2\tb\t0\n3\tc\tx\n\td\t1\n"
    yes, no, issues = SF.read_subjects(spark, put(tmp_path, "subj.txt", text))
    assert [(r.dbgap_id, r.code, r.conflicts) for r in yes.collect()] == [("1", "2", 1)]
    assert [(r.dbgap_id, r.subject_id) for r in no.collect()] == [("2", "b")]
    assert sorted(r.code for r in issues.collect()) == ["BLANK_SUBJECT", "CONSENT_NOT_A_NUMBER", "CONSENT_ZERO", "CONSENT_ZERO"]


def test_samples(spark, tmp_path):
    rows, issues = SF.read_samples(spark, put(tmp_path, "samp.txt", "dbGaP_Subject_ID\tdbGaP_Sample_ID\tSAMPID\n1\t7\t\n1\t\tx\n2\t\t\n\t8\ty\n"))
    assert rows.count() == 2 and sorted(r.code for r in issues.collect()) == ["BLANK_SUBJECT", "NO_SAMPLE_ID"]


def test_decodings(spark, tmp_path):
    xml = '<data_table><variable id="v1"><name>Other</name><value code="1">no</value></variable><variable id="v2"><name>CONSENT</name><value code="02">Health (HMB)</value><value code="2">again</value><value code="0">none</value></variable></data_table>'
    got = SF.read_consent_decodings(spark, put(tmp_path, "d.xml", xml), "consent")
    assert sorted(tuple(r) for r in got.collect()) == [("0", "none"), ("2", "Health (HMB)")]
    for bad in ("not xml", "<!DOCTYPE x><data_table/>"):
        with pytest.raises(BadFile):
            SF.read_consent_decodings(spark, put(tmp_path, "e.xml", bad), "consent")


def test_mappings(spark, tmp_path):
    assert SF.read_patient_mapping(spark, put(tmp_path, "p.csv", "D1,A,100\n")).head() == ("D1", "100")
    with pytest.raises(BadFile):
        SF.read_patient_mapping(spark, put(tmp_path, "q.csv", "D1,A\n"))
    got = SF.read_id_mapping(spark, put(tmp_path, "i.csv", "old_hpds_id,new_hpds_id,common_dbgap_id\n1,5,x\n1,6,x\n2,,x\n"))
    assert [tuple(r) for r in got.collect()] == [("1", "6")]


def test_person_tree(spark, tmp_path):
    put(tmp_path, "set-20250101/study/consent_groups/n-phs000001-v1-c2/a/mapped-data/Person.tsv", "id\t Identity \n1\t['7']\n")
    put(tmp_path, "set-20250101/study/consent_groups/bad/mapped-data/Person.tsv", "id\t Identity \n1\t8\n")
    rows = SF.read_person_tree(spark, str(tmp_path), "set-20250101")
    assert [(r.study_id, r.consent_code, r.raw) for r in rows.collect()] == [("phs000001", "2", "['7']")]
    names = spark.createDataFrame([("set-20250101",), ("old-20240101",), ("x",)], "name string")
    assert FI.latest_dataset(names) == "set-20250101" and FI.latest_dataset(names, "y") == "y"
    with pytest.raises(BadFile):
        FI.latest_dataset(names.where("name = 'x'"))


def test_concepts_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("phs000001", "1", "7", "µaµ", "", 'say "x"', "0"), ("phs000001", "2", "8", "µaµ", "5", "", "0")], "study_id string, consent_code string, person_id string, path string, numeric string, text string, timestamp string")
    sinks.write_concepts(rows, str(tmp_path / "out"))
    assert lines(spark, str(tmp_path / "out/study_id=phs000001/consent_label=c1")) == ['"7","µaµ","","say ""x""","0"']
    back = SF.read_all_concepts(spark, str(tmp_path / "out/study_id=phs000001/consent_label=c1"))
    assert [tuple(r) for r in back.collect()] == [("7", "µaµ", "", 'say "x"', "0", False)]


def test_inventory_merge_and_manifest(spark, tmp_path):
    for name, text in (("a_allConcepts_1.csv", "x\ny"), ("b_allConcepts_2.csv", "z\n"), ("note.txt", "n")):
        put(tmp_path, f"phs000001/allConcepts/c1/{name}", text)
    files = FI.file_inventory(spark, str(tmp_path))
    plan = K.merge_plan(K.consent_folders(files))
    assert [(r.action, r.sources, r.ignored) for r in plan.collect()] == [("MISSING", 2, 1)]
    assert [r["value"] for r in R.concatenated(spark, f"{tmp_path}/phs000001/allConcepts/c1/*_allConcepts_*").collect()] == ["x", "y", "z"]
    rows = spark.createDataFrame([("phs000001.c1", "u,1", "v", "t", "m"), ("global", "u", "v", "t", "m")], "partition string, uri string, version_id string, last_updated string, md5 string")
    bad = spark.createDataFrame([("ERROR",)], "severity string")
    assert not sinks.publish_manifest(rows, bad, str(tmp_path / "pub"), "r1")
    assert sinks.publish_manifest(rows, bad.limit(0), str(tmp_path / "pub"), "r1")
    assert lines(spark, str(tmp_path / "pub/r1/manifest"))[:2] == ["partition,uri,version_id,last_updated,md5", "global,u,v,t,m"]
    assert lines(spark, str(tmp_path / "pub/current")) == ["r1"]


def test_concepts_of_a_study_of_files(spark, tmp_path):
    wide = {"a.csv": 'id,weight,note\nD1,70,"say ""x"""\nD2,NA,tall\n#c,1,x\nD9,80,far\nD1,90\n', "b.csv": "age,id\n12,D1\nold,D2\n"}
    for f, text in wide.items():
        put(tmp_path, f"in/{f}", text)
    lines = "a.csv:1,s,weight,TEXT,\na.csv:2,s,note,NUMERIC,\nb.csv:0,s,age,NUMERIC,patientcol=1\na.csv:7,s,beyond,TEXT,\nc.csv:1,s,gone,TEXT,\n"
    mapping = SF.read_concept_mapping(spark, put(tmp_path, "map.csv", lines))[0]
    people = spark.createDataFrame([(1, "D1", "DBGap"), (2, "D2", "DBGap")], "person_id long, source_id string, source string")
    consents = spark.createDataFrame([(1, "phs000001", "1", "")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    rows, counts, missing = G.concepts_of_files(spark, str(tmp_path / "in"), mapping, people, consents)
    assert sorted((r.person_id, r.path, r.numeric, r.text) for r in rows.where("class = 'written'").collect()) == [(1, "µsµageµ", "", "12"), (1, "µsµnoteµ", "", "say 'x'"), (1, "µsµweightµ", "70", "")]
    assert sorted(tuple(r) for r in counts.collect()) == [("a.csv", 5, 1, 1, 2, 2, 1, 1), ("b.csv", 2, 0, 0, 1, 0, 1, 0)]
    assert [r.file for r in missing.collect()] == ["c.csv"]
    with pytest.raises(ValueError):
        G.concepts_of_files(spark, str(tmp_path / "none"), mapping, people, consents)


def test_generated_concepts_replace_what_stood(spark, tmp_path):
    put(tmp_path, "in/a.csv", "id,weight\nD1,70\nD2,x\n")
    people = spark.createDataFrame([(1, "D1", "DBGap"), (2, "D2", "DBGap")], "person_id long, source_id string, source string")
    consents = spark.createDataFrame([(1, "phs000001", "1", ""), (2, "phs000001", "2", "")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    out = tmp_path / "out"

    def run(mapping, data="in"):
        return G.generate_concepts(spark, "phs000001", str(tmp_path / data), put(tmp_path, "map.csv", mapping), people, consents, str(out))

    def names():
        return sorted(p.name for p in out.glob("*/allConcepts/*/*.csv"))

    put(tmp_path, "out/phs000001/allConcepts/c9/phs000001_allConcepts_c9.csv", "old")
    put(tmp_path, "out/phs000001/allConcepts/c9/kept.txt", "other")
    told = run("a.csv:1,s,weight,TEXT,\ngone.csv:1,s,gone,TEXT,\nbad,,,,\n")
    assert names() == ["phs000001_allConcepts_c1.csv", "phs000001_allConcepts_c2.csv", "phs000001_allConcepts_c9.csv"]
    assert sorted((r.severity, r.code) for r in told["checks"].collect()) == [("WARNING", "FILES_MISSING"), ("WARNING", "STALE_OUTPUTS")] and told["dropped"].count() == 1
    told = run("a.csv:1,s,weight,TEXT,\n")
    assert names() == ["phs000001_allConcepts_c1.csv", "phs000001_allConcepts_c2.csv"] and (out / "phs000001/allConcepts/c9/kept.txt").exists()
    assert [r.removed for r in told["stale"].collect()] == [True]
    put(tmp_path, "in2/a.csv", "id,weight\nD9,70\n")
    told = run("a.csv:1,s,weight,TEXT,\n", "in2")  # nobody is known: an error, and all stays
    assert ("ERROR", "NO_ROWS") in [(r.severity, r.code) for r in told["checks"].collect()] and len(names()) == 2
    with pytest.raises(ValueError, match="no consents"):
        G.generate_concepts(spark, "phs000009", str(tmp_path / "in"), str(tmp_path / "map.csv"), people, consents, str(out))


def test_several_files_of_a_group_get_numbers(spark, tmp_path):
    rows = spark.range(200).selectExpr("'phs000001' as study_id", "'1' as consent_code", "cast(id as string) as person_id", "'µaµ' as path", "'' as numeric", "'x' as text", "'0' as timestamp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one file again
    sinks.write_concepts(rows, str(tmp_path / "stage"), files_per_group=4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n = sinks.publish_concepts(spark, str(tmp_path / "stage"), str(tmp_path / "out"))
    names = sorted(p.name for p in (tmp_path / "out/phs000001/allConcepts/c1").glob("*.csv"))
    assert n == len(names) > 1 and names[-1] == "phs000001_allConcepts_c1.csv" and all(x.startswith("phs000001_allConcepts_c1.") for x in names)
    assert SF.read_all_concepts(spark, str(tmp_path / "out/*/allConcepts/*")).count() == 200
    sinks.write_concepts(rows, str(tmp_path / "stage2"))
    assert sinks.publish_concepts(spark, str(tmp_path / "stage2"), str(tmp_path / "out")) == 1


def test_genomic_files(spark, tmp_path):
    rows = spark.createDataFrame([("phs000001.c1", "A", 2, "NWD1", "s"), ("phs000001.c1", "A", 1, "NWD2", "s")], "consent_group string, abv string, person_id int, source_sample_id string, sample_source string")
    sinks.write_vcf_indexes(K.genomic_indexes(rows), str(tmp_path / "vcf"))
    got = lines(spark, str(tmp_path / "vcf/consent_group=phs000001.c1"))
    assert got[0] == "phs000001.c1" and got[1] == R.VCF_HEADER and len(got) == 25
    assert got[2].split("\t")[1:] == ["1", "TRUE", "TRUE", "NWD1,NWD2", "2,1", "", ""] and got[24].split("\t")[1] == "X"
    sinks.write_sample_ids(rows, str(tmp_path / "ids"))
    assert lines(spark, str(tmp_path / "ids/consent_group=phs000001.c1")) == ["1,A,NWD2", "2,A,NWD1"]


def test_reports(spark, tmp_path):
    issue = {"severity": "WARNING", "code": "X", "message": "m", "location": None, "context": {"studyId": "phs000001"}}
    report = {"jobName": "j", "runId": "r", "exitCode": "SUCCESS", "status": "SUCCESS", "inputValidation": {"issues": [issue], "counts": {"error": 0}}, "outputValidation": {"issues": [], "counts": {"error": 0}}, "metrics": {"rows": 1}}
    put(tmp_path, "j-1.json", json.dumps(report))
    put(tmp_path, "k.json", "{broken")
    reports = FI.read_reports(spark, f"{tmp_path}/*.json")
    assert reports.count() == 1 and FI.issues(reports).head()["code"] == "X"
    sinks.write_reports(str(tmp_path / "out"), ["study_id"], t=spark.createDataFrame([("b", ["x", "y"]), ("a", [])], "study_id string, why array<string>"))
    assert lines(spark, str(tmp_path / "out/t.csv")) == ["study_id,why", "a,", "b,x; y"]


def test_identity_snapshots(spark, tmp_path):
    root = str(tmp_path / "store")
    for n in (1, 2):
        sinks.write_identity_tables(spark, root, consents=spark.createDataFrame([(n, "phs000001")], "person_id int, study_id string"))
    assert [r["person_id"] for r in sinks.read_identity_table(spark, root, "consents").collect()] == [2]
    rows = spark.createDataFrame([("b", "phs000001", "1"), ("a", "phs000002", "1")], "identity string, study_id string, consent_code string")
    sinks.write_identity_map(rows, str(tmp_path / "one"), False)
    assert lines(spark, str(tmp_path / "one")) == ["identity,study_id,consent_code", "a,phs000002,1", "b,phs000001,1"]
    sinks.write_identity_map(rows, str(tmp_path / "many"), True)
    assert lines(spark, str(tmp_path / "many/study=phs000001"))[1:] == ["b,phs000001,1"]


def test_versions(spark):
    v = spark.createDataFrame([("a", True, False), ("a", False, False), ("b", True, True)], "name string, is_latest boolean, is_deleted boolean")
    assert [r["name"] for r in FI.current_versions(v).collect()] == ["a"]


def test_an_index_group_is_one_ordered_file_where_sides_shuffle_unlike_amounts(spark, tmp_path):
    own = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(4000).selectExpr("concat('phs', id % 8, '.c1') as consent_group", "id as person_id", "concat('NWD', id) as source_sample_id", "'DBGap' as sample_source")
        sinks.write_vcf_indexes(K.genomic_indexes(rows), str(tmp_path / "vcf"))
    finally:
        for k in own:
            spark.conf.unset(k)
    for i in range(8):
        (file,) = (tmp_path / f"vcf/consent_group=phs{i}.c1").glob("part-*")
        lines = file.read_text().splitlines()
        assert len(lines) == 25 and lines[:2] == [f"phs{i}.c1", R.VCF_HEADER] and [line.split("\t")[1] for line in lines[2:]] == [*map(str, range(1, 23)), "X"]


def test_headers_are_read_once_and_other_classes_are_counted(spark, tmp_path):
    put(tmp_path, "in/a.csv", '\n id ,weight,note\n D1\t,70 ," say  ""x"" "\nD2, na ,\x01tall\nD9,80,far\nD9,,\n#c,1,x\nD1,90\n')
    put(tmp_path, "in/b.csv", "id,weight\n")
    mapping = SF.read_concept_mapping(spark, put(tmp_path, "map.csv", "a.csv:1,s,weight,TEXT,\na.csv:2,s,note,NUMERIC,\nb.csv:1,s,b,TEXT,\n"))[0]
    people = spark.createDataFrame([(1, "D1", "DBGap"), (2, "D2", "DBGap")], "person_id long, source_id string, source string")
    consents = spark.createDataFrame([(1, "phs000001", "1", "")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    _, heads = own_headers(spark, [str(tmp_path / "in/a.csv"), str(tmp_path / "in/b.csv")], ",", quoted=True)
    assert sorted(r.header for r in heads.collect()) == [["id", "weight"], ["id", "weight", "note"]]
    assert not [p for p in heads.inputFiles() if p.endswith(".csv")]  # each use of them would read all files again
    told = [G.concepts_of_files(spark, str(tmp_path / "in"), mapping, people, consents, only_written=x) for x in (False, True)]
    for _, counts, _ in told:
        assert sorted(tuple(r) for r in counts.collect()) == [("a.csv", 6, 1, 1, 2, 2, 1, 1), ("b.csv", 0, 0, 0, 0, 0, 0, 0)]
    every, own = ([(r["class"], r.patient, r.path, r.numeric, r.text) for r in rows.collect()] for rows, _, _ in told)
    assert sorted(own) == [("written", "D1", "µsµnoteµ", "", "say  'x'"), ("written", "D1", "µsµweightµ", "70", "")]
    assert sorted(every) == sorted([*own, ("no_consent", "D2", "µsµnoteµ", "", "tall"), ("unmapped", "D9", "µsµnoteµ", "", "far"), ("unmapped", "D9", "µsµweightµ", "80", "")])
