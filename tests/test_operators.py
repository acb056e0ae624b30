import pytest
from pyspark.sql import functions as F

from cohortflow.operators import aggregates as A
from cohortflow.operators import dedup as E
from cohortflow.operators import identity as I
from cohortflow.operators import joins as J
from cohortflow.operators import reshape as R
from cohortflow.plans import gates as V
from cohortflow.plans import jobs as K
from cohortflow.plans import outcomes as O


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "D1", "DBGap"), (5, "D5", "DBGap"), (9, "D1", "other")], "person_id long, source_id string, source string")


def test_row_order(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text("".join(f"{i},{k}\n" for k in range(50)))
    df = E.with_row_order(spark.read.schema("f int, k int").csv(str(tmp_path)))
    assert [(r.f, r.k) for r in df.orderBy("ord").collect()] == [(i, k) for i in range(3) for k in range(50)]


def test_first_last_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y")], "k string, o int, v string")
    assert rows(E.last_per_key(df, ["k"], "o"), "v") == [("z",)] and rows(E.first_per_key(df, ["k"], "o"), "v") == [("x",)]
    names = spark.createDataFrame([("s", "phs7.v9.txt"), ("s", "phs7.v33.txt")], "k string, n string")
    assert rows(E.newest(names, ["k"], "n"), "n", "candidates") == [("phs7.v33.txt", 2)]
    sstr = spark.createDataFrame([("s", "SSTR__sstr_a.txt"), ("s", "sstr_b.txt")], "k string, n string")
    assert rows(E.preferred(sstr, ["k"], F.lower("n").startswith("sstr__"), "n"), "n", "candidates") == [("sstr_b.txt", 2)]


def test_paired_dictionary(spark):
    df = spark.createDataFrame([("s", "s.pht000001.v2.xml"), ("s", "s.pht000002.v9.xml"), ("s", "s.pht000001.v10.xml")], "k string, n string").withColumn("subject", F.lit("s.pht000001.Subject.MULTI.txt"))
    assert rows(E.paired_dictionaries(df, ["k"], "n", "subject"), "n") == [("s.pht000001.v10.xml",)]
    other = df.withColumn("subject", F.lit("s.pht000009.txt"))
    assert rows(E.paired_dictionaries(other, ["k"], "n", "subject"), "n") == [("s.pht000002.v9.xml",)]


def test_usable_consents(spark):
    df = spark.createDataFrame([("a", 1, "0"), ("a", 2, "02"), ("a", 3, "1"), ("a", 4, "2"), ("b", 5, "x"), ("d", 6, " "), ("d", 7, None), ("e", 8, "00"), ("e", 9, "x"), ("e", 10, "0"), ("f", 11, "1"), ("f", 12, "3"), ("f", 13, "4"), ("f", 14, "1")], "k string, o int, c string")
    yes, no = E.first_usable_consent(df, ["k"], "c", "o")
    assert rows(yes, "k", "c", "conflicts") == [("a", "2", 1), ("f", "1", 2)] and rows(no, "k") == [("e",)]
    named = df.withColumn("own", F.expr("if(o in (1, 8), '', concat('S', o))"))
    yes, no = E.first_usable_consent(named, ["k"], "c", "o", "own")
    assert rows(yes, "k", "own") == [("a", "S2"), ("f", "S11")] and rows(no, "k", "own") == [("e", "S10")]


def test_first_labels_and_failures(spark):
    df = spark.createDataFrame([("1", "x", 2), ("1", "y", 1)], "code string, label string, pos int")
    assert rows(E.first_labels(df, ["code"], "label", "pos"), "label") == [("y",)]
    issues = spark.createDataFrame([(3, "ERROR"), (1, "WARNING"), (2, "ERROR")], "folder int, severity string")
    assert rows(E.first_failure(issues, "folder"), "folder") == [(2,)]


def test_new_numbers(spark, people):
    ids = spark.createDataFrame([("D1",), ("D9",), ("D7",), ("D7",)], "source_id string")
    out = I.resolve_or_create(people, ids, "DBGap")
    assert rows(out.where("person_id > 9"), "person_id", "source_id") == [(10, "D7"), (11, "D9")] and out.count() == 5
    assert rows(I.resolve_or_create(out, ids, "DBGap"), "person_id") == rows(out, "person_id")
    many = I.dense_numbers(spark.range(1000).selectExpr("cast(id * 7 % 1000 as string) as source_id"), "source_id", "n")
    assert [r["n"] for r in many.orderBy("source_id").collect()] == list(range(1, 1001))


def test_reload_refuses_nothing(spark):
    consents = spark.createDataFrame([(1, "phs000001", "1", "GRU")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    with pytest.raises(I.EmptyInput):
        I.purge_and_reload(consents, "phs000001", consents.limit(0))


def test_loads(spark, people):
    consents = spark.createDataFrame([(1, "phs000001", "9", "OLD"), (1, "phs000002", "1", "GRU")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    samples = spark.createDataFrame([(1, "T1", "DBGap")], "person_id long, source_sample_id string, sample_source string")
    sstr = spark.createDataFrame([(1, "a", "x1", "1", "GRU", "D1", "T1"), (2, "a", "", "2", "HMB", "D1", "T2"), (3, "b", "x3", "2", "HMB", "D8", "")],
        "ord int, subject_id string, sample_id string, consent string, consent_abbreviation string, dbgap_subject_id string, dbgap_sample_id string")
    p, c, s, n = I.load_sstr(people, consents, samples, sstr, "phs000001")
    assert rows(c, "study_id", "consent_code") == [("phs000001", "1"), ("phs000001", "2"), ("phs000002", "1")]
    assert n.drop("study_id").head().asDict() == {"rows_read": 3, "distinct_participants": 2, "participants_inserted": 1, "consents_written": 2, "consents_purged": 1, "consent_groups": 2, "samples_seen": 4, "samples_inserted": 3}
    assert V.load_checks(n).count() == 0
    again = I.load_sstr(p, c, s, sstr, "phs000001")
    assert rows(again[0], "person_id") == rows(p, "person_id") and again[1].exceptAll(c).count() == 0 and again[2].count() == s.count()
    subjects = spark.createDataFrame([(1, "D1", "a", "1"), (2, "D6", "b", "0"), (3, "D7", "c", "3")], "ord int, dbgap_id string, subject_id string, code string")
    tubes = spark.createDataFrame([(1, "D1", "T5", ""), (2, "D6", "T6", "t"), (3, "D0", "T7", "")], "ord int, subject_id string, dbgap_sample_id string, sample_id string")
    labels = spark.createDataFrame([("1", "General (GRU)")], "consent_code string, label string")
    p, c, s, issues = I.load_multi(people, consents, samples, subjects, tubes, labels, "phs000001")
    assert rows(c.where("study_id = 'phs000001'"), "consent_code", "consent_abbreviation") == [("1", "GRU"), ("3", "")] and s.count() == 2
    assert rows(issues, "code", "count") == [("CONSENT_CODE_NOT_DECODED", 1), ("SAMPLES_OF_UNCONSENTED_SUBJECTS", 1), ("SAMPLES_OF_UNKNOWN_SUBJECTS", 1), ("SUBJECTS_NOT_CONSENTED", 1)]
    assert {r["code"] for r in V.multi_issues(issues, False).collect()} >= {"NO_DATA_DICT"}


def test_concepts(spark, people):
    wide = spark.createDataFrame([("D5", "1.5", 'a"b', "nan"), ("#x", "1", "c", ""), ("D77", "2", "d", None), (" D5 ", "text", "", "")], "patient string, n string, t string, e string")
    mapping = spark.createDataFrame([("n", "µnµ", "NUMERIC"), ("t", "µtµ", "NUMERIC"), ("e", "µeµ", "TEXT"), ("gone", "µgµ", "TEXT")], "field string, path string, declared string")
    consents = spark.createDataFrame([(5, "phs000001", "1", "GRU")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    out, counts = K.study_concepts(wide, mapping, "patient", people, consents)
    assert rows(out, "path", "numeric", "text") == [("µnµ", "", "1.5"), ("µnµ", "", "text"), ("µtµ", "", "a'b")]
    assert dict(rows(counts, "class", "rows")) == {"written": 3, "unmapped": 2}
    assert V.concept_checks(counts, people.limit(0), people).select("code").distinct().count() == 2
    only = R.to_concepts(wide, [{"field": "n", "path": "µnµ", "type": "NUMERIC"}], "patient", [])
    assert rows(only, "patient", "numeric") == [("D5", "1.5"), ("D77", "2")]
    assert R.to_concepts(wide, [], "patient", []).count() == 0


def test_genomic_groups_held_back(spark):
    studies = spark.createDataFrame([(1, "A,B", "phs000001", "P/G", True, False), (2, "C", "phs000002", "G", True, False)], "ord int, abv string, study_id string, data_type string, is_ready boolean, is_processed boolean")
    consents = spark.createDataFrame([(1, "phs000001", "1", ""), (2, "phs000002", "1", ""), (3, "phs000002", "2", ""), (4, "phs000002", "0", "")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    samples = spark.createDataFrame([(1, "NWD1", "s"), (2, "NWD,2", "s"), (3, "NWD3", "s"), (3, "nwd4", "s"), (4, "NWD5", "s")], "person_id long, source_sample_id string, sample_source string")
    good, held = K.genomic_groups(studies, consents, samples)
    assert rows(good, "consent_group", "source_sample_id") == [("phs000002.c2", "NWD3")]
    assert rows(held.select("consent_group", F.array_join("reasons", ",").alias("r")), "consent_group", "r") == [("phs000001.c1", "BAD_STUDY_ABV"), ("phs000002.c1", "ID_COUNT_MISMATCH")]
    groups = good.groupBy("consent_group").agg(F.count("*").alias("samples"))
    assert V.genomic_checks(groups, held, 0).count() == 3


def test_merge_actions(spark):
    df = spark.createDataFrame([
        ("a", 0, 0, None, None, None, "f", "NO_SOURCES"), ("b", 0, 2, "v", None, None, None, "ONLY_MERGED_COPIES"), ("c", 0, 0, "v", None, None, None, "REMOVED_NO_SOURCES"),
        ("d", 1, 0, None, None, None, "f", "MISSING"), ("e", 1, 0, "v", None, None, "f", "NO_FINGERPRINT"), ("f", 1, 0, "v", "f", None, "f", "NO_FINGERPRINT"),
        ("g", 1, 0, "v", "x", "m", "f", "SOURCES_CHANGED"), ("h", 1, 0, "v", "f", "m", "f", "UP_TO_DATE"), ("i", 0, 1, None, None, None, None, "NO_SOURCES"),
    ], "k string, sources int, other_merged int, merged_version string, recorded_fingerprint string, recorded_md5 string, fingerprint string, want string")
    got = df.withColumn("action", K.merge_action())
    assert [r["k"] for r in got.where("action <> want").collect()] == []
    assert df.where("k = 'c'").select(K.merge_action(F.lit(True))).head()[0] == "CHANGED_DURING_RUN"


def test_split_then_merge_keeps_rows(spark):
    rows_in = spark.range(200).selectExpr("cast(id % 20 as string) as old_id", "'µaµ' as path", "'' as numeric", "cast(id as string) as text", "id % 50 = 0 as malformed")
    mapping = spark.range(18).selectExpr("cast(id as string) as old_id", "id as person_id")
    consents = spark.range(15).selectExpr("id as person_id", "'phs000001' as study_id", "cast(id % 3 as string) as consent_code")
    out, counts = K.split_concepts(rows_in, mapping, consents)
    n = dict(rows(counts, "class", "rows"))
    assert sum(n.values()) == 200 and out.count() == n["written"] and n["malformed"] == 4
    assert {r["code"] for r in V.split_checks(counts).collect()} == {"MALFORMED", "UNMAPPED", "NO_CONSENT"}


def test_gates(spark):
    man = spark.createDataFrame([("global", "s://x", "v", "t", "0" * 32), ("phs000001.c1", "x", "", "t", "z"), ("phs000001.c1", "s://x", "v", "t", "0" * 32)], "partition string, uri string, version_id string, last_updated string, md5 string")
    assert sorted(r["code"] for r in V.manifest_shape(man, "s://").collect()) == ["BAD_MD5", "BAD_URI", "BLANK_CELL", "REPEATED_PARTITION"]
    assert [r["code"] for r in V.manifest_shape(man.where("partition = 'none'"), "s://").collect()] == ["NOT_ONE_GLOBAL_ROW"]
    studies = spark.createDataFrame([("phs000001", False), ("phs000001", False), ("x", False)], "study_id string, is_ready boolean")
    assert sorted(r["code"] for r in V.input_guards(studies).collect()) == ["BAD_STUDY_ID", "STUDY_LISTED_AGAIN"]
    assert V.ready_gate(studies, True).head()["severity"] == "ERROR" and V.ready_gate(studies, False).head()["severity"] == "WARNING"
    assert V.ready_gate(studies.withColumn("is_ready", F.lit(True)), True).count() == 0
    none = spark.createDataFrame([], "uri string, version_id string, last_modified string, size long, md5 string")
    assert sorted(r["code"] for r in V.global_problems(none, man.limit(0)).collect()) == ["GLOBAL_MISSING", "NO_CONSENT_GROUPS"]
    bad = spark.createDataFrame([("u", "null", "t", 1, "m")], none.schema)
    assert [r["code"] for r in V.global_problems(bad, man).collect()] == ["GLOBAL_NOT_VERSIONED"]
    folders = spark.createDataFrame([("MISSING", "a", "c1", 2), ("MISSING", "a", "c1", 1)], "action string, study_id string, label string, sources long")
    assert [r["code"] for r in V.merge_consistency(folders, A.action_counts(folders)).collect()] == ["SEVERAL_ACTIONS"]
    results = spark.createDataFrame([("a", "success", 2), ("b", "success", 0)], "study_id string, outcome string, mapping_rows long")
    mapped = spark.createDataFrame([("a",)], "study_id string")
    assert sorted(r["code"] for r in V.migration_checks(results, mapped, 3).collect()) == ["MAPPING_ROWS_DIFFER", "NO_MAPPING", "OUTCOMES_NOT_READY_STUDIES"]
    assert [r["code"] for r in V.identity_checks(mapped.limit(0), mapped).collect()] == ["NO_ROWS", "IDENTITY_IN_SEVERAL_CONSENTS"]
    per = spark.createDataFrame([("a", 0, 0, "STUDY_WITHOUT_CONSENTS")], "study_id string, rows long, blank_abbreviations long, issue string")
    assert sorted(r["code"] for r in V.global_checks(per).collect()) == ["NO_ROWS", "STUDY_WITHOUT_CONSENTS"]


def test_report_gate(spark):
    from cohortflow.sources.files import REPORT

    df = spark.createDataFrame([("j", None, "r", "SUCCESS", "SUCCESS", None, None, None, ([], (0, 0, 0)), ([], (1, 0, 0)), None, None)], REPORT)
    assert [r["code"] for r in V.report_checks(df, "j", "r2").collect()] == ["WRONG_RUN", "ERRORS"]


def test_run_outcomes_of_late_stages(spark):
    plan = spark.createDataFrame([("a", "A", "load", ""), ("b", "B", "excluded", "no file"), ("c", "C", "already_processed", "")], "study_id string, abv string, plan string, reason string")
    results = spark.createDataFrame([("a", "sstr", "NOT_RUN", "")], "study_id string, stage string, result string, reason string")
    issues = spark.createDataFrame([], "study_id string, stage string, severity string, code string, message string")
    stages = spark.createDataFrame([("merge-allconcepts", True, "FAILED", "broke"), ("generate-allconcepts-manifest", False, None, None)], "stage string, ran boolean, status string, message string")
    review = O.run_review(plan, results, issues, stages)
    assert rows(review, "study_id", "code") == [("a", "NOT_STARTED"), ("a", "STAGE_FAILED"), ("a", "STAGE_NOT_RUN"), ("a", "STAGE_NOT_RUN"), ("b", "MISSING_INPUTS"), ("c", "STAGE_FAILED"), ("c", "STAGE_NOT_RUN"), ("c", "STAGE_NOT_RUN")]
    assert rows(O.run_outcomes(plan, review), "study_id", "status") == [("a", "FAILED"), ("b", "EXCLUDED"), ("c", "FAILED")]
    early = O.run_review(plan, results, issues, stages, preflight=True)
    assert rows(O.run_outcomes(plan, early), "study_id", "status") == [("a", "NOT_REACHED"), ("b", "EXCLUDED"), ("c", "ALREADY_PROCESSED")]
    assert rows(O.study_results(plan, results), "study_id", "result") == [("a", "NOT_RUN"), ("b", "NOT_RUN"), ("c", "NOT_RUN")]


def test_small_operators(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(R.unequal(a, b), "x", "side") == [(1, "left"), (2, "left"), (3, "right")]
    assert rows(R.distinct_union(a, b), "x") == [(1,), (2,), (3,)] and rows(R.minus(a, b, ["x"]), "x") == [(2,)]
    assert rows(A.repeated(a, "x"), "x", "times") == [(1, 2)]
    assert [r["x"] for r in R.largest_first(a.withColumn("o", F.lit(0)), "x", "o").collect()] == [2, 1, 1]
    studies = spark.createDataFrame([("a", True), ("b", False)], "study_id string, is_ready boolean")
    asked = spark.createDataFrame([("a",), ("b",), ("z",)], "study_id string")
    assert rows(J.not_ready(asked, studies), "study_id") == [("b",), ("z",)]
    prior = spark.createDataFrame([("a", "d", 3, True), ("b", "d", 0, True)], "study_id string, data_folder string, mapping_rows int, has_mapping_file boolean")
    left, reused = J.to_resume(asked, prior, "d")
    assert rows(left, "study_id") == [("b",), ("z",)] and rows(reused, "study_id", "issue") == [("a", "REUSED")]
    assert rows(J.missing_files(spark.createDataFrame([("f",), ("g",)], "file string"), spark.createDataFrame([("f",)], "file string")), "file") == [("g",)]
    assert rows(K.exclude_studies(studies, asked)[1], "study_id") == [("z",)]
    assert rows(O.failures_by(spark.createDataFrame([("FAILED", None), ("FAILED", "run"), ("SUCCESS", None)], "outcome string, stage string"), "stage"), "stage", "failed") == [("run", 1), ("unknown", 1)]
    ids = spark.createDataFrame([("x",), ("['x']",), ("",)], "raw string")
    assert R.blank_identities(ids).head()[0] == 1 and rows(R.identity_rows(ids), "identity") == [("x",), ("x",)]
    digest = A.content_digest(a, [], ["x"]).head()["digest"]
    assert digest == A.content_digest(a.orderBy(F.col("x").desc()), [], ["x"]).head()["digest"] != A.content_digest(b, [], ["x"]).head()["digest"]


def test_a_study_listed_twice(spark):
    studies = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("c", False)], "study_id string, is_ready boolean")
    consents = spark.createDataFrame([(1, "a", "1", "GRU"), (2, "b", "0", " "), (3, "c", "1", "X")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    people = spark.createDataFrame([(1, "D1", "DBGap"), (1, "D1", "DBGap"), (2, "D2", "DBGap")], "person_id long, source_id string, source string")
    tubes = spark.createDataFrame([(1, "T", "DBGap"), (1, "T", "submitted")], "person_id long, source_sample_id string, sample_source string")
    n = R.global_concepts(studies, people, consents, tubes).groupBy("study_id").count()
    assert rows(n, "study_id", "count") == [("a", 12), ("b", 3)]


def test_repeats_count_within_a_file(spark):
    raw = spark.createDataFrame([("phs000001", "1", "a", "P1"), ("phs000001", "1", "b", "P1"), ("phs000001", "1", "b", "P1"), ("phs000001", "1", "b", " ")], "study_id string, consent_code string, file string, raw string")
    rows_of, issues = K.identity_map(raw)
    assert rows(rows_of, "identity") == [("P1",)] and rows(issues, "code", "count") == [("BLANK_IDENTITY", 1), ("DUPLICATE_IDENTITY", 1)]
    assert rows(K.identity_map(raw.drop("file"))[1], "code", "count") == [("BLANK_IDENTITY", 1), ("DUPLICATE_IDENTITY", 2)]


def test_concepts_are_shuffled_as_wide_rows(spark):
    """One join of wide rows with people and their consents; concepts are made above it."""
    wide = spark.createDataFrame([(" D1 ", "1", "x"), ("D2", "2", "null"), ("D3", "3", "y"), ("#D1", "4", "z")], "patient string, a string, b string")
    mapping = spark.createDataFrame([("a", 0, "µaµ", "NUMERIC"), ("b", 1, "µbµ", "TEXT")], "field string, column int, path string, declared string")
    people = spark.createDataFrame([(1, "D1", "DBGap"), (2, "D2", "DBGap")], "person_id long, source_id string, source string")
    consents = spark.createDataFrame([(1, "s1", "1", ""), (1, "s2", "2", "")], "person_id long, study_id string, consent_code string, consent_abbreviation string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows, counts = K.study_concepts(wide, mapping, "patient", people, consents)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate") < plan.index("Join")
        got = sorted(map(tuple, rows.select("study_id", "person_id", "path", "numeric", "text").collect()))
        assert got == [("s1", 1, "µaµ", "1", ""), ("s1", 1, "µbµ", "", "x"), ("s2", 1, "µaµ", "1", ""), ("s2", 1, "µbµ", "", "x")]
        assert {r["class"]: (r["rows"], r["patients"]) for r in counts.collect()} == {"written": (4, 1), "no_consent": (1, 1), "unmapped": (2, 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
