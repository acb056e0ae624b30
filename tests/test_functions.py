from pyspark.sql import functions as F

from cohortflow.functions import cells as C
from cohortflow.functions import studies as S


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_trim(spark):
    assert column(spark, [" a\t", "\x00\x1f", "", None, "\u00a0b"], C.trim_to_null) == ["a", None, None, None, "\u00a0b"]


def test_numbers(spark):
    good = ["1", "-1.5", "+.5", "5.", "1e3", "1E-3d", "NaN", "-Infinity", "0x1p3", "0x.8P1f", " 7 "]
    bad = ["", "inf", "Infinityx", "1,000", "abc", "0x1", "1e", "--1", ".", "nan"]
    assert column(spark, good, C.is_number) == [True] * len(good)
    assert column(spark, bad, C.is_number) == [False] * len(bad)


def test_null_words(spark):
    assert column(spark, ["NULL", "Na", "n/a", "NaN", "nil", "NILL", "none", "0"], C.is_null_word) == [True] * 6 + [False] * 2


def test_csv(spark):
    assert column(spark, ["a", "a,b", 'a"b', "a\nb", None], C.csv_quote) == ["a", '"a,b"', '"a""b"', '"a\nb"', ""]
    assert column(spark, ['a"b'], lambda c: C.quoted_line(c, F.lit(None), F.lit("x"))) == ['"a""b","","x"']


def test_text(spark):
    assert column(spark, ['a"b'], C.text_value) == ["a'b"]
    assert column(spark, ["a\tb\nc\rd"], C.visible) == ["a\\tb\\nc\\rd"]
    assert column(spark, [" a \n b ", None], C.one_line) == ["a b", ""]
    assert column(spark, ["a,b", "ab", None], lambda c: C.has_separator(c, ",\t\n\r")) == [True, False, False]


def test_patient_cells(spark):
    assert column(spark, ["P1", "", "#x", "dbGaP_id", None, " 7"], C.is_patient_cell) == [True, False, False, False, False, True]


def test_flags(spark):
    assert column(spark, ["Yes", "NO", "", None, "maybe"], C.yes_no) == [True, False, False, False, None]
    assert column(spark, ["on", "F", "0", "TRUE"], C.bool_literal) == [True, None, False, True]
    assert column(spark, ["a, b,,c", None], C.listed) == [["a", "b", "c"], []]


def test_paths_and_keys(spark):
    assert column(spark, ["\\a\\b\\", "a", "µaµ"], S.concept_path) == ["µaµbµ", "µaµ", "µaµ"]
    got = column(spark, ["f.csv:3", "f.csv:-1", "f:1:2", ":1", "f.csv:x", " f : 2 "], S.mapping_key)
    assert [r and (r["file"], r["column"]) for r in got] == [("f.csv", 3), None, None, None, None, ("f", 2)]
    assert column(spark, ["patientCol=2;x=1", "x=1", None, "patientcol=z", "PATIENTCOL= 4 ;patientcol=5"], S.patient_column) == [2, 0, 0, 0, 4]
    assert column(spark, ["numeric", "Text", None], S.data_type) == ["NUMERIC", "TEXT", "TEXT"]


def test_codes(spark):
    assert column(spark, ["01", "0", "000", "a", "", "10"], S.consent_code) == ["1", "0", "0", None, None, "10"]
    assert column(spark, ["Health (any) (HMB) ", "none", "(X)"], S.abbreviation) == ["HMB", "", "X"]
    got = column(spark, ["name-phs000123-v1-c2", "phs000123", "name-c2", "phs000001_c10"], S.group_name)
    assert [r and (r["study_id"], r["consent_code"]) for r in got] == [("phs000123", "2"), None, None, ("phs000001", "10")]


def test_identities(spark):
    raw = ["7", "['7']", "[{'Value ': 'a', 'x': 'b'}]", "[{'x': 'b'}, 'c']", "[null]", "[['n'], 'm']", "", None, "[broken", "[1, 2]", " x,y "]
    assert column(spark, raw, S.identities) == [["7"], ["7"], ["a"], ["b", "c"], ["null"], ["m"], [], [], ["broken"], ["1", "2"], ["x", "y"]]


def test_kinds(spark):
    assert column(spark, ["P/G", "g", "P", None, "GG"], S.is_genomic) == [True, True, False, False, False]
    assert column(spark, ["phs000001", "phs1", None], S.is_study_id) == [True, False, False]
    names = ["phs1_c1_allConcepts_MERGED.csv", "a_allConcepts_b.csv", "x_allConcepts_merged.csv", "phs1_c2_allConcepts_MERGED.csv", "note.txt"]
    assert column(spark, names, lambda c: S.file_class(c, F.lit("phs1"), F.lit("c1"))) == ["merged", "source", "other_merged", "other_merged", "ignored"]
    raw = ["sstr_phs1.v1.txt", "SSTR__sstr_phs1.txt", "BDC-ingestion-only__sstr_phs1.txt", "phs1.v1.Subject.MULTI.txt", "phs1.Sample.multi.TXT", "phs1.Subject.data_dict.xml", "phs2.Subject.MULTI.txt"]
    assert column(spark, raw, lambda c: S.raw_file_class(c, F.lit("phs1"))) == ["sstr", "sstr_copy", "sstr_copy", "subject", "sample", "dictionary", None]


def test_natural_order(spark):
    names = spark.createDataFrame([("phs7.v33.txt",), ("phs7.v9.txt",), ("PHS7.v10.txt",)], "n string")
    assert [r[0] for r in names.orderBy(S.natural_key(F.col("n"))).collect()] == ["phs7.v9.txt", "PHS7.v10.txt", "phs7.v33.txt"]
    long = ["1" * 45 + "2.csv", "1" * 45 + "1.csv", "2" * 45 + ".csv", "0" * 50 + "7.csv", "x" * 60 + "1", "x" * 60 + "02"]
    keyed = spark.createDataFrame([(n,) for n in long], "n string")
    assert [r[0] for r in keyed.orderBy(S.natural_key(F.col("n"))).collect()] == [long[3], long[2], long[1], long[0], long[4], long[5]]


def test_columns_by_alias(spark):
    df = spark.createDataFrame([("1", "2")], "` dbgap_SUBJECT_id` string, consent string")
    assert S.resolve_column(df, ["x", "dbGaP_Subject_ID"]) == " dbgap_SUBJECT_id"
    assert S.resolve_column(df, ["y"]) is None


def test_outcomes(spark):
    assert column(spark, [0, 2, 124, 9], S.exit_name, "int") == ["SUCCESS", "VALIDATION_FAILED", "TIMEOUT", "UNKNOWN"]
    codes = [["NEEDS_DATA_REVIEW"], ["NO_PARTICIPANT_FILES"], ["MULTI_LOAD_FAILED"], []]
    assert column(spark, codes, lambda c: S.study_outcome(F.size(c) == 0, c), "array<string>") == ["needs_review", "skipped", "failed", "success"]
    got = column(spark, codes, lambda c: S.outcome_class(F.size(c) == 0, F.lit("MULTI"), F.lit("s.txt"), c), "array<string>")
    assert got == ["skipped_needs_review", "skipped_no_files", "failed_multi", "loaded_multi_sstr_malformed"]
    assert column(spark, ["MISSING_DATA", "PARTIAL_DATA", "x"], S.review_status) == ["NOT_MIGRATED", "MIGRATED_WITH_GAPS", None]
    assert column(spark, ["x"], S.review_action) == [""]
    assert column(spark, ["preflight", "run", None], lambda c: S.is_data_failure(c, F.lit("DATA_ERROR"))) == [True, True, True]
    assert column(spark, ["preflight", "run", None], lambda c: S.is_data_failure(c, F.lit(None).cast("string"))) == [True, False, False]


def test_issue_study(spark):
    df = spark.createDataFrame([({"studyId": "phs000009"}, None, "phs000001"), ({"folder": "phs000002/x"}, "phs000003", None), ({}, None, "about phs000004"), (None, None, None)], "c map<string,string>, l string, m string")
    assert [r[0] for r in df.select(S.issue_study(F.col("c"), F.col("l"), F.col("m"))).collect()] == ["phs000009", "phs000002", "phs000004", None]


def test_row_rules(spark):
    df = spark.createDataFrame([("1", "µaµ", "5", ""), ("", "µaµ", "", "x"), ("1", "a", "", "x"), ("1", "µaµ", "5", "x"), ("1", "µaµ", "z", "")], "i string, p string, n string, t string")
    assert [r[0] for r in df.select(S.row_violation(*[F.col(c) for c in "ipnt"])).collect()] == [None, "NO_ID", "BAD_PATH", "TWO_VALUES", "BAD_NUMBER"]
