"""Registered queries of functions, small operators and gates: cells of every kind are planted by expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import cells as C
from cohortflow.functions import studies as S
from cohortflow.operators import aggregates as A
from cohortflow.operators import dedup as E
from cohortflow.operators import joins as J
from cohortflow.operators import reshape as R
from cohortflow.plans import adapter as T
from cohortflow.plans import gates as V
from cohortflow.plans import outcomes as O
from cohortflow.plans.queries import _MIG, _RUNS, _migration, _split_runs, query


def planted(number: str, *values: str | None) -> str:
    """An expression for the value at a number's remainder, as Spark and DuckDB write it."""
    cases = " ".join(f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v.replace(chr(39), chr(39) * 2) + chr(39)}" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {cases} END"


def in_spark(expression: str) -> str:
    return expression.replace("\\", "\\\\")


PATHS = (r"\a\b", r"a\b" + "\\", "µaµ", "a", "µ")
KEYS = ("f.csv:1", "f.csv:x", "f.csv", "f:1:2", ":3", " f : 4 ", "f:-1")
OPTIONS = ("patientcol=2", "a=1;PATIENTCOL = 3", "patientcol=x", "", None, "patientcol=1;patientcol=9")
TYPES = ("numeric", "Numeric ", "text", "")
GROUPS = ("n-phs000001-v1-c2", "n-phs1-c2", "phs000002_c10", "phs000003", "phs000004-c1x")


@query(f"""SELECT {planted('p_partkey', 'µaµbµ', 'µaµbµ', 'µaµ', 'µaµ', 'µµ')} AS path, {planted('p_partkey', 'f.csv|1', None, None, None, None, 'f|4', None)} AS key,
  ({planted('p_partkey', '2', '3', '0', '0', '0', '1')})::INT AS patient, {planted('p_partkey', 'NUMERIC', 'NUMERIC', 'TEXT', 'TEXT')} AS type, {planted('p_partkey', 'phs000001|2', None, 'phs000002|10', None, None)} AS consent_group, count(*) AS n FROM part GROUP BY ALL""")
def mapping_functions(spark: SparkSession, d: str) -> DataFrame:
    cells = {"path": PATHS, "key": KEYS, "options": OPTIONS, "kind": TYPES, "name": GROUPS}
    v = T.table(spark, d, "part").selectExpr(*[f"{in_spark(planted('p_partkey', *x))} as {c}" for c, x in cells.items()])
    key, group = S.mapping_key(F.col("key")), S.group_name(F.col("name"))
    rows = v.select(
        S.concept_path(F.col("path")).alias("path"), F.when(key.isNotNull(), F.concat_ws("|", key["file"], key["column"])).alias("key"), S.patient_column(F.col("options")).cast("int").alias("patient"),
        S.data_type(F.col("kind")).alias("type"), F.when(group.isNotNull(), F.concat_ws("|", group["study_id"], group["consent_code"])).alias("consent_group"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query(f"""SELECT {planted('o_orderkey', None, 'a b', 'x', 'q')} AS trimmed, {planted('o_orderkey', 'true', 'false', 'false', None)} AS yes, {planted('o_orderkey', 'true', 'false', None, 'true', None)} AS flag,
  {planted('o_orderkey', 'true', 'false', 'false')} AS study, {planted('o_orderkey', 'a\\tb', 'a\\nb\\r', 'plain')} AS shown, {planted('o_orderkey', 'false', 'false', 'false', 'true', 'true')} AS patient, {planted('o_orderkey', '2', '0', '1')} AS listed, count(*) AS n FROM orders GROUP BY ALL""")
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    def expr(*values: str | None) -> str:
        return planted("o_orderkey", *values).replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n").replace("\r", "\\r")

    cells = {"raw": (" \t", " a b\n", "x", "\x01q "), "yes": (" YES", "no", "", "perhaps"), "flag": ("On", "0", "2", "y", ""), "study": ("phs000001", "phs00001", "xphs000001"), "shown": ("a\tb", "a\nb\r", "plain"),
             "patient": (" ", "# c", "dbGaP_Subject_ID", "D1", " x "), "listed": ("a, ,b", " ,", "c")}
    v = T.table(spark, d, "orders").selectExpr(*[f"{expr(*x)} as {c}" for c, x in cells.items()])
    rows = v.select(
        C.trim_to_null(F.col("raw")).alias("trimmed"), C.yes_no(F.col("yes")).cast("string").alias("yes"), C.bool_literal(F.col("flag")).cast("string").alias("flag"), S.is_study_id(F.col("study")).cast("string").alias("study"),
        C.visible(F.col("shown")).alias("shown"), C.is_patient_cell(F.col("patient")).cast("string").alias("patient"), F.size(C.listed(F.col("listed"))).cast("string").alias("listed"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query(f"""SELECT path, {planted('ord', 'NO_ID', 'BAD_PATH', 'BAD_PATH', 'TWO_VALUES', 'BAD_NUMBER', 'BAD_NUMBER', None)} AS violation, count(*) AS rows FROM legacy_rows GROUP BY ALL""")
def concept_violations(spark: SparkSession, d: str) -> DataFrame:
    at = "pmod(ord, 7)"
    v = T.legacy_rows(spark, d).selectExpr("path", f"if({at} = 0, ' ', old_id) as id", f"case {at} when 1 then substring(path, 2, 99) when 2 then 'µ' else path end as p", f"case {at} when 3 then '1' when 4 then '1,5' when 5 then 'inf' else '' end as number", f"if({at} = 3, 'x', '') as word")
    return v.groupBy("path", S.row_violation(F.col("id"), F.col("p"), F.col("number"), F.col("word")).alias("violation")).agg(F.count("*").alias("rows"))


@query("SELECT study_id FROM (SELECT DISTINCT study_id FROM consents UNION SELECT 'phs000099') WHERE study_id NOT IN (SELECT study_id FROM studies WHERE is_ready)")
def requested_not_ready(spark: SparkSession, d: str) -> DataFrame:
    asked = T.consents(spark, d).select("study_id").unionByName(spark.createDataFrame([("phs000099",)], "study_id string"))
    return J.not_ready(asked, T.studies(spark, d))


@query("SELECT person_id, source_id, source FROM participants WHERE person_id NOT IN (SELECT person_id FROM consents)")
def people_without_consent(spark: SparkSession, d: str) -> DataFrame:
    return R.minus(T.participants(spark, d), T.consents(spark, d), ["person_id"])


@query("SELECT consent_code, side, count(*) AS rows FROM (SELECT consent_code, 'left' AS side FROM (SELECT study_id, consent_code FROM consents EXCEPT ALL SELECT study_id, consent FROM sstr) UNION ALL SELECT consent, 'right' FROM (SELECT study_id, consent FROM sstr EXCEPT ALL SELECT study_id, consent_code FROM consents)) GROUP BY ALL")
def unequal_consents(spark: SparkSession, d: str) -> DataFrame:
    """Rows of consents and of subject rows that the other side lacks."""
    rows = R.unequal(T.consents(spark, d).select("study_id", "consent_code"), T.sstr(spark, d).selectExpr("study_id", "consent as consent_code"))
    return rows.groupBy("consent_code", "side").agg(F.count("*").alias("rows"))


@query("SELECT o_custkey AS person_id, count(*) AS times FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return A.repeated(T.table(spark, d, "orders").selectExpr("o_custkey as person_id"), "person_id")


@query("SELECT study_id, person_id, consent_code, consent_abbreviation FROM consents WHERE study_id = 'phs000007'")
def consents_of_one_study(spark: SparkSession, d: str) -> DataFrame:
    return J.of_study(T.consents(spark, d), "phs000007").select("study_id", "person_id", "consent_code", "consent_abbreviation")


_RAW = """, raw AS (SELECT 'phs' || lpad((p_size)::VARCHAR, 6, '0') AS study_id, p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'SSTR__sstr_' ELSE 'sstr_' END || p_partkey || '.txt' AS sstr,
  'x.pht' || lpad((p_partkey % 4)::VARCHAR, 6, '0') || '.v' || p_partkey || '.xml' AS dictionary, 's.pht' || lpad((p_size % 7)::VARCHAR, 6, '0') || '.Subject.MULTI.txt' AS subject FROM part)
"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "part").selectExpr("concat('phs', lpad(p_size, 6, '0')) as study_id", "p_partkey as k", "concat(if(p_partkey % 3 = 0, 'SSTR__sstr_', 'sstr_'), p_partkey, '.txt') as sstr",
        "concat('x.pht', lpad(p_partkey % 4, 6, '0'), '.v', p_partkey, '.xml') as dictionary", "concat('s.pht', lpad(p_size % 7, 6, '0'), '.Subject.MULTI.txt') as subject")


@query(_RAW + "SELECT study_id, arg_min(sstr, ((sstr LIKE 'SSTR\\_\\_%' ESCAPE '\\')::INT, sstr)) AS sstr, count(*) AS candidates FROM raw GROUP BY 1")
def preferred_files(spark: SparkSession, d: str) -> DataFrame:
    return E.preferred(_raw(spark, d).select("study_id", "sstr"), ["study_id"], F.lower("sstr").startswith("sstr__"), "sstr")


@query(_RAW + """, paired AS (SELECT *, contains(dictionary, regexp_extract(subject, 'pht\\d{6}')) AS pair FROM raw), kept AS (SELECT * FROM paired p WHERE pair OR study_id NOT IN (SELECT study_id FROM paired WHERE pair))
SELECT study_id, arg_max(dictionary, (dictionary[6:11], k)) AS dictionary, count(*) AS candidates FROM kept GROUP BY 1""")
def paired_dictionaries(spark: SparkSession, d: str) -> DataFrame:
    return E.paired_dictionaries(_raw(spark, d).select("study_id", "dictionary", "subject"), ["study_id"], "dictionary", "subject").select("study_id", "dictionary", "candidates")


@query("SELECT event_id, code FROM reports WHERE severity = 'ERROR' ORDER BY ts, event_id LIMIT 1")
def first_failures(spark: SparkSession, d: str) -> DataFrame:
    """The one failure that comes first: a limit that is the operator's own."""
    return E.first_failure(T.reports(spark, d).withColumn("o", F.struct("ts", "event_id")), "o").select("event_id", "code")


@query("SELECT p_brand AS code, arg_min(p_name, p_partkey) AS label FROM part GROUP BY 1")
def first_labels(spark: SparkSession, d: str) -> DataFrame:
    return E.first_labels(T.table(spark, d, "part").selectExpr("p_brand as code", "p_name as label", "p_partkey as pos"), ["code"], "label", "pos")


_PRIOR = ", prior AS (SELECT study_id, CASE WHEN ord % 3 = 0 THEN 'old' ELSE 'now' END AS data_folder, ord % 4 AS mapping_rows, ord % 5 <> 0 AS has_mapping_file FROM studies)\n"


@query(_PRIOR + "SELECT s.study_id, CASE WHEN p.study_id IS NULL THEN 'to do' ELSE 'REUSED' END AS state FROM studies s LEFT JOIN (SELECT * FROM prior WHERE data_folder = 'now' AND mapping_rows > 0 AND has_mapping_file) p USING (study_id)")
def resumed_studies(spark: SparkSession, d: str) -> DataFrame:
    prior = T.studies(spark, d).selectExpr("study_id", "if(ord % 3 = 0, 'old', 'now') as data_folder", "ord % 4 as mapping_rows", "ord % 5 <> 0 as has_mapping_file")
    left, reused = J.to_resume(T.studies(spark, d), prior, "now")
    return left.select("study_id", F.lit("to do").alias("state")).unionByName(reused.select("study_id", F.col("issue").alias("state")))


@query("SELECT study_id, CASE WHEN is_ready AND NOT is_processed THEN CASE ord % 3 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILURE' ELSE 'UNSTABLE' END ELSE 'NOT_RUN' END AS result FROM studies")
def study_result_table(spark: SparkSession, d: str) -> DataFrame:
    ran = J.ready(T.studies(spark, d), processed=False).selectExpr("study_id", "case ord % 3 when 0 then 'SUCCESS' when 1 then 'FAILURE' else 'UNSTABLE' end as result")
    return O.study_results(T.studies(spark, d), ran)


@query(_MIG + "SELECT category, count(*) AS review_items, CASE WHEN category IN ('MISSING_DATA', 'MALFORMED_DATA', 'DATA_MISMATCH') THEN 'NOT_MIGRATED' WHEN category = 'PIPELINE_FAILURE' THEN 'RERUN_NEEDED' ELSE 'MIGRATED_WITH_GAPS' END AS status FROM review GROUP BY 1")
def review_totals(spark: SparkSession, d: str) -> DataFrame:
    return O.review_totals(_migration(spark, d)[2])


_LANED = _RUNS + ", laned AS (SELECT r.*, CASE WHEN ord % 4 = 0 THEN 'own instance' ELSE 'pool' END AS lane FROM results r JOIN studies USING (study_id))\n"


def _laned(spark: SparkSession, d: str) -> DataFrame:
    return _split_runs(spark, d).join(T.studies(spark, d).selectExpr("study_id", "if(ord % 4 = 0, 'own instance', 'pool') as lane"), "study_id")


@query(_LANED + """SELECT lane, count(*) AS studies, count(*) FILTER (outcome = 'SUCCESS') AS succeeded, count(*) FILTER (outcome = 'SUCCESS_WITH_WARNINGS') AS succeeded_with_warnings, count(*) FILTER (outcome = 'FAILED') AS failed, count(*) FILTER (outcome = 'NOT_STARTED') AS not_started,
  count(*) FILTER (outcome = 'FAILED' AND (stage IN ('preflight', 'validation') OR exit_label = 'DATA_ERROR')) AS excluded, count(*) FILTER (outcome = 'NOT_STARTED' OR (outcome = 'FAILED' AND NOT (stage IN ('preflight', 'validation') OR exit_label = 'DATA_ERROR'))) AS to_run_again, sum(total_rows)::BIGINT AS total_rows FROM laned GROUP BY 1""")
def split_lanes(spark: SparkSession, d: str) -> DataFrame:
    return O.split_summary(_laned(spark, d), ["total_rows"], by=["lane"])


@query(_RUNS + "SELECT 'stage' AS \"by\", stage AS value, count(*) AS failed FROM results WHERE outcome = 'FAILED' GROUP BY 2 UNION ALL SELECT 'exit_label', exit_label, count(*) FROM results WHERE outcome = 'FAILED' GROUP BY 2")
def split_failures(spark: SparkSession, d: str) -> DataFrame:
    rows = _split_runs(spark, d)
    return R.union(*[O.failures_by(rows, c).select(F.lit(c).alias("by"), F.col(c).alias("value"), "failed") for c in ("stage", "exit_label")])


# Gates, over counts that miss each rule for some study.


@query(""", c AS (SELECT study_id, count(*) AS n, any_value(ord) AS ord FROM consents JOIN studies USING (study_id) GROUP BY 1)
SELECT study_id, unnest(list_concat(CASE WHEN ord % 5 = 0 THEN ['ERROR CONSENTS_NOT_PARTICIPANTS'] ELSE [] END, CASE WHEN ord % 7 = 1 THEN ['ERROR MORE_INSERTED_THAN_DISTINCT'] ELSE [] END, CASE WHEN ord % 3 = 0 THEN ['ERROR MORE_SAMPLES_THAN_SEEN'] ELSE [] END,
  CASE WHEN ord % 4 = 0 THEN ['ERROR MORE_SAMPLES_THAN_ROWS'] ELSE [] END, CASE WHEN ord % 6 = 0 THEN ['ERROR NO_CONSENT_GROUPS'] ELSE [] END, CASE WHEN ord % 7 = 2 THEN ['WARNING NO_NEW_PARTICIPANTS'] ELSE [] END, CASE WHEN ord % 9 = 4 THEN ['WARNING NO_NEW_SAMPLES'] ELSE [] END)) AS issue FROM c""")
def load_checks(spark: SparkSession, d: str) -> DataFrame:
    per = T.consents(spark, d).join(T.studies(spark, d).select("study_id", "ord"), "study_id").groupBy("study_id", "ord").agg(F.count("*").alias("n"))
    counts = per.selectExpr(
        "study_id", "n as rows_read", "n as distinct_participants", "if(ord % 5 = 0, n + 1, n) as consents_written", "case ord % 7 when 1 then n + 1 when 2 then 0 else n end as participants_inserted",
        "if(ord % 4 = 0, 2 * n + 1, n) as samples_seen", "if(ord % 9 = 4, 0, if(ord % 4 = 0, 2 * n + 1, n)) + if(ord % 3 = 0, 2 * n, 0) as samples_inserted", "if(ord % 6 = 0, 0, 2) as consent_groups")
    return V.load_checks(counts, ["study_id"]).select("study_id", F.concat_ws(" ", "severity", "code").alias("issue"))


@query("SELECT consent_group, severity, code FROM (SELECT study_id || '.c' || consent_code AS consent_group, count(*) AS n FROM consents GROUP BY ALL), (SELECT unnest([{'severity': 'ERROR', 'code': 'GROUP_HELD_BACK', 'k': 1}, {'severity': 'ERROR', 'code': 'GROUP_WITHOUT_SAMPLES', 'k': 2}], recursive := true)) WHERE n % 5 = k UNION ALL SELECT NULL, 'WARNING', 'NOTHING_TO_INDEX'")
def genomic_checks(spark: SparkSession, d: str) -> DataFrame:
    per = T.consents(spark, d).groupBy(S.partition_name(F.col("study_id"), F.col("consent_code")).alias("consent_group")).agg(F.count("*").alias("n"))
    return V.genomic_checks(per.selectExpr("consent_group", "if(n % 5 = 2, 0, n) as samples"), per.where("n % 5 = 1"), 0)


@query("SELECT severity, code FROM (VALUES ('WARNING', 'UNMAPPED'), ('WARNING', 'NO_CONSENT'), ('WARNING', 'FILES_MISSING'), ('WARNING', 'STALE_OUTPUTS'), ('ERROR', 'NO_ROWS')) v(severity, code) WHERE (SELECT count(*) FROM participants) > 0")
def concept_output_checks(spark: SparkSession, d: str) -> DataFrame:
    kinds = T.consents(spark, d).join(T.participants(spark, d), "person_id", "left").groupBy(F.when(F.col("source_id").isNull(), "unmapped").otherwise("no_consent").alias("class")).agg(F.count("*").alias("rows"))
    return V.concept_checks(kinds, T.participants(spark, d).select("source_id"), T.samples(spark, d).select("source_sample_id"))


@query("""SELECT s.study_id, severity, code FROM studies s, (SELECT unnest([{'severity': 'ERROR', 'code': 'BAD_STUDY_ID', 'k': 1}, {'severity': 'WARNING', 'code': 'STUDY_LISTED_AGAIN', 'k': 2}], recursive := true)) WHERE ord % 6 = 2 AND k = 2
UNION ALL SELECT 'x' || study_id, 'ERROR', 'BAD_STUDY_ID' FROM studies WHERE ord % 6 = 1""")
def input_guards(spark: SparkSession, d: str) -> DataFrame:
    rows = T.studies(spark, d).selectExpr("ord", "if(ord % 6 = 1, concat('x', study_id), study_id) as study_id")
    return V.input_guards(rows.unionByName(rows.where("ord % 6 = 2")))


@query("SELECT study_id, 'WARNING' AS severity, CASE ord % 5 WHEN 0 THEN 'STUDY_WITHOUT_CONSENTS' ELSE 'BLANK_ABBREVIATION' END AS code FROM studies WHERE ord % 5 < 2 UNION ALL SELECT NULL, 'ERROR', 'NO_ROWS'")
def global_output_checks(spark: SparkSession, d: str) -> DataFrame:
    """Issues of studies, and the error of a run without any rows."""
    return V.global_checks(T.studies(spark, d).selectExpr("study_id", "0L as rows", "0L as blank_abbreviations", "case ord % 5 when 0 then 'STUDY_WITHOUT_CONSENTS' when 1 then 'BLANK_ABBREVIATION' end as issue"))


@query("SELECT 'kept' AS of, severity, code FROM (SELECT 'WARNING' AS severity, 'NO_READY_STUDIES' AS code) WHERE (SELECT count(*) FROM studies WHERE is_ready AND data_type = 'none') = 0 UNION ALL SELECT 'strict', 'ERROR', 'NO_READY_STUDIES'")
def ready_gates(spark: SparkSession, d: str) -> DataFrame:
    """No study of a kind that none has is ready; all studies together pass."""
    none = T.studies(spark, d).withColumn("is_ready", F.col("is_ready") & (F.col("data_type") == "none"))
    return R.union(V.ready_gate(none, False).select(F.lit("kept").alias("of"), "*"), V.ready_gate(none, True).select(F.lit("strict").alias("of"), "*"), V.ready_gate(T.studies(spark, d), True).select(F.lit("all").alias("of"), "*"))


@query("SELECT 'WARNING' AS severity, 'IDENTITY_IN_SEVERAL_CONSENTS' AS code FROM (SELECT 1) WHERE (SELECT count(*) FROM (SELECT study_id, identity FROM (SELECT DISTINCT study_id, consent_code, unnest(ids) AS identity FROM raw_ids) GROUP BY ALL HAVING count(*) > 1)) > 0")
def identity_map_checks(spark: SparkSession, d: str) -> DataFrame:
    from cohortflow.plans.jobs import identity_map

    rows = identity_map(T.raw_identities(spark, d))[0]
    return V.identity_checks(rows, A.cross_consent(rows))


@query("""SELECT 'job-' || study_id AS job, unnest(list_concat(CASE WHEN errors > 0 THEN ['ERRORS'] ELSE [] END, CASE WHEN n % 3 = 0 THEN ['WRONG_RUN'] ELSE [] END, CASE WHEN n % 4 = 0 THEN ['BAD_EXIT_CODE', 'NOT_SUCCESSFUL'] ELSE [] END, CASE WHEN n % 5 = 0 THEN ['ERROR_MESSAGE'] ELSE [] END)) AS code
FROM (SELECT study_id, count(*) AS n, count(*) FILTER (severity = 'ERROR' AND event_id % 2 = 0) AS errors FROM reports GROUP BY 1)""")
def report_gates(spark: SparkSession, d: str) -> DataFrame:
    per = T.reports(spark, d).groupBy("study_id").agg(F.count("*").alias("n"), F.count_if(F.expr("severity = 'ERROR' and event_id % 2 = 0")).alias("errors"))
    zero = F.struct(F.struct(F.lit(0).alias("error")).alias("counts"))
    rows = per.select(
        F.concat(F.lit("job-"), "study_id").alias("jobName"), F.expr("if(n % 3 = 0, 'old', 'r')").alias("runId"), F.expr("if(n % 4 = 0, 'FAILED', 'SUCCESS')").alias("status"), F.expr("if(n % 4 = 0, 'DATA_ERROR', 'SUCCESS')").alias("exitCode"),
        zero.alias("inputValidation"), F.struct(F.struct(F.col("errors").alias("error")).alias("counts")).alias("outputValidation"), F.expr("if(n % 5 = 0, 'broke', null)").alias("errorMessage"))
    return V.report_checks(rows, F.col("jobName"), "r", ["jobName"]).select(F.col("jobName").alias("job"), "code")


@query("""SELECT CASE WHEN s = 'SUBJECTS_NOT_CONSENTED' THEN 'INFO' ELSE 'WARNING' END AS severity, s AS code, n AS count FROM (SELECT CASE consent WHEN '0' THEN 'SUBJECTS_NOT_CONSENTED' WHEN '1' THEN 'CONSENT_CONFLICT' ELSE 'SAMPLES_OF_UNKNOWN_SUBJECTS' END AS s, count(*) AS n FROM sstr GROUP BY 1)
UNION ALL SELECT 'WARNING', unnest(['CONSENT_VARIABLE_NOT_IN_DATA_DICT', 'SAMPLE_MULTI_UNREADABLE']), 1""")
def multi_load_issues(spark: SparkSession, d: str) -> DataFrame:
    tally = T.sstr(spark, d).groupBy(F.expr("case consent when '0' then 'SUBJECTS_NOT_CONSENTED' when '1' then 'CONSENT_CONFLICT' else 'SAMPLES_OF_UNKNOWN_SUBJECTS' end").alias("code")).agg(F.count("*").alias("count"))
    return V.multi_issues(tally, True, True, False, False)


@query("""SELECT study_id, 'ERROR' AS severity, unnest(list_concat(CASE WHEN n = 0 AND outcome = 'success' THEN ['NO_MAPPING'] ELSE [] END, CASE WHEN n <> claimed AND outcome = 'success' THEN ['MAPPING_ROWS_DIFFER'] ELSE [] END,
  CASE WHEN n > 0 AND outcome IN ('skipped', 'failed') THEN ['MAPPING_WITHOUT_RESULT'] ELSE [] END, CASE WHEN n < subjects AND outcome = 'success' THEN ['SUBJECTS_NOT_COVERED'] ELSE [] END, CASE WHEN outcome = 'lost' THEN ['UNKNOWN_OUTCOME'] ELSE [] END)) AS code
FROM (SELECT s.study_id, coalesce(n, 0) AS n, coalesce(n, 0) + CASE WHEN ord % 4 = 1 THEN 1 ELSE 0 END AS claimed, CASE WHEN ord % 7 = 6 THEN coalesce(n, 0) + 5 ELSE 0 END AS subjects,
    CASE WHEN ord = 24 THEN 'lost' WHEN ord % 5 = 3 THEN 'skipped' WHEN ord % 5 = 4 THEN 'failed' ELSE 'success' END AS outcome
  FROM studies s LEFT JOIN (SELECT study_id, count(*) AS n FROM consents WHERE consent_code <> '0' AND study_id NOT LIKE '%2' GROUP BY 1) USING (study_id))
UNION ALL SELECT NULL, 'ERROR', 'OUTCOMES_NOT_READY_STUDIES'""")
def migration_run_checks(spark: SparkSession, d: str) -> DataFrame:
    mapped = T.consents(spark, d).where("consent_code <> '0' and study_id not like '%2'").select("study_id")
    n = mapped.groupBy("study_id").agg(F.count("*").alias("n"))
    results = T.studies(spark, d).join(n, "study_id", "left").selectExpr(
        "study_id", "coalesce(n, 0) + if(ord % 4 = 1, 1, 0) as mapping_rows", "if(ord % 7 = 6, coalesce(n, 0) + 5, 0) as subjects", "case when ord = 24 then 'lost' when ord % 5 = 3 then 'skipped' when ord % 5 = 4 then 'failed' else 'success' end as outcome")
    return V.migration_checks(results, mapped, T.studies(spark, d).where("is_ready").count())
