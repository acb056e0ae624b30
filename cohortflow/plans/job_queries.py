"""Registered queries of whole jobs: concepts by file, the merge of concept files, and a migration from its files to its outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import cells as C
from cohortflow.plans import adapter as T
from cohortflow.plans import concepts as G
from cohortflow.plans import jobs as K
from cohortflow.plans import migration as M
from cohortflow.plans.queries import query, split_concepts
from cohortflow.sources import files as FI
from cohortflow.sources import sinks
from cohortflow.sources import study_files as SF
from cohortflow.sources.scratch import new_path, written
from cohortflow.sources.streams import merge_bytes

#: Columns of the two data files there are, and what the mapping says of each; a third file is not there.
FILES = {"main.csv": ("patient", "quantity", "price", "flag"), "other.csv": ("status", "discount", "empty_column", "patient")}
MAPPED = [(f, i, f"µ{f}µ{c}µ", "NUMERIC" if i % 2 else "TEXT", 0 if f == "main.csv" else 3) for f, columns in FILES.items() for i, c in enumerate(columns) if c != "patient"]
MAPPED += [("gone.csv", 1, "µgoneµ", "TEXT", 0), ("main.csv", 9, "µbeyondµ", "TEXT", 0)]

_FILES = """
, cells AS (
  SELECT patient, line, 'main.csv' AS file, unnest(['quantity', 'price', 'flag']) AS field, unnest([quantity, price, flag]) AS value FROM decoded
  UNION ALL SELECT patient, line, 'other.csv', unnest(['status', 'discount', 'empty_column']), unnest([status, discount, empty_column]) FROM decoded),
vals AS (SELECT *, lower(trim(value)) IN ('', 'null', 'na', 'n/a', 'nan', 'nil', 'nill') AS none FROM cells),
typed AS (SELECT file, field, CASE WHEN count(*) FILTER (NOT none AND NOT regexp_matches(trim(value), '{NUMBER}')) > 0 THEN 'TEXT' ELSE 'NUMERIC' END AS type FROM vals GROUP BY ALL HAVING count(*) FILTER (NOT none) > 0),
classed AS (
  SELECT v.file, patient, study_id, consent_code, person_id, 'µ' || v.file || 'µ' || field || 'µ' AS path, type, CASE WHEN person_id IS NULL THEN 'unmapped' WHEN consent_code IS NULL THEN 'no_consent' ELSE 'written' END AS class
  FROM vals v JOIN typed USING (file, field) LEFT JOIN participants ON source_id = patient LEFT JOIN consents USING (person_id)
  WHERE NOT none AND NOT (file = 'main.csv' AND line = 7) AND line <> 6)
""".replace("{NUMBER}", C.NUMBER)


def data_files(spark: SparkSession, d: str) -> str:
    """The two data files below a new folder; rows of line 7 of the first have a cell too many, those of line 6 name no patient.

    All tasks write lines of both files, in no order but that the headers are first; their bytes are then put together.
    """
    rows = T.decoded(spark, d).withColumn("patient", F.expr("if(line = 6, concat('#', patient), patient)"))
    base, stage = new_path(spark, "data"), new_path(spark, "data-staged")
    own = []
    for f, columns in FILES.items():
        value = F.concat_ws(",", *[C.csv_quote(F.coalesce(c, F.lit(""))) for c in columns])
        own.append(F.struct(F.lit(f).alias("at"), F.lit("rows").alias("part"), (F.when(F.col("line") == 7, F.concat(value, F.lit(",more"))).otherwise(value) if f == "main.csv" else value).alias("value")))
    lines = rows.select(F.explode(F.array(*own)).alias("l")).select("l.*")
    heads = spark.createDataFrame([(f, "head", ",".join(columns)) for f, columns in FILES.items()], "at string, part string, value string")
    lines.unionByName(heads).write.partitionBy("at", "part").text(stage)
    files = sinks.written_files(spark, stage, "at", "part").select(F.concat(F.lit(f"{base}/"), "at").alias("target"), "path")
    bad = written(merge_bytes(files, "target", "path", "path"), "data-files").where("error is not null").head()
    if bad is not None:
        raise OSError(f"{bad['target']}: {bad['error']}")
    return base


def _of_files(spark: SparkSession, d: str):
    mapping = spark.createDataFrame(MAPPED, "file string, column int, path string, declared string, patient_column int")
    return G.concepts_of_files(spark, data_files(spark, d), mapping, T.participants(spark, d), T.consents(spark, d))


@query(_FILES + "SELECT file, study_id, consent_code, path, count(*) AS rows, count(DISTINCT person_id) AS people, count(*) FILTER (type = 'NUMERIC') AS numbers FROM classed WHERE class = 'written' GROUP BY ALL")
def file_concepts(spark: SparkSession, d: str) -> DataFrame:
    rows = _of_files(spark, d)[0].where("class = 'written'")
    return rows.groupBy("file", "study_id", "consent_code", "path").agg(F.count("*").alias("rows"), F.count_distinct("person_id").alias("people"), F.count_if(F.col("numeric") != "").alias("numbers"))


@query(_FILES + """SELECT file, (SELECT count(*) FROM decoded) AS rows, CASE file WHEN 'main.csv' THEN (SELECT count(*) FROM decoded WHERE line = 7) ELSE 0 END AS malformed, (SELECT count(*) FROM decoded WHERE line = 6) AS not_patients,
  count(*) FILTER (class = 'written') AS written, count(*) FILTER (class = 'unmapped') AS unmapped, count(*) FILTER (class = 'no_consent') AS no_consent, count(DISTINCT CASE class WHEN 'unmapped' THEN patient END) AS unmapped_ids FROM classed GROUP BY 1""")
def file_concept_counts(spark: SparkSession, d: str) -> DataFrame:
    return _of_files(spark, d)[1]


_STUDY = "phs000004"
_GENERATED = _FILES + f", own AS (SELECT c.* FROM classed c LEFT JOIN participants p ON p.source_id = c.patient WHERE c.study_id = '{_STUDY}')\n"


def _generated(spark: SparkSession, d: str):
    """A study's concept files, over those of an earlier run that had another group; without and with a file missing."""
    own = [(f"{f}:{i}", "", f"µ{f}µ{c}µ", "NUMERIC" if i % 2 else "TEXT", "" if f == "main.csv" else "patientcol=3") for f, columns in FILES.items() for i, c in enumerate(columns) if c != "patient"]
    out, data = new_path(spark, "generated"), data_files(spark, d)
    old = spark.createDataFrame([("1", "µoldµ", "", "x", "0", _STUDY, c) for c in ("2", "77")], "person_id string, path string, numeric string, text string, timestamp string, study_id string, consent_code string")
    told = []
    for extra in ([], [("gone.csv:1", "µgoneµ", "x", "TEXT", "")]):
        rows = [(k, p.strip("µ").split("µ")[0] if not r else r, p.strip("µ").split("µ")[-1], t, o) for k, r, p, t, o in [*own, *extra]]
        lines = spark.createDataFrame([(",".join(r),) for r in rows], "value string")
        lines.coalesce(1).write.text(at := new_path(spark, "mapping"))
        sinks.write_concepts(old, stage := new_path(spark, "old"))
        sinks.publish_concepts(spark, stage, out)
        told.append(G.generate_concepts(spark, _STUDY, data, at, T.participants(spark, d), T.consents(spark, d), out))
    return out, told


@query(_GENERATED + "SELECT 'c' || consent_code AS label, count(*) AS rows, count(DISTINCT person_id) AS people, count(*) FILTER (type = 'NUMERIC') AS numbers FROM own WHERE class = 'written' GROUP BY 1 UNION ALL SELECT 'c77', 1, 1, 0 UNION ALL SELECT 'c2', 1, 1, 0 WHERE NOT EXISTS (SELECT 1 FROM own WHERE class = 'written' AND consent_code = '2')")
def generated_concepts(spark: SparkSession, d: str) -> DataFrame:
    """The concept files that stand after two runs: the second misses a file, so that the group of an earlier run stays."""
    out, _ = _generated(spark, d)
    rows = SF.read_all_concepts(spark, f"{out}/*/allConcepts/*/*.csv").withColumn("label", F.regexp_extract(F.col("_metadata.file_path"), "/(c[^/]+)/[^/]+$", 1))
    return rows.where("not malformed").groupBy("label").agg(F.count("*").alias("rows"), F.count_distinct("person_id").alias("people"), F.count_if(F.col("numeric") != "").alias("numbers"))


@query(_GENERATED + f"""SELECT run, severity, code FROM (SELECT unnest([1, 2]) AS run), (
  SELECT 'WARNING' AS severity, 'MALFORMED' AS code, count(*) AS n FROM decoded WHERE line = 7
  UNION ALL SELECT 'WARNING', 'UNMAPPED', count(*) FROM vals v JOIN typed USING (file, field) LEFT JOIN (SELECT DISTINCT source_id FROM participants JOIN consents USING (person_id) WHERE study_id = '{_STUDY}') p ON p.source_id = patient WHERE NOT none AND NOT (file = 'main.csv' AND line = 7) AND line <> 6 AND p.source_id IS NULL
  UNION ALL SELECT 'WARNING', 'STALE_OUTPUTS', 1) WHERE n > 0 UNION ALL SELECT 2, 'WARNING', 'FILES_MISSING'""")
def generated_checks(spark: SparkSession, d: str) -> DataFrame:
    """What the gates say of the two runs."""
    _, told = _generated(spark, d)
    a, b = (t["checks"].withColumn("run", F.lit(i)) for i, t in enumerate(told, 1))
    return a.unionByName(b).select("run", "severity", "code")


_SOURCES = """, lined AS (
  SELECT study_id, 'c' || consent_code AS label, study_id || '_allConcepts_' || (person_id % 3) || '.csv' AS name, lpad(person_id::VARCHAR, 9, '0') || path || numeric || text AS o, '"' || person_id || '","' || path || '","' || numeric || '","' || text || '","0"' AS value
  FROM legacy_rows JOIN id_mapping USING (old_id) JOIN consents USING (person_id))
"""


@query(_SOURCES + "SELECT study_id, label, sum(octet_length(encode(value)) + 1)::BIGINT AS bytes, md5(string_agg(value || chr(10), '' ORDER BY name, o)) AS md5 FROM lined WHERE label <> 'c3' GROUP BY ALL")
def merged_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Three sources to a folder, merged where the plan says so: folders of c3 have a merged file that is up to date."""
    rows = split_concepts(spark, d).withColumns({"timestamp": F.lit("0"), "label": F.concat(F.lit("c"), "consent_code"), "name": F.expr("concat(study_id, '_allConcepts_', person_id % 3, '.csv')")})
    rows = rows.select("study_id", "label", "name", F.expr("concat(lpad(person_id, 9, '0'), path, numeric, text)").alias("o"), sinks.concept_line().alias("value"))
    stage, root = new_path(spark, "sources"), new_path(spark, "folders")
    rows.repartition("study_id", "label", "name").sortWithinPartitions("study_id", "label", "name", "o").drop("o").write.partitionBy("study_id", "label", "name").text(stage)
    sinks.move_files(sinks.written_files(spark, stage, "study_id", "label", "name").selectExpr("path", "concat(study_id, '/allConcepts/', label, '/', name) as name"), root)
    files = FI.file_inventory(spark, root)
    folders = K.consent_folders(files)
    done = F.col("label") == "c3"
    folders = folders.withColumns({"merged_version": F.when(done, F.lit("v1")), "recorded_fingerprint": F.when(done, F.col("fingerprint")), "recorded_md5": F.when(done, F.lit("m"))})
    return K.merge_files(files, K.merge_plan(folders), new_path(spark, "merged")).drop("files", "error")


# A migration from raw files. By a study's place in the list, modulo 10:
# 0 a good subject-sample table and a copy, 1 a bad one beside good tables, 2 a bad one alone, 3 tables without a dictionary,
# 4 a subject table without consents, 5 no file, 6 a mapping of strangers, 7 a mapping with a short row, 8 no mapping, 9 a bad sample table and dictionary.
_RAW_CODE = "CASE WHEN ord % 11 = 0 THEN '' WHEN ord % 11 = 1 THEN 'x' ELSE '0' || consent END"
_RUN = f"""
, listed AS (SELECT ord AS place, ord % 10 AS k, study_id, abv FROM studies WHERE is_ready),
reused AS (SELECT * FROM listed WHERE place % 6 = 5 AND place % 4 > 0),
chosen AS (SELECT *, CASE WHEN k IN (0, 6) THEN 'SSTR' WHEN k IN (1, 3, 9) THEN 'MULTI' END AS source FROM listed WHERE study_id NOT IN (SELECT study_id FROM reused)),
coded AS (SELECT s.*, source, k, CASE WHEN source = 'SSTR' THEN consent WHEN regexp_matches({_RAW_CODE}, '^[0-9]+$') THEN coalesce(nullif(ltrim({_RAW_CODE}, '0'), ''), '0') END AS code FROM sstr s JOIN chosen USING (study_id) WHERE source IS NOT NULL),
firsts AS (SELECT study_id, source, k, dbgap_subject_id AS dbgap_id, any_value(subject_id) AS subject_id, arg_min(code, ord) FILTER (source = 'SSTR' OR code <> '0') AS code, bool_or(coalesce(code = '0', FALSE)) AS zero FROM coded GROUP BY ALL),
loaded AS (SELECT * FROM firsts WHERE code IS NOT NULL),
refused AS (SELECT * FROM firsts WHERE code IS NULL AND zero),
told AS (
  SELECT m.study_id, m.old_id, CASE WHEN a.dbgap_id IS NOT NULL THEN 'mapped' WHEN n.dbgap_id IS NOT NULL THEN 'not_consented' ELSE 'not_in_file' END AS resolution
  FROM (SELECT study_id, k, CASE WHEN k = 6 THEN 'Z' || id ELSE id END AS id, old_id FROM patient_mapping JOIN chosen USING (study_id) WHERE source IS NOT NULL) m
  LEFT JOIN loaded a ON a.study_id = m.study_id AND m.id IN (a.dbgap_id, a.subject_id) LEFT JOIN refused n ON n.study_id = m.study_id AND m.id IN (n.dbgap_id, n.subject_id)),
per AS (SELECT study_id, count(*) FILTER (resolution = 'mapped') AS mapping_rows, count(*) FILTER (resolution <> 'mapped') AS unresolved_rows FROM told GROUP BY 1)
"""
_DICTIONARY = '<data_table><variable id="v1"><name>other</name><value code="1">no</value></variable><variable id="v2"><name>Consent</name><value code="1">General (GRU)</value><value code="2">Health</value></variable></data_table>'


def raw_files(spark: SparkSession, d: str) -> str:
    """The raw files of all studies below a new folder."""
    base, stage = new_path(spark, "raw"), new_path(spark, "raw-staged")
    s, rows = T.studies(spark, d).selectExpr("ord as place", "ord % 10 as k", "study_id", "abv"), T.sstr(spark, d)

    def file(ks: tuple[int, ...], folder: str, name: str, value: str, body: DataFrame | None = None, *heads: str) -> DataFrame:
        """Lines of one file for each of the studies ``ks``: heads, then a line for each row of ``body``; both are expressions."""
        own = s.where(F.col("k").isin(*ks)).withColumns({"at": F.expr(f"concat('{folder}/', {name})")})
        top = own.select("study_id", "at", F.posexplode(F.array(*map(F.expr, heads))).alias("n", "value")).selectExpr("study_id", "at", "cast(n as long) - 100 as n", "value")
        if body is None:
            return top
        return top.unionByName(own.join(body, "study_id").selectExpr("study_id", "at", "cast(ord as long) as n", f"{value} as value"))

    code = _RAW_CODE.replace("||", "^").replace("'0' ^ consent", "concat('0', consent)")
    tab = "concat_ws('\t', {})".format
    mapping = T.patient_mapping(spark, d).withColumn("ord", F.col("old_id").cast("long"))
    raw, old = "rawData", "legacy/data"
    every = [
        file((0, 6, 7, 8), raw, "concat('SSTR_', study_id, '.v1.txt')", tab("subject_id, sample_id, consent, 'GRU', dbgap_subject_id, dbgap_sample_id"), rows, tab("'SUBJECT_ID', 'SAMPLE_ID', 'CONSENT', 'consent_abbreviation', 'dbgap_subject_id', 'dbgap_sample_id'")),
        file((0,), raw, "concat('BDC-Ingestion-Only__sstr_', study_id, '.txt')", "''", None, "'nothing of use'"),
        file((1,), raw, "concat('sstr_', study_id, '.txt')", tab("'GRU', dbgap_subject_id, dbgap_sample_id, subject_id, if(ord % 3 = 0, ' ', consent)"), rows, tab("'consent_abbreviation', 'dbgap_subject_id', 'dbgap_sample_id', 'SUBJECT_ID', 'CONSENT'")),
        file((2,), raw, "concat('sstr_', study_id, '.txt')", tab("subject_id, consent, 'GRU', dbgap_subject_id"), rows, tab("'SUBJECT_ID', 'CONSENT', 'consent_abbreviation', 'dbgap_subject_id'")),
        file((1, 3, 9), raw, "concat(study_id, '.v10.pht000001.Subject.MULTI.txt')", tab(f"dbgap_subject_id, subject_id, {code}"), rows, "'# made for a test'", tab("'dbGaP_Subject_ID', 'SUBJECT_ID', 'CONSENT'")),
        file((3,), raw, "concat(study_id, '.v2.pht000001.Subject.MULTI.txt')", "''", None, "'an older one'"),
        file((4,), raw, "concat(study_id, '.v1.pht000001.Subject.MULTI.txt')", tab("dbgap_subject_id, consent"), rows, tab("'dbGaP_Subject_ID', 'other'")),
        file((1, 3), raw, "concat(study_id, '.pht000002.Sample.MULTI.txt')", tab("sample_id, dbgap_subject_id, dbgap_sample_id"), rows, tab("'SAMPID', 'dbGaP SubjID', 'dbGaP_Sample_ID'")),
        file((9,), raw, "concat(study_id, '.pht000002.Sample.MULTI.txt')", tab("dbgap_subject_id, sample_id"), rows, tab("'dbGaP_Subject_ID', 'SAMPLE_ID'")),
        file((1,), raw, "concat(study_id, '.pht000001.v1.Subject.data_dict.xml')", "''", None, f"'{_DICTIONARY}'"),
        file((9,), raw, "concat(study_id, '.pht000001.v1.Subject.data_dict.xml')", "''", None, "'no dictionary'"),
        file((0, 1, 2, 3, 4, 5, 9), old, "concat(abv, '_PatientMapping.v2.csv')", "concat_ws(',', id, abv, concat('\"', old_id, '\"'))", mapping),
        file((6,), old, "concat(abv, '_PatientMapping.v2.csv')", "concat_ws(',', concat('Z', id), abv, old_id)", mapping),
        file((7,), old, "concat(abv, '_PatientMapping.v2.csv')", "concat_ws(',', id, abv, old_id)", mapping, "'x,y'"),
    ]
    lines = every[0]
    for f in every[1:]:
        lines = lines.unionByName(f)
    lines.repartition("study_id", "at").sortWithinPartitions("study_id", "at", "n").drop("n").write.partitionBy("study_id", "at").text(stage)
    sinks.move_files(sinks.written_files(spark, stage, "study_id", "at").selectExpr("path", "concat(study_id, '/', at) as name"), base)
    return base


def _migrated(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    s = T.studies(spark, d)
    prior = s.selectExpr("study_id", "if(ord % 6 = 5, 'now', 'old') as data_folder", "ord % 4 as mapping_rows", "true as has_mapping_file")
    return M.migrate_folders(spark, raw_files(spark, d), s, T.participants(spark, d), T.consents(spark, d), T.samples(spark, d), prior, "now")


@query(_RUN + """SELECT place AS ord, c.study_id, abv, source, coalesce(mapping_rows, 0) AS mapping_rows, coalesce(unresolved_rows, 0) AS unresolved_rows,
  CASE WHEN k = 5 THEN 'skipped' WHEN source IS NULL THEN 'failed' WHEN coalesce(mapping_rows, 0) = 0 THEN 'needs_review' ELSE 'success' END AS outcome,
  CASE WHEN k = 5 THEN 'skipped_no_files' WHEN k = 2 THEN 'failed_no_source' WHEN k = 4 THEN 'failed_multi' WHEN source IS NULL THEN 'failed_other' WHEN coalesce(mapping_rows, 0) = 0 THEN 'skipped_needs_review' WHEN source = 'SSTR' THEN 'loaded_sstr' WHEN k = 1 THEN 'loaded_multi_sstr_malformed' ELSE 'loaded_multi' END AS class FROM chosen c LEFT JOIN per USING (study_id)
UNION ALL SELECT place, study_id, abv, NULL, place % 4, 0, 'success', 'reused' FROM reused""")
def migration_run(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of all studies, with files of every kind of fault."""
    return _migrated(spark, d)["outcomes"]


@query(_RUN + """SELECT study_id, consent_code, count(*) AS people FROM (
  SELECT study_id, consent_code FROM consents WHERE study_id NOT IN (SELECT study_id FROM loaded) UNION ALL SELECT study_id, code FROM loaded) GROUP BY ALL""")
def migrated_consents(spark: SparkSession, d: str) -> DataFrame:
    return _migrated(spark, d)["consents"].groupBy("study_id", "consent_code").agg(F.count("*").alias("people"))


@query(_RUN + """, multi AS (SELECT c.*, l.code AS first_code, r.dbgap_id IS NOT NULL AS no FROM coded c LEFT JOIN loaded l ON l.study_id = c.study_id AND l.dbgap_id = c.dbgap_subject_id LEFT JOIN refused r ON r.study_id = c.study_id AND r.dbgap_id = c.dbgap_subject_id WHERE c.source = 'MULTI'),
said AS (
  SELECT study_id, 'ERROR' AS severity, 'PATIENT_MAPPING_UNUSABLE' AS code, CASE k WHEN 7 THEN 'SHORT_OR_BLANK_ROW' ELSE 'EMPTY' END AS example, '' AS o FROM chosen WHERE k IN (7, 8)
  UNION ALL SELECT study_id, 'WARNING', 'MULTIPLE_SSTR_CANDIDATES', unnest(['SSTR_' || study_id || '.v1.txt', NULL]), '' FROM chosen WHERE k = 0
  UNION ALL SELECT study_id, 'WARNING', 'SSTR_MALFORMED', CASE k WHEN 1 THEN 'BLANK_CONSENT' ELSE 'NO_COLUMN_DBGAP_SAMPLE_ID' END, '' FROM chosen WHERE k IN (1, 2)
  UNION ALL SELECT study_id, 'ERROR', 'NO_PARTICIPANT_SOURCE', 'sstr_' || study_id || '.txt', '' FROM chosen WHERE k = 2
  UNION ALL SELECT study_id, 'WARNING', 'NO_PARTICIPANT_FILES', NULL, '' FROM chosen WHERE k = 5
  UNION ALL SELECT study_id, 'WARNING', 'MULTIPLE_SUBJECT_MULTI_CANDIDATES', unnest([study_id || '.v10.pht000001.Subject.MULTI.txt', NULL]), '' FROM chosen WHERE k = 3
  UNION ALL SELECT study_id, 'INFO', 'NO_SAMPLE_MULTI', NULL, '' FROM chosen WHERE k = 4
  UNION ALL SELECT study_id, 'ERROR', 'MULTI_LOAD_FAILED', 'NO_COLUMN_CONSENT', '' FROM chosen WHERE k = 4
  UNION ALL SELECT study_id, 'WARNING', 'SAMPLE_MULTI_UNREADABLE', 'NO_COLUMN_SAMPLE', '' FROM chosen WHERE k = 9
  UNION ALL SELECT study_id, 'WARNING', 'NO_DATA_DICT', NULL, '' FROM chosen WHERE k = 3
  UNION ALL SELECT study_id, 'WARNING', 'DATA_DICT_UNREADABLE', study_id || '.pht000001.v1.Subject.data_dict.xml', '' FROM chosen WHERE k = 9
  UNION ALL SELECT DISTINCT study_id, 'WARNING', CASE WHEN k = 1 AND code = '2' THEN 'CONSENT_LABEL_WITHOUT_ABBREVIATION' ELSE 'CONSENT_CODE_NOT_DECODED' END, code, code FROM loaded WHERE source = 'MULTI' AND NOT (k = 1 AND code = '1')
  UNION ALL SELECT study_id, 'WARNING', 'CONSENT_CONFLICT', dbgap_subject_id || '=' || first_code || '/' || code, lpad(ord::VARCHAR, 12, '0') FROM multi WHERE code <> '0' AND code <> first_code
  UNION ALL SELECT study_id, 'INFO', 'SUBJECTS_NOT_CONSENTED', dbgap_id, dbgap_id FROM refused
  UNION ALL SELECT study_id, CASE WHEN no THEN 'INFO' ELSE 'WARNING' END, CASE WHEN no THEN 'SAMPLES_OF_UNCONSENTED_SUBJECTS' ELSE 'SAMPLES_OF_UNKNOWN_SUBJECTS' END, dbgap_subject_id, lpad(ord::VARCHAR, 12, '0') FROM multi WHERE k <> 9 AND first_code IS NULL AND (dbgap_sample_id <> '' OR sample_id <> '')
  UNION ALL SELECT study_id, CASE resolution WHEN 'not_consented' THEN 'INFO' ELSE 'WARNING' END, CASE resolution WHEN 'not_consented' THEN 'PATIENT_MAPPING_NOT_CONSENTED' ELSE 'PATIENT_MAPPING_UNRESOLVED' END, old_id, old_id FROM told WHERE resolution <> 'mapped')
SELECT study_id, severity, code, count(*) AS count, coalesce(array_to_string((list(example ORDER BY o) FILTER (example IS NOT NULL))[:10], ','), '') AS examples FROM said GROUP BY ALL""")
def migration_issues(spark: SparkSession, d: str) -> DataFrame:
    return _migrated(spark, d)["issues"].withColumn("examples", F.array_join("examples", ","))


@query(_RUN + """SELECT study_id, severity, code FROM (
  SELECT study_id, 'WARNING' AS severity, 'NO_NEW_PARTICIPANTS' AS code, count(*) FILTER (dbgap_id NOT IN (SELECT source_id FROM participants)) AS n FROM loaded WHERE source = 'SSTR' GROUP BY 1)
WHERE n = 0""")
def migration_gates(spark: SparkSession, d: str) -> DataFrame:
    """What the gates of loads and outcomes say of a migration that ran: nothing is wrong, some studies bring nobody new."""
    return _migrated(spark, d)["checks"]
