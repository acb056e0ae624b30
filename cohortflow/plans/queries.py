"""Registered queries: operators and jobs applied to the adapter's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions import cells as C
from cohortflow.functions import studies as S
from cohortflow.operators import aggregates as A
from cohortflow.operators import dedup as E
from cohortflow.operators import identity as I
from cohortflow.operators import joins as J
from cohortflow.operators import reshape as R
from cohortflow.plans import adapter as T
from cohortflow.plans import gates as V
from cohortflow.plans import jobs as K
from cohortflow.plans import outcomes as O


QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = T.sql(sql)
        return f

    return add


@query("""
, own AS (SELECT c.* FROM consents c JOIN studies s USING (study_id) WHERE is_ready),
people AS (SELECT DISTINCT study_id, person_id, source_id, source FROM own JOIN participants USING (person_id)),
tubes AS (SELECT DISTINCT study_id, person_id, source_sample_id, sample_source FROM own JOIN samples USING (person_id))
SELECT study_id, person_id::VARCHAR AS person_id, path, '' AS numeric, text, '0' AS timestamp FROM (
  SELECT study_id, person_id, 'µ_consentsµ' AS path, study_id || '.c' || consent_code AS text FROM own
  UNION ALL SELECT study_id, person_id, 'µ_source_subject_idµ', source_id FROM people
  UNION ALL SELECT study_id, person_id, 'µ_source_sample_idµ', source_sample_id FROM tubes
  UNION ALL SELECT study_id, person_id, 'µ_studies_consentsµ' || study_id || 'µ', 'TRUE' FROM own
  UNION ALL SELECT study_id, person_id, 'µ_studies_consentsµ' || study_id || 'µ' || consent_abbreviation || 'µ', 'TRUE' FROM own WHERE consent_abbreviation <> '')
""")
def global_concepts(spark: SparkSession, d: str) -> DataFrame:
    return K.global_concepts(T.studies(spark, d), T.participants(spark, d), T.consents(spark, d), T.samples(spark, d))[0]


@query("""
SELECT s.study_id, coalesce(n.rows, 0) AS rows, coalesce(b.blank, 0) AS blank_abbreviations, CASE WHEN n.rows IS NULL THEN 'STUDY_WITHOUT_CONSENTS' WHEN b.blank > 0 THEN 'BLANK_ABBREVIATION' END AS issue
FROM (SELECT study_id FROM studies WHERE is_ready) s
LEFT JOIN (SELECT study_id, sum(n)::BIGINT AS rows FROM (
  SELECT study_id, count(*) * 2 + count(*) FILTER (consent_abbreviation <> '') AS n FROM consents GROUP BY 1
  UNION ALL SELECT study_id, count(DISTINCT (person_id, source_id, source)) FROM consents JOIN participants USING (person_id) GROUP BY 1
  UNION ALL SELECT study_id, count(DISTINCT (person_id, source_sample_id, sample_source)) FROM consents JOIN samples USING (person_id) GROUP BY 1) GROUP BY 1) n USING (study_id)
LEFT JOIN (SELECT study_id, count(*) FILTER (consent_abbreviation = '') AS blank FROM consents GROUP BY 1) b USING (study_id)
""")
def global_study_counts(spark: SparkSession, d: str) -> DataFrame:
    return K.global_concepts(T.studies(spark, d), T.participants(spark, d), T.consents(spark, d), T.samples(spark, d))[1]


@query("SELECT DISTINCT study_id, person_id, source_id, source FROM consents JOIN participants USING (person_id)")
def study_participants(spark: SparkSession, d: str) -> DataFrame:
    return J.study_participants(T.participants(spark, d), T.consents(spark, d))


@query("SELECT DISTINCT study_id, person_id, source_sample_id, sample_source FROM consents JOIN samples USING (person_id) JOIN studies USING (study_id) WHERE is_ready")
def study_samples(spark: SparkSession, d: str) -> DataFrame:
    return J.of_ready(T.studies(spark, d), J.study_samples(T.samples(spark, d), T.consents(spark, d)))


_CELLS = """
, cells AS (SELECT patient, unnest(['quantity', 'price', 'discount', 'flag', 'status', 'empty_column']) AS field, unnest([quantity, price, discount, flag, status, empty_column]) AS value FROM decoded),
vals AS (SELECT patient, field, trim(value) AS value FROM cells WHERE trim(value) <> '' AND lower(trim(value)) NOT IN ('null', 'na', 'n/a', 'nan', 'nil', 'nill')),
profile AS (
  SELECT field, count(v.value) AS n_values, count(*) FILTER (v.value IS NOT NULL AND NOT regexp_matches(v.value, '{NUMBER}')) AS n_text
  FROM (SELECT DISTINCT field FROM cells) LEFT JOIN vals v USING (field) GROUP BY field),
typed AS (SELECT *, CASE WHEN n_values = 0 THEN NULL WHEN n_text > 0 THEN 'TEXT' ELSE 'NUMERIC' END AS observed FROM profile),
concepts AS (
  SELECT study_id, consent_code, person_id, path, CASE observed WHEN 'NUMERIC' THEN value ELSE '' END AS numeric, CASE observed WHEN 'TEXT' THEN replace(value, '"', '''') ELSE '' END AS text, patient
  FROM vals JOIN typed USING (field) JOIN mapping USING (field)
  LEFT JOIN (SELECT source_id, max(person_id) AS person_id FROM participants GROUP BY 1) p ON p.source_id = patient LEFT JOIN consents USING (person_id))
""".replace("{NUMBER}", C.NUMBER)


@query(_CELLS + "SELECT field, n_values, n_text, observed FROM typed")
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return A.column_profile(R.cells(T.decoded(spark, d), list(T.VALUES), []))


@query(_CELLS + "SELECT study_id, consent_code, path, count(*) AS rows, count(DISTINCT person_id) AS people, count(*) FILTER (numeric <> '') AS numbers, sum(TRY_CAST(numeric AS BIGINT))::BIGINT AS total, min(text) AS least, max(text) AS most FROM concepts WHERE consent_code IS NOT NULL GROUP BY ALL")
def study_concepts(spark: SparkSession, d: str) -> DataFrame:
    rows, keys = _concepts(spark, d)[0], ["study_id", "consent_code", "path"]
    # Extremes of text make Spark sort what it aggregates, so they are taken of the distinct texts. Both
    # branches read one exchange of the rows summed up by person and text.
    numbers = F.col("numeric") != ""
    per = rows.groupBy(*keys, "person_id", "text").agg(F.count("*").alias("n"), F.count_if(numbers).alias("k"), F.sum(F.when(numbers, F.col("numeric").try_cast("long"))).alias("t"))
    sums = per.groupBy(*keys, "person_id").agg(*[F.sum(c).alias(c) for c in "nkt"])
    sums = sums.groupBy(*keys).agg(F.sum("n").alias("rows"), F.count("*").alias("people"), F.sum("k").alias("numbers"), F.sum("t").alias("total"))
    texts = per.select(*keys, "text").distinct().groupBy(*keys).agg(F.min("text").alias("least"), F.max("text").alias("most"))
    return sums.join(texts, keys)


def _concepts(spark: SparkSession, d: str):
    return K.study_concepts(T.decoded(spark, d), T.mapping(spark), "patient", T.participants(spark, d), T.consents(spark, d))


@query(_CELLS + "SELECT CASE WHEN person_id IS NULL THEN 'unmapped' WHEN consent_code IS NULL THEN 'no_consent' ELSE 'written' END AS class, count(*) AS rows, count(DISTINCT patient) AS patients FROM concepts GROUP BY 1")
def study_concept_counts(spark: SparkSession, d: str) -> DataFrame:
    return _concepts(spark, d)[1]


@query(_CELLS + "SELECT person_id::VARCHAR AS person_id, '\"' || person_id || '\",\"' || path || '\",\"' || numeric || '\",\"' || replace(text, '\"', '\"\"') || '\",\"0\"' AS line FROM concepts WHERE consent_code IS NOT NULL")
def concept_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = _concepts(spark, d)[0]
    return rows.select(F.col("person_id").cast("string").alias("person_id"), C.quoted_line(F.col("person_id"), F.col("path"), F.col("numeric"), F.col("text"), F.lit("0")).alias("line"))


@query("SELECT study_id, consent_code, person_id, path, numeric, text FROM legacy_rows JOIN id_mapping USING (old_id) JOIN consents USING (person_id)")
def split_concepts(spark: SparkSession, d: str) -> DataFrame:
    return K.split_concepts(T.legacy_rows(spark, d), T.id_mapping(spark, d), T.consents(spark, d))[0]


_SPLIT = """, keyed AS (SELECT l.*, m.person_id, c.study_id, c.consent_code FROM legacy_rows l LEFT JOIN id_mapping m USING (old_id) LEFT JOIN consents c ON c.person_id = m.person_id),
classed AS (SELECT CASE WHEN person_id IS NULL THEN 'unmapped' WHEN consent_code IS NULL THEN 'no_consent' ELSE 'written' END AS class, count(*) AS rows, count(DISTINCT old_id) AS ids FROM keyed GROUP BY 1)
"""


@query(_SPLIT + "SELECT * FROM classed")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return K.split_concepts(T.legacy_rows(spark, d), T.id_mapping(spark, d), T.consents(spark, d))[1]


@query(_SPLIT + "SELECT 'WARNING' AS severity, upper(class) AS code, round(rows * 100.0 / (SELECT sum(rows) FROM classed), 1)::DOUBLE AS percent FROM classed WHERE class <> 'written'")
def split_checks(spark: SparkSession, d: str) -> DataFrame:
    return V.split_checks(split_counts(spark, d))


@query("SELECT study_id, consent_code, count(*) AS rows, count(DISTINCT person_id) AS participants FROM legacy_rows JOIN id_mapping USING (old_id) JOIN consents USING (person_id) GROUP BY ALL")
def rows_and_people_per_consent(spark: SparkSession, d: str) -> DataFrame:
    rows = split_concepts(spark, d)
    return rows.groupBy("study_id", "consent_code").agg(F.count("*").alias("rows"), F.count_distinct("person_id").alias("participants"))


_GENOMIC = """
, all_groups AS (
  SELECT DISTINCT c.study_id || '.c' || consent_code AS consent_group, c.study_id, consent_code, abv, person_id, source_sample_id, sample_source
  FROM consents c JOIN samples USING (person_id) JOIN studies s ON s.study_id = c.study_id
  WHERE is_ready AND NOT is_processed AND upper(data_type) IN ('P/G', 'G') AND consent_code <> '0' AND source_sample_id LIKE 'NWD%'),
held AS (
  SELECT consent_group, study_id, count(*) FILTER (contains(source_sample_id, ',')) AS bad_samples, array_to_string((list(source_sample_id ORDER BY source_sample_id) FILTER (contains(source_sample_id, ',')))[:10], ';') AS examples
  FROM all_groups GROUP BY ALL HAVING bad_samples > 0),
groups AS (SELECT * FROM all_groups WHERE consent_group NOT IN (SELECT consent_group FROM held))
"""


@query(_GENOMIC + "SELECT consent_group, study_id, consent_code, abv, person_id, source_sample_id, sample_source FROM groups")
def genomic_samples(spark: SparkSession, d: str) -> DataFrame:
    return K.genomic_groups(T.studies(spark, d), T.consents(spark, d), T.samples(spark, d))[0]


@query(_GENOMIC + "SELECT consent_group, study_id, 'ID_COUNT_MISMATCH' AS reasons, bad_samples, examples FROM held")
def held_back_groups(spark: SparkSession, d: str) -> DataFrame:
    held = K.genomic_groups(T.studies(spark, d), T.consents(spark, d), T.samples(spark, d))[1]
    return held.withColumns({"reasons": F.array_join("reasons", ","), "examples": F.array_join("examples", ";")})


@query(_GENOMIC + """, lists AS (SELECT consent_group, string_agg(source_sample_id, ',' ORDER BY source_sample_id, person_id, sample_source) AS sample_ids, string_agg(person_id, ',' ORDER BY source_sample_id, person_id, sample_source) AS patient_ids FROM groups GROUP BY 1)
SELECT consent_group, c AS chromosome, 'data/vcfInput/' || consent_group || '.chr' || c || '.annotated_remove_modifiers.hpds.vcf.gz' AS vcf_path, md5(sample_ids) AS samples_md5, md5(patient_ids) AS patients_md5
FROM lists, (SELECT unnest(list_concat(list_transform(range(1, 23), lambda i: i::VARCHAR), ['X'])) AS c)""")
def genomic_indexes(spark: SparkSession, d: str) -> DataFrame:
    rows = K.genomic_indexes(genomic_samples(spark, d))
    return rows.select("consent_group", "chromosome", "vcf_path", F.md5("sample_ids").alias("samples_md5"), F.md5("patient_ids").alias("patients_md5"))


_IDENTITY = """, each AS (SELECT study_id, consent_code, unnest(ids) AS identity FROM raw_ids), map AS (SELECT DISTINCT identity, study_id, consent_code FROM each)
"""


@query(_IDENTITY + "SELECT * FROM map")
def identity_map(spark: SparkSession, d: str) -> DataFrame:
    return K.identity_map(T.raw_identities(spark, d))[0]


@query(_IDENTITY + """SELECT study_id, 'IDENTITY_IN_SEVERAL_CONSENTS' AS code, count(*) AS count FROM (SELECT study_id, identity FROM map GROUP BY ALL HAVING count(*) > 1) GROUP BY 1
UNION ALL SELECT study_id, 'BLANK_IDENTITY', count(*) FROM raw_ids WHERE len(ids) = 0 GROUP BY 1
UNION ALL SELECT study_id, 'DUPLICATE_IDENTITY', sum(n)::BIGINT FROM (SELECT study_id, consent_code, count(*) - count(DISTINCT identity) AS n FROM each GROUP BY ALL) GROUP BY 1 HAVING sum(n) > 0""")
def identity_issues(spark: SparkSession, d: str) -> DataFrame:
    return K.identity_map(T.raw_identities(spark, d))[1]


_FOLDERS = """
, kinds AS (SELECT *, CASE WHEN name = study_id || '_' || label || '_allConcepts_MERGED.csv' THEN 'merged' WHEN contains(name, '_allConcepts_') AND NOT lower(name) LIKE '%\\_merged.csv' ESCAPE '\\' THEN 'source' WHEN contains(name, '_allConcepts_') THEN 'other_merged' ELSE 'ignored' END AS kind FROM inventory),
prints AS (SELECT study_id, label, sha256(string_agg(name || chr(9) || version_id || chr(10), '' ORDER BY name, version_id)) AS fingerprint FROM kinds WHERE kind = 'source' GROUP BY ALL),
folders AS (
  SELECT study_id, label, count(*) FILTER (kind = 'source') AS sources, coalesce(sum(size) FILTER (kind = 'source'), 0)::BIGINT AS bytes, count(*) FILTER (kind = 'other_merged') AS other_merged, count(*) FILTER (kind = 'ignored') AS ignored
  FROM kinds GROUP BY ALL),
known AS (
  SELECT f.*, p.fingerprint, right(f.label, 1) <> '3' AND (sources > 0 OR f.study_id LIKE '%4' OR f.study_id LIKE '%15') AS has_merged,
    CASE WHEN f.label = 'c1' AND substr(f.study_id, 9, 1) IN ('1', '2') THEN md5(f.study_id) WHEN f.label = 'c2' THEN NULL ELSE p.fingerprint END AS recorded
  FROM folders f LEFT JOIN prints p USING (study_id, label)),
planned AS (SELECT *, CASE WHEN sources = 0 AND NOT has_merged THEN 'NO_SOURCES' WHEN sources = 0 AND other_merged > 0 THEN 'ONLY_MERGED_COPIES' WHEN sources = 0 AND label = 'c1' THEN 'CHANGED_DURING_RUN' WHEN sources = 0 THEN 'REMOVED_NO_SOURCES' WHEN NOT has_merged THEN 'MISSING' WHEN recorded IS NULL THEN 'NO_FINGERPRINT' WHEN recorded <> fingerprint THEN 'SOURCES_CHANGED' ELSE 'UP_TO_DATE' END AS action FROM known)
"""


def _folders(spark: SparkSession, d: str) -> DataFrame:
    """Folders with what their merged files record: none for c3, nothing for c2, something else for some of c1; some without sources still have one, and those of c1 were rewritten."""
    rows = K.consent_folders(T.inventory(spark, d)).drop("merged_version", "merged_size", "recorded_fingerprint", "recorded_md5")
    merged = (F.substring("label", -1, 1) != "3") & ((F.col("sources") > 0) | F.col("study_id").like("%4") | F.col("study_id").like("%15"))
    recorded = F.when((F.col("label") == "c1") & F.substring("study_id", 9, 1).isin("1", "2"), F.md5("study_id")).when(F.col("label") != "c2", F.col("fingerprint"))
    return rows.withColumns({"merged_version": F.when(merged, F.lit("v1")), "merged_size": F.when(merged, F.col("bytes")), "recorded_fingerprint": recorded, "recorded_md5": F.md5("label"), "changed": F.col("label") == "c1"})


@query(_FOLDERS + "SELECT study_id, label, fingerprint, sources, bytes, other_merged, ignored, action, action IN ('MISSING', 'NO_FINGERPRINT', 'SOURCES_CHANGED') AS merge FROM planned")
def merge_plan(spark: SparkSession, d: str) -> DataFrame:
    return K.merge_plan(_folders(spark, d)).select("study_id", "label", "fingerprint", "sources", "bytes", "other_merged", "ignored", "action", "merge")


@query(_FOLDERS + "SELECT action, count(*) AS folders, sum(CASE WHEN action IN ('MISSING', 'NO_FINGERPRINT', 'SOURCES_CHANGED') THEN sources ELSE 0 END)::BIGINT AS files_merged FROM planned GROUP BY 1")
def merge_actions(spark: SparkSession, d: str) -> DataFrame:
    return A.action_counts(K.merge_plan(_folders(spark, d)))


@query(_FOLDERS + """SELECT study_id, label, 'WARNING' AS severity, CASE action WHEN 'NO_SOURCES' THEN 'FOLDER_WITHOUT_SOURCES' WHEN 'REMOVED_NO_SOURCES' THEN 'MERGED_FILE_REMOVED' WHEN 'ONLY_MERGED_COPIES' THEN action WHEN 'CHANGED_DURING_RUN' THEN action ELSE 'IGNORED_FILES' END AS code FROM planned WHERE sources = 0 OR ignored > 0 OR other_merged > 0
UNION ALL SELECT study_id, NULL, 'WARNING', 'STUDY_WITHOUT_FOLDERS' FROM studies WHERE is_ready AND study_id NOT IN (SELECT study_id FROM planned)""")
def merge_issues(spark: SparkSession, d: str) -> DataFrame:
    return V.merge_issues(K.merge_plan(_folders(spark, d)), T.studies(spark, d))


_MANIFEST = _FOLDERS + """, own AS (SELECT k.* FROM known k JOIN studies USING (study_id) WHERE is_ready),
judged AS (SELECT *, CASE WHEN sources = 0 AND other_merged > 0 THEN 'ONLY_MERGED_COPIES' WHEN sources = 0 AND has_merged THEN 'MERGED_WITHOUT_SOURCES' WHEN sources = 0 THEN 'NO_SOURCES' WHEN NOT has_merged THEN 'MERGED_MISSING' WHEN recorded IS NULL THEN 'MERGED_NOT_FINGERPRINTED' WHEN recorded <> fingerprint THEN 'MERGED_STALE' WHEN bytes = 0 THEN 'MERGED_EMPTY' END AS code FROM own),
good AS (SELECT * FROM judged WHERE code IS NULL)
"""


def _manifest(spark: SparkSession, d: str):
    folders = _folders(spark, d)
    files = folders.select("study_id", "label", S.merged_file(F.col("study_id"), F.col("label")).alias("name"), F.lit("2026-01-01").alias("last_modified"))
    whole = T.table(spark, d, "region").agg(F.count("*").alias("size")).select(F.lit("store://global.csv").alias("uri"), F.lit("g1").alias("version_id"), F.lit("2026-01-02").alias("last_modified"), "size", F.md5(F.lit("g")).alias("md5"))
    return K.manifest(T.studies(spark, d), folders, files, whole, "store://")


@query(_MANIFEST + """SELECT 'global' AS partition, 'store://global.csv' AS uri, 'g1' AS version_id, '2026-01-02' AS last_updated, md5('g') AS md5
UNION ALL SELECT study_id || '.' || label, 'store://' || study_id || '/allConcepts/' || label || '/' || study_id || '_' || label || '_allConcepts_MERGED.csv', 'v1', '2026-01-01', md5(label) FROM good""")
def manifest(spark: SparkSession, d: str) -> DataFrame:
    return _manifest(spark, d)[0]


@query(_MANIFEST + """SELECT study_id, label, CASE WHEN code IN ('ONLY_MERGED_COPIES', 'NO_SOURCES', 'MERGED_WITHOUT_SOURCES', 'MERGED_EMPTY') THEN 'WARNING' ELSE 'ERROR' END AS severity, code FROM judged WHERE code IS NOT NULL
UNION ALL SELECT study_id, NULL, 'ERROR', 'NO_CONSENT_FOLDERS' FROM studies WHERE is_ready AND study_id NOT IN (SELECT study_id FROM known)
UNION ALL SELECT DISTINCT study_id, NULL, 'WARNING', 'STUDY_NOT_IN_MANIFEST' FROM own WHERE study_id NOT IN (SELECT study_id FROM good)
UNION ALL SELECT NULL, NULL, 'ERROR', 'NO_CONSENT_GROUPS' WHERE (SELECT count(*) FROM good) = 0""")
def manifest_problems(spark: SparkSession, d: str) -> DataFrame:
    return _manifest(spark, d)[1]


_SHAPES = """, shapes AS (
  SELECT study_id || CASE WHEN ord % 9 = 2 THEN '-' ELSE '.c' END || consent_code AS partition, CASE WHEN n % 4 = 1 THEN 'other://x' ELSE 'store://x' END AS uri, CASE WHEN n % 5 = 2 THEN ' ' ELSE 'v' END AS version_id,
    '2026-01-01' AS last_updated, CASE WHEN n % 3 = 0 THEN 'no digest' ELSE md5(study_id) END AS md5, n
  FROM (SELECT study_id, consent_code, count(*) AS n, any_value(ord) AS ord FROM consents JOIN studies USING (study_id) GROUP BY ALL))
"""


@query(_SHAPES + """SELECT partition, 'ERROR' AS severity, unnest(list_concat(CASE WHEN NOT regexp_full_match(partition, 'phs\\d{6}\\.c\\d+') THEN ['BAD_PARTITION'] ELSE [] END, CASE WHEN NOT regexp_full_match(md5, '[0-9a-f]{32}') THEN ['BAD_MD5'] ELSE [] END,
  CASE WHEN trim(version_id) = '' THEN ['BLANK_CELL'] ELSE [] END, CASE WHEN uri LIKE 'other%' THEN ['BAD_URI'] ELSE [] END)) AS code FROM (SELECT * FROM shapes UNION ALL SELECT * FROM shapes WHERE n % 7 = 0)
UNION ALL SELECT partition, 'ERROR', 'REPEATED_PARTITION' FROM shapes WHERE n % 7 = 0 UNION ALL SELECT 'global', 'ERROR', 'NOT_ONE_GLOBAL_ROW'""")
def manifest_shape(spark: SparkSession, d: str) -> DataFrame:
    """Rows with every fault there is, by the number of people in a group."""
    groups = T.consents(spark, d).join(T.studies(spark, d).select("study_id", "ord"), "study_id").groupBy("study_id", "consent_code", "ord").agg(F.count("*").alias("n"))
    rows = groups.selectExpr("concat(study_id, if(ord % 9 = 2, '-', '.c'), consent_code) as partition", "if(n % 4 = 1, 'other://x', 'store://x') as uri", "if(n % 5 = 2, ' ', 'v') as version_id", "'2026-01-01' as last_updated", "if(n % 3 = 0, 'no digest', md5(study_id)) as md5", "n")
    return V.manifest_shape(rows.unionByName(rows.where("n % 7 = 0")), "store://")


_RESOLVED = """
, subj AS (SELECT study_id, subject_id, min(dbgap_subject_id) AS dbgap_id FROM sstr GROUP BY ALL),
firsts AS (SELECT study_id, subject_id, min(dbgap_subject_id) AS dbgap_id, arg_min(consent, ord) AS consent FROM sstr GROUP BY ALL),
resolved AS (
  SELECT m.study_id, m.id, m.old_id, coalesce(a.dbgap_id, b.dbgap_id) AS dbgap_id, p.person_id,
    CASE WHEN p.person_id IS NOT NULL THEN 'mapped' WHEN coalesce(a.dbgap_id, b.dbgap_id) IS NOT NULL THEN 'no_participant' WHEN n.subject_id IS NOT NULL THEN 'not_consented' ELSE 'not_in_file' END AS resolution
  FROM patient_mapping m LEFT JOIN (SELECT DISTINCT study_id, dbgap_id FROM firsts WHERE consent <> '0') a ON a.study_id = m.study_id AND a.dbgap_id = m.id
  LEFT JOIN (SELECT * FROM firsts WHERE consent <> '0') b ON b.study_id = m.study_id AND b.subject_id = m.id
  LEFT JOIN (SELECT * FROM firsts WHERE consent = '0') n ON n.study_id = m.study_id AND n.subject_id = m.id
  LEFT JOIN participants p ON p.source_id = coalesce(a.dbgap_id, b.dbgap_id))
"""


def _resolve_inputs(spark: SparkSession, d: str):
    firsts = T.sstr(spark, d).groupBy("study_id", "subject_id").agg(F.min("dbgap_subject_id").alias("dbgap_id"), F.min_by("consent", "ord").alias("consent"))
    yes, no = firsts.where("consent <> '0'"), firsts.where("consent = '0'")
    return T.patient_mapping(spark, d), yes.select("study_id", "dbgap_id"), yes.select("study_id", "subject_id", "dbgap_id"), no.select("study_id", "subject_id"), T.participants(spark, d)


@query(_RESOLVED + "SELECT study_id, id, old_id, dbgap_id, person_id, resolution FROM resolved")
def resolved_patients(spark: SparkSession, d: str) -> DataFrame:
    return J.resolve_patients(*_resolve_inputs(spark, d))


@query(_RESOLVED + """SELECT study_id, resolution, count(*) AS count, array_to_string((list(old_id ORDER BY old_id))[:10], ',') AS examples FROM resolved WHERE resolution <> 'mapped' GROUP BY ALL""")
def unresolved_patients(spark: SparkSession, d: str) -> DataFrame:
    return A.unresolved(resolved_patients(spark, d)).withColumn("examples", F.array_join("examples", ","))


@query(_RESOLVED + """, per AS (SELECT study_id, count(*) FILTER (resolution = 'mapped') AS mapping_rows, count(*) FILTER (resolution <> 'mapped') AS unresolved_rows FROM resolved GROUP BY 1)
SELECT ord, s.study_id, abv, CASE WHEN ord % 5 < 3 THEN 'SSTR' WHEN ord % 5 = 3 THEN 'MULTI' END AS source, coalesce(mapping_rows, 0) AS mapping_rows, coalesce(unresolved_rows, 0) AS unresolved_rows,
  CASE WHEN ord % 5 = 4 THEN 'skipped' WHEN coalesce(mapping_rows, 0) = 0 THEN 'needs_review' ELSE 'success' END AS outcome FROM studies s LEFT JOIN per USING (study_id) WHERE is_ready""")
def migration(spark: SparkSession, d: str) -> DataFrame:
    files = T.studies(spark, d).selectExpr("study_id", "case when ord % 5 < 3 then concat('SSTR_', study_id, '.v1.txt') when ord % 5 = 3 then concat(study_id, '.v2.pht000001.Subject.MULTI.txt') else 'readme.txt' end as name")
    return K.migrate(T.studies(spark, d), *_resolve_inputs(spark, d), files)[1]


@query("SELECT study_id, consent, count(*) AS participants FROM (SELECT study_id, subject_id, arg_min(consent, ord) AS consent FROM sstr GROUP BY ALL) GROUP BY ALL")
def consent_groups(spark: SparkSession, d: str) -> DataFrame:
    return A.consent_groups(T.sstr(spark, d))


@query(""", u AS (SELECT *, consent <> '0' AS ok FROM sstr), f AS (SELECT study_id, subject_id, arg_min(consent, ord) AS code FROM u WHERE ok GROUP BY ALL)
SELECT f.study_id, f.subject_id, f.code AS consent, (SELECT count(*) FROM u WHERE ok AND u.study_id = f.study_id AND u.subject_id = f.subject_id AND u.consent <> f.code) AS conflicts FROM f""")
def first_usable_consents(spark: SparkSession, d: str) -> DataFrame:
    return E.first_usable_consent(T.sstr(spark, d), ["study_id", "subject_id"], "consent", "ord")[0].withColumnRenamed("code", "consent")


@query(""", l AS (SELECT *, lag(consent) OVER (PARTITION BY study_id, subject_id ORDER BY ord) AS before FROM sstr)
SELECT study_id, subject_id, count(*) AS conflicts, array_to_string((list(before || '->' || consent ORDER BY ord))[:5], ',') AS examples FROM l WHERE before <> consent GROUP BY ALL""")
def consent_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return E.code_conflicts(T.sstr(spark, d), ["study_id", "subject_id"], "consent", "ord").withColumn("examples", F.array_join("examples", ","))


@query("SELECT study_id, subject_id, arg_max(consent, ord) AS consent, max(ord) AS ord FROM sstr GROUP BY ALL")
def last_rows(spark: SparkSession, d: str) -> DataFrame:
    return E.last_per_key(T.sstr(spark, d).select("study_id", "subject_id", "consent", "ord"), ["study_id", "subject_id"], "ord")


@query("SELECT study_id, subject_id, dbgap_sample_id AS source_sample_id, 'DBGap' AS sample_source FROM sstr WHERE dbgap_sample_id <> '' UNION ALL SELECT study_id, subject_id, sample_id, 'submitted' FROM sstr WHERE sample_id <> ''")
def sample_sources(spark: SparkSession, d: str) -> DataFrame:
    return R.sample_sources(T.sstr(spark, d))


@query("""SELECT s.study_id, s.subject_id, s.dbgap_sample_id, CASE WHEN c.consent_code <> '0' THEN 'consented' WHEN c.consent_code = '0' THEN 'not_consented' ELSE 'unknown' END AS subject_class
FROM sstr s LEFT JOIN consents c ON c.study_id = s.study_id AND 'S' || c.person_id = s.subject_id""")
def classed_samples(spark: SparkSession, d: str) -> DataFrame:
    known = T.consents(spark, d).selectExpr("study_id", "concat('S', person_id) as subject_id", "consent_code")
    return J.samples_of_subjects(T.sstr(spark, d).select("study_id", "subject_id", "dbgap_sample_id"), known.where("consent_code <> '0'"), known.where("consent_code = '0'"))


@query("""SELECT study_id, consent_code, CASE WHEN consent_code = '0' THEN '' WHEN consent_code = '3' THEN 'Label only' ELSE CASE consent_code WHEN '1' THEN 'GRU' ELSE 'HMB' END END AS consent_abbreviation,
CASE WHEN consent_code = '0' THEN 'CONSENT_CODE_NOT_DECODED' WHEN consent_code = '3' THEN 'CONSENT_LABEL_WITHOUT_ABBREVIATION' END AS issue FROM (SELECT DISTINCT study_id, consent_code FROM consents)""")
def decoded_consents(spark: SparkSession, d: str) -> DataFrame:
    codes = T.consents(spark, d).select("study_id", "consent_code").distinct()
    labels = T.studies(spark, d).select("study_id", F.explode(F.expr("array(struct('1' as consent_code, 'General Research Use (GRU) ' as label), struct('2' as consent_code, 'Health (any) (HMB)' as label), struct('3' as consent_code, 'Label only' as label))")).alias("l")).select("study_id", "l.*")
    return J.decoded_consents(codes, labels)


@query(""", ids AS (SELECT DISTINCT 'D' || o_custkey AS source_id FROM orders), fresh AS (SELECT source_id FROM ids WHERE source_id NOT IN (SELECT source_id FROM participants))
SELECT person_id, source_id, source FROM participants UNION ALL SELECT (SELECT max(person_id) FROM participants) + row_number() OVER (ORDER BY source_id), source_id, 'DBGap' FROM fresh""")
def resolve_or_create(spark: SparkSession, d: str) -> DataFrame:
    ids = T.table(spark, d, "orders").selectExpr("concat('D', o_custkey) as source_id")
    return I.resolve_or_create(T.participants(spark, d), ids, "DBGap")


@query("""SELECT * FROM consents WHERE study_id <> 'phs000003' UNION ALL SELECT c_custkey, 'phs000003', '9', 'NEW' FROM customer WHERE c_nationkey = 2""")
def purge_and_reload(spark: SparkSession, d: str) -> DataFrame:
    new = T.table(spark, d, "customer").where("c_nationkey = 2").selectExpr("c_custkey as person_id", "'phs000003' as study_id", "'9' as consent_code", "'NEW' as consent_abbreviation")
    return I.purge_and_reload(T.consents(spark, d), "phs000003", new)


_FRESH = "c_custkey % 5 = 0"


@query(f""", fresh AS (SELECT c_custkey AS person_id, {T._STUDY.format('c_nationkey')} AS study_id, '7' AS consent_code, 'UPS' AS consent_abbreviation FROM customer WHERE {_FRESH})
SELECT c.* FROM consents c LEFT JOIN fresh f USING (person_id, study_id) WHERE f.person_id IS NULL UNION ALL SELECT * FROM fresh""")
def upsert_consents(spark: SparkSession, d: str) -> DataFrame:
    new = T.table(spark, d, "customer").where(_FRESH).selectExpr("c_custkey as person_id", T.STUDY.format("c_nationkey") + " as study_id", "explode(array(struct(1 as ord, '6' as consent_code), struct(2 as ord, '7' as consent_code))) as r")
    return I.upsert_consents(T.consents(spark, d), new.selectExpr("person_id", "study_id", "r.consent_code", "'UPS' as consent_abbreviation", "r.ord"), "ord")


@query("SELECT DISTINCT person_id, source_sample_id, sample_source FROM (SELECT * FROM samples UNION ALL SELECT o_custkey, 'SMP' || o_orderkey, 'submitted' FROM orders)")
def insert_samples(spark: SparkSession, d: str) -> DataFrame:
    new = T.table(spark, d, "orders").selectExpr("o_custkey as person_id", "concat('SMP', o_orderkey) as source_sample_id", "'submitted' as sample_source")
    return I.insert_samples(T.samples(spark, d), new)


@query(""", firsts AS (SELECT study_id, dbgap_subject_id, arg_min(consent, ord) AS consent FROM sstr GROUP BY ALL),
fresh AS (SELECT dbgap_subject_id, (SELECT max(person_id) FROM participants) + row_number() OVER (ORDER BY dbgap_subject_id) AS pid FROM (SELECT DISTINCT dbgap_subject_id FROM firsts WHERE dbgap_subject_id NOT IN (SELECT source_id FROM participants))),
ids AS (SELECT f.*, coalesce(p.person_id, n.pid) AS pid FROM firsts f LEFT JOIN participants p ON p.source_id = dbgap_subject_id LEFT JOIN fresh n USING (dbgap_subject_id)),
tubes AS (SELECT DISTINCT study_id, pid, sid, src FROM (SELECT study_id, dbgap_subject_id, dbgap_sample_id AS sid, 'DBGap' AS src FROM sstr UNION ALL SELECT study_id, dbgap_subject_id, sample_id, 'submitted' FROM sstr) JOIN ids USING (study_id, dbgap_subject_id) WHERE sid <> '')
SELECT s.study_id, (SELECT count(*) FROM sstr x WHERE x.study_id = s.study_id) AS rows_read, count(*) AS distinct_participants, count(*) FILTER (dbgap_subject_id IN (SELECT dbgap_subject_id FROM fresh)) AS participants_inserted, count(*) AS consents_written,
  (SELECT count(*) FROM consents x WHERE x.study_id = s.study_id) AS consents_purged, count(DISTINCT consent) AS consent_groups, (SELECT count(*) FROM tubes x WHERE x.study_id = s.study_id) AS samples_seen,
  (SELECT count(*) FROM tubes x LEFT JOIN (SELECT DISTINCT * FROM samples) y ON y.person_id = x.pid AND y.source_sample_id = x.sid AND y.sample_source = x.src WHERE x.study_id = s.study_id AND y.person_id IS NULL) AS samples_inserted
FROM ids s GROUP BY s.study_id""")
def load_counts(spark: SparkSession, d: str) -> DataFrame:
    return I.load_sstr(T.participants(spark, d), T.consents(spark, d), T.samples(spark, d), T.sstr(spark, d).withColumn("consent_abbreviation", F.lit("GRU")))[3]


@query("SELECT study_id, count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings, count(*) FILTER (severity = 'INFO') AS infos FROM reports GROUP BY 1")
def severity_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.severity_counts(T.reports(spark, d), ["study_id"])


@query("SELECT study_id, code, CASE max(CASE severity WHEN 'ERROR' THEN 3 WHEN 'WARNING' THEN 2 ELSE 1 END) WHEN 3 THEN 'FAILED' WHEN 2 THEN 'SUCCESS_WITH_WARNINGS' ELSE 'SUCCESS' END AS verdict FROM reports GROUP BY ALL")
def verdicts(spark: SparkSession, d: str) -> DataFrame:
    return V.verdict(T.reports(spark, d), ["study_id", "code"])


@query("SELECT study_id, code, 'WARNING' AS severity, count(*) AS count, array_to_string((list(event_id::VARCHAR ORDER BY ts, event_id))[:10], ',') AS examples FROM reports GROUP BY ALL")
def issue_tally(spark: SparkSession, d: str) -> DataFrame:
    rows = T.reports(spark, d).withColumns({"example": F.col("event_id").cast("string"), "o": F.struct("ts", "event_id")})
    return A.issue_tally(rows, ["study_id"], "example", "o").withColumn("examples", F.array_join("examples", ","))


def _plan(spark: SparkSession, d: str) -> DataFrame:
    inputs = T.studies(spark, d).selectExpr("study_id", "ord % 4 <> 1 as has_sstr", "cast(ord % 3 as bigint) as csv_count", "cast(ord * 100 as bigint) as decoded_bytes", "ord % 6 <> 4 as has_mapping")
    return K.resolve_studies(T.studies(spark, d), inputs)


_PLAN = """, plan0 AS (SELECT ord, study_id, abv, is_processed, concat_ws('; ', CASE WHEN ord % 4 = 1 THEN 'no subject-sample file' END, CASE WHEN ord % 3 = 0 THEN 'no decoded data file' END, CASE WHEN ord % 6 = 4 THEN 'no concept mapping' END) AS r FROM studies WHERE is_ready),
plan AS (SELECT ord, study_id, abv, CASE WHEN is_processed THEN 'already_processed' WHEN r <> '' THEN 'excluded' ELSE 'load' END AS plan, CASE WHEN NOT is_processed THEN r ELSE '' END AS reason, (ord * 100)::BIGINT AS decoded_bytes, (ord % 3)::BIGINT AS csv_count FROM plan0)
"""


@query(_PLAN + "SELECT * FROM plan")
def resolved_studies(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d)


def _run(spark: SparkSession, d: str):
    plan = _plan(spark, d)
    results = plan.where("plan = 'load'").select("study_id", F.lit("sstr").alias("stage"), F.expr("case ord % 4 when 0 then 'SUCCESS' when 2 then 'UNSTABLE' else 'FAILURE' end").alias("result"), F.lit("").alias("reason"))
    issues = T.reports(spark, d).groupBy("study_id", "code").agg(F.count("*").alias("n")).selectExpr("study_id", "'sstr' as stage", "case n % 5 when 0 then 'ERROR' when 1 then 'WARNING' else 'INFO' end as severity", "code", "concat('seen ', n) as message")
    stages = spark.createDataFrame([("generate-global-all-concepts", True, "SUCCESS", None), ("merge-allconcepts", True, "SUCCESS", None), ("generate-allconcepts-manifest", True, "SUCCESS", None)], "stage string, ran boolean, status string, message string")
    return plan, O.run_review(plan, results, issues, stages)


_REVIEW = _PLAN + """, found AS (SELECT r.study_id, code, count(*) AS n, CASE count(*) % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'WARNING' END AS level FROM reports r JOIN plan p ON p.study_id = r.study_id AND p.plan <> 'excluded' GROUP BY r.study_id, code HAVING count(*) % 5 < 2),
review AS (
  SELECT study_id, 'resolve-studies' AS stage, 'EXCLUDED' AS severity, 'MISSING_INPUTS' AS code, reason AS detail FROM plan WHERE plan = 'excluded'
  UNION ALL SELECT study_id, 'sstr', 'FAILED', 'FAILURE', 'sstr ended FAILURE' FROM plan WHERE plan = 'load' AND ord % 4 IN (1, 3)
  UNION ALL SELECT study_id, 'sstr', level, code, 'seen ' || n FROM found
  UNION ALL SELECT study_id, 'sstr', 'WARNING', 'UNSTABLE', 'completed with warnings' FROM plan WHERE plan = 'load' AND ord % 4 = 2 AND study_id NOT IN (SELECT study_id FROM found WHERE level = 'WARNING'))
"""


@query(_REVIEW + "SELECT study_id, stage, severity, code, detail FROM review")
def run_review(spark: SparkSession, d: str) -> DataFrame:
    return _run(spark, d)[1]


@query(_REVIEW + """SELECT p.study_id, abv, plan, CASE WHEN bool_or(severity = 'FAILED') THEN 'FAILED' WHEN plan = 'excluded' THEN 'EXCLUDED' WHEN bool_or(severity = 'WARNING') THEN 'COMPLETE_WITH_WARNINGS' WHEN plan = 'already_processed' THEN 'ALREADY_PROCESSED' ELSE 'COMPLETE' END AS status,
  count(severity) AS review_items, coalesce(string_agg(stage || ': ' || code || ': ' || detail, '; ' ORDER BY stage || ': ' || code || ': ' || detail), '') AS reasons FROM plan p LEFT JOIN review r ON r.study_id = p.study_id GROUP BY p.study_id, abv, plan""")
def run_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return O.run_outcomes(*_run(spark, d))


_MIG = """, ps AS (SELECT study_id, CASE ord % 6 WHEN 0 THEN 'skipped' WHEN 1 THEN 'needs_review' WHEN 2 THEN 'failed' ELSE 'success' END AS outcome, ord % 2 AS unresolved_rows, ord FROM studies WHERE is_ready),
sp AS (SELECT study_id, CASE WHEN ord % 7 = 0 THEN 'FAILED' WHEN ord % 7 = 1 THEN 'NOT_STARTED' ELSE 'SUCCESS' END AS outcome, CASE WHEN ord % 7 = 0 THEN CASE WHEN ord % 2 = 0 THEN 'preflight' ELSE 'run' END END AS stage, CASE WHEN ord % 7 = 0 THEN 'INFRA_ERROR' END AS exit_label, ord % 3 AS unmapped FROM ps WHERE outcome = 'success'),
later AS (SELECT * FROM (SELECT study_id, code, CASE count(*) % 7 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'WARNING' END AS severity FROM reports JOIN ps USING (study_id) GROUP BY study_id, code) WHERE severity IS NOT NULL),
review AS (
  SELECT study_id, 'participants-migration' AS stage, CASE outcome WHEN 'skipped' THEN 'MISSING_DATA' WHEN 'needs_review' THEN 'DATA_MISMATCH' WHEN 'failed' THEN 'MALFORMED_DATA' ELSE 'PARTIAL_DATA' END AS category,
    CASE outcome WHEN 'skipped' THEN 'NO_PARTICIPANT_FILES' WHEN 'needs_review' THEN 'NEEDS_DATA_REVIEW' WHEN 'failed' THEN 'STUDY_FAILED' ELSE 'SUBJECTS_NOT_MIGRATED' END AS code FROM ps WHERE outcome <> 'success' OR unresolved_rows > 0
  UNION ALL SELECT study_id, 'split-allconcepts', CASE WHEN outcome = 'FAILED' AND stage = 'preflight' THEN 'MALFORMED_DATA' ELSE 'PIPELINE_FAILURE' END, CASE WHEN outcome = 'FAILED' AND stage = 'preflight' THEN 'SPLIT_INPUT_UNUSABLE' WHEN outcome = 'NOT_STARTED' THEN 'SPLIT_NOT_STARTED' ELSE 'SPLIT_' || exit_label END FROM sp WHERE outcome <> 'SUCCESS'
  UNION ALL SELECT study_id, 'split-allconcepts', 'PARTIAL_DATA', 'SPLIT_UNMAPPED_IDS' FROM sp WHERE outcome = 'SUCCESS' AND unmapped > 0
  UNION ALL SELECT study_id, 'merge-allconcepts', CASE severity WHEN 'ERROR' THEN 'PIPELINE_FAILURE' ELSE 'OUTPUT_WARNING' END, code FROM later)
"""


def _migration(spark: SparkSession, d: str):
    ps = T.studies(spark, d).where("is_ready").selectExpr("study_id", "case ord % 6 when 0 then 'skipped' when 1 then 'needs_review' when 2 then 'failed' else 'success' end as outcome", "cast(ord % 2 as bigint) as unresolved_rows", "ord")
    sp = ps.where("outcome = 'success'").selectExpr("study_id", "case ord % 7 when 0 then 'FAILED' when 1 then 'NOT_STARTED' else 'SUCCESS' end as outcome", "case when ord % 7 = 0 then case when ord % 2 = 0 then 'preflight' else 'run' end end as stage", "case when ord % 7 = 0 then 'INFRA_ERROR' end as exit_label", "cast(ord % 3 as bigint) as unmapped", "0L as no_consent", "0L as malformed")
    later = T.reports(spark, d).groupBy("study_id", "code").agg(F.count("*").alias("n")).selectExpr("study_id", "'merge-allconcepts' as stage", "case n % 7 when 0 then 'ERROR' when 1 then 'WARNING' when 2 then 'WARNING' else 'INFO' end as severity", "code")
    return ps.drop("ord"), sp, O.migration_review(ps, sp, later)


@query(_MIG + "SELECT study_id, stage, category, code FROM review")
def migration_review(spark: SparkSession, d: str) -> DataFrame:
    return _migration(spark, d)[2]


@query(_MIG + """, st AS (SELECT study_id, CASE WHEN category IN ('MISSING_DATA', 'MALFORMED_DATA', 'DATA_MISMATCH') THEN 1 WHEN category = 'PIPELINE_FAILURE' THEN 2 ELSE 4 END AS r FROM review UNION ALL SELECT study_id, 5 FROM ps)
SELECT study_id, (['NOT_MIGRATED', 'RERUN_NEEDED', 'NOT_REACHED', 'MIGRATED_WITH_GAPS', 'MIGRATED'])[min(r)] AS status, (SELECT count(*) FROM review v WHERE v.study_id = st.study_id) AS review_items FROM st GROUP BY study_id""")
def migration_outcomes(spark: SparkSession, d: str) -> DataFrame:
    ps, sp, review = _migration(spark, d)
    return O.migration_outcomes(ps, sp, review)


_COUNTS = _RESOLVED + """, counts AS (
  SELECT coalesce(a.study_id, b.study_id) AS study_id, coalesce(a.consent_code, b.consent_code) AS consent_code, participants_loaded, participants_split, split_rows,
    (coalesce(a.study_id, b.study_id) || '.c' || coalesce(a.consent_code, b.consent_code)) IN (SELECT study_id || '.c' || consent_code FROM consents WHERE consent_code IN ('1', '2')) AS in_manifest
  FROM (SELECT study_id, consent_code, count(*) AS participants_loaded FROM consents GROUP BY ALL) a
  FULL JOIN (SELECT study_id, consent_code, count(DISTINCT person_id) AS participants_split, count(*) AS split_rows FROM legacy_rows JOIN id_mapping USING (old_id) JOIN consents USING (person_id) GROUP BY ALL) b ON a.study_id = b.study_id AND a.consent_code = b.consent_code)
"""


@query(_COUNTS + "SELECT * FROM counts")
def migration_consents(spark: SparkSession, d: str) -> DataFrame:
    loaded = A.rows_per_consent(T.consents(spark, d)).withColumnRenamed("rows", "participants_loaded")
    split = rows_and_people_per_consent(spark, d).withColumnsRenamed({"rows": "split_rows", "participants": "participants_split"})
    there = T.consents(spark, d).where("consent_code in ('1', '2')").select(S.partition_name(F.col("study_id"), F.col("consent_code")).alias("partition")).distinct()
    return O.consent_counts(loaded, split, there)


@query(_COUNTS + "SELECT count(*) AS consent_groups, count(*) FILTER (in_manifest) AS published, sum(participants_loaded)::BIGINT AS participants_loaded, sum(participants_split)::BIGINT AS participants_split FROM counts")
def migration_totals(spark: SparkSession, d: str) -> DataFrame:
    return O.consent_totals(migration_consents(spark, d))


_RUNS = """, runs AS (SELECT study_id, CASE WHEN ord % 8 = 0 THEN 'preflight' WHEN ord % 8 = 1 THEN 'not-started' END AS stage, CASE WHEN ord % 5 = 0 THEN 3 WHEN ord % 5 = 1 THEN 4 ELSE 0 END AS exit_code, CASE ord % 3 WHEN 0 THEN 0 WHEN 1 THEN 10 ELSE 1 END AS rc, ord * 10 AS total_rows FROM studies),
results AS (SELECT study_id, CASE WHEN stage = 'not-started' THEN 'NOT_STARTED' WHEN stage IS NOT NULL OR exit_code <> 0 OR rc = 1 THEN 'FAILED' WHEN rc = 10 THEN 'SUCCESS_WITH_WARNINGS' ELSE 'SUCCESS' END AS outcome,
  CASE WHEN stage IS NOT NULL THEN stage WHEN exit_code <> 0 THEN 'run' WHEN rc = 1 THEN 'validation' END AS stage, CASE exit_code WHEN 0 THEN 'SUCCESS' WHEN 3 THEN 'DATA_ERROR' ELSE 'INFRASTRUCTURE_ERROR' END AS exit_label, total_rows FROM runs)
"""


def _split_runs(spark: SparkSession, d: str) -> DataFrame:
    runs = T.studies(spark, d).selectExpr("study_id", "case when ord % 8 = 0 then 'preflight' when ord % 8 = 1 then 'not-started' end as stage", "case when ord % 5 = 0 then 3 when ord % 5 = 1 then 4 else 0 end as exit_code", "case ord % 3 when 0 then 0 when 1 then 10 else 1 end as validation_code", "cast(ord * 10 as bigint) as total_rows")
    return O.split_results(runs).join(runs.select("study_id", "total_rows"), "study_id")


@query(_RUNS + "SELECT study_id, outcome, stage, exit_label, total_rows FROM results")
def split_results(spark: SparkSession, d: str) -> DataFrame:
    return _split_runs(spark, d)


@query(_RUNS + """SELECT count(*) AS studies, count(*) FILTER (outcome = 'SUCCESS') AS succeeded, count(*) FILTER (outcome = 'SUCCESS_WITH_WARNINGS') AS succeeded_with_warnings, count(*) FILTER (outcome = 'FAILED') AS failed, count(*) FILTER (outcome = 'NOT_STARTED') AS not_started,
  count(*) FILTER (outcome = 'FAILED' AND (stage IN ('preflight', 'validation') OR exit_label = 'DATA_ERROR')) AS excluded, count(*) FILTER (outcome = 'NOT_STARTED' OR (outcome = 'FAILED' AND NOT (stage IN ('preflight', 'validation') OR exit_label = 'DATA_ERROR'))) AS to_run_again, sum(total_rows)::BIGINT AS total_rows FROM results""")
def split_summary(spark: SparkSession, d: str) -> DataFrame:
    return O.split_summary(_split_runs(spark, d), ["total_rows"])


@query("SELECT ord, abv, s.study_id, data_type, is_ready AND (ord % 4 <> 0) AS is_ready, is_processed FROM studies s")
def excluded_studies(spark: SparkSession, d: str) -> DataFrame:
    return K.exclude_studies(T.studies(spark, d), T.studies(spark, d).where("ord % 4 = 0"))[0]


@query("SELECT 'participants' AS \"table\", count(*) AS rows FROM participants UNION ALL SELECT 'consents', count(*) FROM consents UNION ALL SELECT 'samples', count(*) FROM samples")
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.table_counts(participants=T.participants(spark, d), consents=T.consents(spark, d), samples=T.samples(spark, d))


@query("SELECT count(*) AS rows, count(DISTINCT nullif(trim(dbgap_sample_id), '')) AS distinct_keys, count(*) FILTER (trim(dbgap_sample_id) = '') AS blank_keys FROM sstr")
def key_profile(spark: SparkSession, d: str) -> DataFrame:
    return A.key_profile(T.sstr(spark, d), "dbgap_sample_id")


@query("""SELECT study_id, count(*) AS rows, count(*) FILTER (NOT regexp_matches(new_id, '^\\d+$')) AS bad_new_ids, count(*) FILTER (new_id = '') AS blank_fields, coalesce(max(r), 0) AS repeated_old_ids, max(e) AS repeated_examples FROM (
  SELECT study_id, old_id, CASE WHEN person_id % 10 = 0 THEN '' WHEN person_id % 10 = 1 THEN 'x' || person_id ELSE person_id::VARCHAR END AS new_id FROM (SELECT study_id, person_id, person_id % 700 AS old_id FROM consents))
LEFT JOIN (SELECT study_id, count(*) AS r, array_to_string((list(old_id ORDER BY old_id))[:5], ',') AS e FROM (SELECT study_id, (person_id % 700)::VARCHAR AS old_id FROM consents GROUP BY ALL HAVING count(*) > 1) GROUP BY 1) USING (study_id) GROUP BY 1""")
def mapping_checks(spark: SparkSession, d: str) -> DataFrame:
    rows = T.consents(spark, d).selectExpr("study_id", "cast(person_id % 700 as string) as old_id", "case when person_id % 10 = 0 then '' when person_id % 10 = 1 then concat('x', person_id) else cast(person_id as string) end as new_id")
    return A.mapping_checks(rows).withColumn("repeated_examples", F.array_join("repeated_examples", ","))


@query("SELECT source_id FROM (SELECT DISTINCT 'D' || o_custkey AS source_id FROM orders) WHERE source_id NOT IN (SELECT source_id FROM participants)")
def new_source_ids(spark: SparkSession, d: str) -> DataFrame:
    return J.new_ids(T.table(spark, d, "orders").selectExpr("concat('D', o_custkey) as source_id"), T.participants(spark, d), "DBGap")


@query("SELECT study_id, consent_code FROM (SELECT DISTINCT study_id, consent_code FROM consents UNION SELECT study_id, '9' FROM studies WHERE is_ready) WHERE (study_id, consent_code) NOT IN (SELECT (study_id, consent_code) FROM consents JOIN samples USING (person_id) WHERE source_sample_id LIKE 'NWD%')")
def stale_outputs(spark: SparkSession, d: str) -> DataFrame:
    written = J.study_samples(T.samples(spark, d), T.consents(spark, d)).where(S.sequenced(F.col("source_sample_id"))).join(T.consents(spark, d), ["study_id", "person_id"])
    there = R.distinct_union(T.consents(spark, d).select("study_id", "consent_code"), J.ready(T.studies(spark, d)).select("study_id", F.lit("9").alias("consent_code")))
    return J.stale(there, written, ["study_id", "consent_code"])


@query("SELECT study_id, arg_max(name, n) AS name, count(*) AS candidates FROM (SELECT study_id, name, regexp_extract(name, '(\\d+)\\.csv$', 1)::BIGINT AS n FROM inventory WHERE contains(name, '_allConcepts_') AND NOT contains(name, '_merged')) GROUP BY 1")
def newest_files(spark: SparkSession, d: str) -> DataFrame:
    rows = T.inventory(spark, d).where("contains(name, '_allConcepts_') and not contains(name, '_merged')").select("study_id", "name")
    return E.newest(rows, ["study_id"], "name")


@query("SELECT study_id, label, count(*) AS files, dense_rank() OVER (PARTITION BY study_id ORDER BY length(label), label) AS place FROM inventory GROUP BY study_id, label")
def consent_order(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    rows = T.inventory(spark, d).groupBy("study_id", "label").agg(F.count("*").alias("files"))
    return rows.withColumn("place", F.dense_rank().over(Window.partitionBy("study_id").orderBy(*R.consent_order(F.col("label")))).cast("long"))


@query(f"""SELECT value, count(*) AS n, regexp_matches(value, '{C.NUMBER}') AS is_number, lower(value) IN ('null', 'na', 'n/a', 'nan', 'nil', 'nill') AS is_null_word,
  CASE WHEN regexp_matches(value, '^[0-9]+$') THEN coalesce(nullif(ltrim(value, '0'), ''), '0') END AS code, CASE WHEN regexp_matches(value, '[,"\n]') THEN '"' || replace(value, '"', '""') || '"' ELSE value END AS quoted
FROM (SELECT CASE event_id % 6 WHEN 0 THEN value::DECIMAL(18, 2)::VARCHAR WHEN 1 THEN 'NaN' WHEN 2 THEN 'N/A' WHEN 3 THEN '00' || (user_id % 40) WHEN 4 THEN event_type || ',"' ELSE '1e' || (user_id % 9) || 'd' END AS value FROM events) GROUP BY value""")
def cell_functions(spark: SparkSession, d: str) -> DataFrame:
    v = T.table(spark, d, "events").selectExpr("case event_id % 6 when 0 then cast(cast(value as decimal(18, 2)) as string) when 1 then 'NaN' when 2 then 'N/A' when 3 then concat('00', user_id % 40) when 4 then concat(event_type, ',\"') else concat('1e', user_id % 9, 'd') end as value")
    rows = v.groupBy("value").agg(F.count("*").alias("n"))
    c = F.col("value")
    return rows.select("value", "n", C.is_number(c).alias("is_number"), C.is_null_word(c).alias("is_null_word"), S.consent_code(c).alias("code"), C.csv_quote(c).alias("quoted"))


@query("SELECT study_id, label, count(*) AS rows, md5(count(*) || ':' || sum(('0x' || left(md5(concat_ws(chr(31), name, version_id)), 15))::BIGINT)) AS digest FROM inventory GROUP BY ALL")
def content_digests(spark: SparkSession, d: str) -> DataFrame:
    return A.content_digest(T.inventory(spark, d), ["study_id", "label"], ["name", "version_id"])


@query("SELECT outcome, count(*) AS n, string_agg(study_id, ',' ORDER BY ord) AS study_ids FROM (SELECT ord, study_id, CASE WHEN NOT is_ready THEN 'skipped' WHEN is_processed THEN 'reused' ELSE 'success' END AS outcome FROM studies) GROUP BY 1")
def ids_by_outcome(spark: SparkSession, d: str) -> DataFrame:
    return A.ids_by_outcome(T.studies(spark, d).selectExpr("ord", "study_id", "case when not is_ready then 'skipped' when is_processed then 'reused' else 'success' end as outcome"))


@query("""SELECT flag AS file, count(*) AS rows, count(*) FILTER (bad) AS not_patients,
  sum(CASE WHEN bad OR p.person_id IS NULL THEN 0 ELSE (quantity <> 'NA')::INT + (price <> '')::INT + (status <> '')::INT END)::BIGINT AS emitted, count(*) FILTER (NOT bad AND p.person_id IS NULL) * 3 AS skipped, count(DISTINCT CASE WHEN NOT bad AND p.person_id IS NULL THEN patient END) AS unmapped_ids
FROM (SELECT *, line >= 6 AS bad FROM decoded) LEFT JOIN participants p ON p.source_id = patient GROUP BY 1""")
def file_counts(spark: SparkSession, d: str) -> DataFrame:
    mapping = [{"field": "quantity", "type": "NUMERIC"}, {"field": "price", "type": "NUMERIC"}, {"field": "status", "type": "TEXT"}]
    rows = T.decoded(spark, d).withColumn("patient", F.expr("case line when 6 then concat('# ', patient) when 7 then ' dbGaP_Subject_ID' else patient end"))
    return K.file_counts(rows.withColumnRenamed("flag", "file"), mapping, "patient", "file", T.participants(spark, d))
