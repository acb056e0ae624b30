"""The domain's tables, derived from the star schema's by expressions that mean the same in Spark and DuckDB.

``load(spark, sf_dir)`` gives them as DataFrames; ``WITH`` is the same in SQL, as a chain of named subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


STUDY = "concat('phs', lpad(cast({0} + 1 as string), 6, '0'))"


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as ord", "n_name as abv", STUDY.format("n_nationkey") + " as study_id",
        "case n_nationkey % 4 when 0 then 'P' when 1 then 'P/G' when 2 then 'g' else '' end as data_type",
        "n_regionkey <> 4 as is_ready", "n_regionkey = 3 as is_processed",
    )


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 11 <> 0").selectExpr(
        "c_custkey as person_id", "concat('D', c_custkey) as source_id", "'DBGap' as source")


def consents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0").selectExpr(
        "c_custkey as person_id", STUDY.format("c_nationkey") + " as study_id", "cast(c_custkey % 4 as string) as consent_code",
        "case c_custkey % 4 when 1 then 'GRU' when 2 then 'HMB' when 3 then '' else 'NRUP' end as consent_abbreviation",
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as person_id",
        "concat(case when substring(o_orderpriority, 1, 1) in ('1', '2') then 'NWD' else 'SMP' end, if(o_orderkey % 499 = 0, ',', ''), o_orderkey) as source_sample_id",
        "case when o_orderkey % 2 = 0 then 'DBGap' else 'submitted' end as sample_source",
    )


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows: a patient cell and six value cells, with null words planted."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "o_orderkey as ord", "l_linenumber as line", "concat('D', o_custkey) as patient",
        "case when l_orderkey % 17 = 0 then 'NA' else cast(cast(l_quantity as bigint) as string) end as quantity",
        "case when l_orderkey % 19 = 0 then '' else cast(cast(round(l_extendedprice) as bigint) as string) end as price",
        "case when l_orderkey % 23 = 0 then 'n/a' when l_orderkey % 29 = 0 then 'unknown' else cast(cast(round(l_discount * 100) as bigint) as string) end as discount",
        "case when l_orderkey % 31 = 0 then '\"R\"' else l_returnflag end as flag",
        "l_linestatus as status", "'null' as empty_column",
    )


VALUES = ("quantity", "price", "discount", "flag", "status", "empty_column")
#: Declared types; the profile decides.
MAPPING = [(f, i + 1, f"µmeasuresµ{f}µ", "NUMERIC" if i % 2 == 0 else "TEXT") for i, f in enumerate(VALUES)]


def mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MAPPING, "field string, column int, path string, declared string")


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept rows under old ids, one for each of three values of an order."""
    o = table(spark, sf_dir, "orders").selectExpr("cast(1000000 + o_custkey as string) as old_id", "o_orderkey as ord", "cast(cast(round(o_totalprice) as bigint) as string) as price", "o_orderstatus as status", "o_orderpriority as priority")
    return o.selectExpr("ord", "old_id", "stack(3, 'µorderµpriceµ', price, '', 'µorderµstatusµ', '', status, 'µorderµpriorityµ', '', priority) as (path, numeric, text)")


def id_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 17 <> 0").selectExpr("cast(1000000 + c_custkey as string) as old_id", "c_custkey as person_id")


def sstr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject and sample rows of all studies, in row order ``ord``."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).selectExpr(
        "o_orderkey as ord", STUDY.format("c_nationkey") + " as study_id", "concat('S', c_custkey) as subject_id",
        "case when o_orderkey % 7 = 0 then '' else concat('T', o_orderkey) end as sample_id",
        "cast(o_orderkey % 4 as string) as consent", "concat('D', c_custkey) as dbgap_subject_id",
        "case when o_orderkey % 5 = 0 then '' else cast(o_orderkey as string) end as dbgap_sample_id",
    )


def patient_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        STUDY.format("c_nationkey") + " as study_id", "case when c_custkey % 2 = 0 then concat('D', c_custkey) when c_custkey % 9 = 0 then concat('X', c_custkey) else concat('S', c_custkey) end as id",
        "cast(1000000 + c_custkey as string) as old_id",
    )


def raw_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as ord", STUDY.format("c_nationkey") + " as study_id", "cast(c_custkey % 3 as string) as consent_code",
        "case when c_custkey % 40 = 7 then elt(c_custkey % 3 + 1, ' ', '[]', '[{}]') else case c_custkey % 3 when 0 then concat(' P', c_custkey % 500, ' ') when 1 then concat('[''P', c_custkey % 500, ''']') "
        "else concat('[{''Value '': ''P', c_custkey % 500, ''', ''kind'': ''x''}, ''Q', c_custkey % 7, ''']') end end as raw",
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of consent folders, one for each document, with merged files and strays among them."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('phs', lpad(regexp_replace(source, '[^0-9]', ''), 6, '0')) as study_id", "concat('c', case lang when 'en' then 1 when 'de' then 2 when 'fr' then 3 else 10 end) as label",
        "doc_id", "md5(coalesce(text, '')) as version_id", "cast(n_chars as bigint) as size",
    ).selectExpr(
        "study_id", "label", "version_id", "size",
        "case when doc_id % 10 = 3 or (study_id like '%4' and label <> 'c2') then concat('notes_', doc_id, '.txt') when doc_id % 10 = 7 or (study_id like '%5' and label <> 'c2') then concat('old_', doc_id, '_allConcepts_merged.csv') "
        "else concat(study_id, '_allConcepts_', doc_id, '.csv') end as name",
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of job reports, one for each event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", STUDY.format("user_id % 25") + " as study_id", "case event_type when 'error' then 'ERROR' when 'purchase' then 'WARNING' else 'INFO' end as severity", "event_type as code", "ts")


_STUDY = "'phs' || lpad(({0} + 1)::VARCHAR, 6, '0')"
WITH = f"""
studies AS (
  SELECT n_nationkey AS ord, n_name AS abv, {_STUDY.format('n_nationkey')} AS study_id,
    CASE n_nationkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'P/G' WHEN 2 THEN 'g' ELSE '' END AS data_type, n_regionkey <> 4 AS is_ready, n_regionkey = 3 AS is_processed FROM nation),
participants AS (SELECT c_custkey AS person_id, 'D' || c_custkey AS source_id, 'DBGap' AS source FROM customer WHERE c_custkey % 11 <> 0),
consents AS (
  SELECT c_custkey AS person_id, {_STUDY.format('c_nationkey')} AS study_id, (c_custkey % 4)::VARCHAR AS consent_code,
    CASE c_custkey % 4 WHEN 1 THEN 'GRU' WHEN 2 THEN 'HMB' WHEN 3 THEN '' ELSE 'NRUP' END AS consent_abbreviation FROM customer WHERE c_custkey % 13 <> 0),
samples AS (
  SELECT o_custkey AS person_id, (CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'NWD' ELSE 'SMP' END) || CASE WHEN o_orderkey % 499 = 0 THEN ',' ELSE '' END || o_orderkey AS source_sample_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'DBGap' ELSE 'submitted' END AS sample_source FROM orders),
decoded AS (
  SELECT o_orderkey AS ord, l_linenumber AS line, 'D' || o_custkey AS patient,
    CASE WHEN l_orderkey % 17 = 0 THEN 'NA' ELSE l_quantity::BIGINT::VARCHAR END AS quantity,
    CASE WHEN l_orderkey % 19 = 0 THEN '' ELSE round(l_extendedprice)::BIGINT::VARCHAR END AS price,
    CASE WHEN l_orderkey % 23 = 0 THEN 'n/a' WHEN l_orderkey % 29 = 0 THEN 'unknown' ELSE round(l_discount * 100)::BIGINT::VARCHAR END AS discount,
    CASE WHEN l_orderkey % 31 = 0 THEN '"R"' ELSE l_returnflag END AS flag, l_linestatus AS status, 'null' AS empty_column
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
mapping AS (SELECT * FROM (VALUES {", ".join(f"('{f}', {c}, '{p}', '{t}')" for f, c, p, t in MAPPING)}) AS m(field, "column", path, declared)),
legacy_rows AS (
  SELECT (1000000 + o_custkey)::VARCHAR AS old_id, o_orderkey AS ord, unnest(['µorderµpriceµ', 'µorderµstatusµ', 'µorderµpriorityµ']) AS path,
    unnest([round(o_totalprice)::BIGINT::VARCHAR, '', '']) AS numeric, unnest(['', o_orderstatus, o_orderpriority]) AS text FROM orders),
id_mapping AS (SELECT (1000000 + c_custkey)::VARCHAR AS old_id, c_custkey AS person_id FROM customer WHERE c_custkey % 17 <> 0),
sstr AS (
  SELECT o_orderkey AS ord, {_STUDY.format('c_nationkey')} AS study_id, 'S' || c_custkey AS subject_id, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'T' || o_orderkey END AS sample_id,
    (o_orderkey % 4)::VARCHAR AS consent, 'D' || c_custkey AS dbgap_subject_id, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderkey::VARCHAR END AS dbgap_sample_id
  FROM orders JOIN customer ON o_custkey = c_custkey),
patient_mapping AS (
  SELECT {_STUDY.format('c_nationkey')} AS study_id, CASE WHEN c_custkey % 2 = 0 THEN 'D' || c_custkey WHEN c_custkey % 9 = 0 THEN 'X' || c_custkey ELSE 'S' || c_custkey END AS id,
    (1000000 + c_custkey)::VARCHAR AS old_id FROM customer),
raw_ids AS (
  SELECT c_custkey AS ord, {_STUDY.format('c_nationkey')} AS study_id, (c_custkey % 3)::VARCHAR AS consent_code,
    CASE WHEN c_custkey % 40 = 7 THEN [] WHEN c_custkey % 3 < 2 THEN ['P' || (c_custkey % 500)] ELSE ['P' || (c_custkey % 500), 'Q' || (c_custkey % 7)] END AS ids FROM customer),
inventory AS (
  SELECT study_id, label, version_id, size,
    CASE WHEN doc_id % 10 = 3 OR (study_id LIKE '%4' AND label <> 'c2') THEN 'notes_' || doc_id || '.txt' WHEN doc_id % 10 = 7 OR (study_id LIKE '%5' AND label <> 'c2') THEN 'old_' || doc_id || '_allConcepts_merged.csv' ELSE study_id || '_allConcepts_' || doc_id || '.csv' END AS name
  FROM (SELECT 'phs' || lpad(regexp_replace(source, '[^0-9]', '', 'g'), 6, '0') AS study_id, 'c' || CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 ELSE 10 END AS label,
    doc_id, md5(coalesce(text, '')) AS version_id, n_chars::BIGINT AS size FROM documents)),
reports AS (
  SELECT event_id, {_STUDY.format('user_id % 25')} AS study_id, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS severity, event_type AS code, ts FROM events)
"""


def sql(body: str) -> str:
    return f"WITH {WITH}{body}"
