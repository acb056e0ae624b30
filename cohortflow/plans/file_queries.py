"""Registered queries that go through files: tables are written by the sinks, or as the lines that a reader expects, and read back.

Files go to a new place in the shared folder. Each query gives what the readers make of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators import reshape as R
from cohortflow.plans import adapter as T
from cohortflow.plans import jobs as K
from cohortflow.plans.queries import _GENOMIC, _IDENTITY, _MANIFEST, _manifest, genomic_samples, identity_map, query, split_concepts
from cohortflow.sources import delimited as D
from cohortflow.sources import files as FI
from cohortflow.sources import sinks
from cohortflow.sources import study_files as SF
from cohortflow.sources.scratch import new_path
from cohortflow.sources.streams import digest_of_lines


def put_lines(df: DataFrame, path: str, *order: str) -> str:
    """One file of the lines in ``value``, in order."""
    df.repartition(1).sortWithinPartitions(*order).select("value").write.text(path)
    return path


def put_table(df: DataFrame, path: str, sep: str, *order: str, parts: int = 3) -> str:
    """Files with a header each, quotes literal; together they hold the rows in order."""
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.drop(*order).write.options(header=True, sep=sep, quote="", emptyValue="", nullValue="").csv(path)
    return path


def lines_of(df: DataFrame, *cells: str | Column, sep: str = "\t") -> Column:
    return F.concat_ws(sep, *[c if isinstance(c, Column) else F.expr(c) for c in cells])


def heads(spark: SparkSession, *lines: str) -> DataFrame:
    return spark.createDataFrame([(-1, i, x) for i, x in enumerate(lines)], "ord long, sub long, value string")


def body(df: DataFrame, order: str, value: Column, sub: str = "0") -> DataFrame:
    return df.select(F.expr(f"cast({order} as long)").alias("ord"), F.expr(f"cast({sub} as long)").alias("sub"), value.alias("value"))


@query("SELECT c_custkey::VARCHAR AS id, CASE c_custkey % 4 WHEN 0 THEN c_name || ', \"x\"' WHEN 1 THEN '\"' || c_mktsegment ELSE c_name END AS name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_nationkey::VARCHAR END AS nation FROM customer")
def delimited_files(spark: SparkSession, d: str) -> DataFrame:
    rows = T.table(spark, d, "customer").selectExpr("c_custkey as id", "case c_custkey % 4 when 0 then concat(c_name, ', \"x\"') when 1 then concat('\"', c_mktsegment) else c_name end as name", "if(c_custkey % 5 = 0, null, c_nationkey) as nation")
    sinks.write_csv_minimal(rows, path := new_path(spark, "delimited"), ["id"])
    return D.read_delimited(spark, path)


@query("SELECT s_suppkey::VARCHAR AS id, '\"' || s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_nationkey || ' \"' END AS note FROM supplier")
def commented_files(spark: SparkSession, d: str) -> DataFrame:
    rows = T.table(spark, d, "supplier")
    value = F.when(F.col("s_suppkey") % 4 == 0, lines_of(rows, "s_suppkey", "concat('\"', s_name)")).otherwise(lines_of(rows, "s_suppkey", "concat('\"', s_name)", "concat(s_nationkey, ' \"')"))
    path = put_lines(heads(spark, "# made for a test", "#", "", "id\tname\tnote").unionByName(body(rows, "s_suppkey", value)), new_path(spark, "commented"), "ord", "sub")
    return D.read_commented(spark, path)


@query("SELECT o_orderkey::VARCHAR AS c0, o_orderstatus AS c1, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey::VARCHAR END AS c2, o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 AS malformed FROM orders")
def positional_files(spark: SparkSession, d: str) -> DataFrame:
    rows = T.table(spark, d, "orders")
    value = F.when(F.expr("o_orderkey % 5 = 0"), lines_of(rows, "o_orderkey", "o_orderstatus", sep=",")).when(
        F.expr("o_orderkey % 7 = 0"), lines_of(rows, "o_orderkey", "o_orderstatus", "o_custkey", "'more'", sep=",")).otherwise(lines_of(rows, "o_orderkey", "o_orderstatus", "o_custkey", sep=","))
    rows.select(value.alias("value")).write.text(path := new_path(spark, "positional"))
    return D.read_positional(spark, path, 3)


@query("SELECT study_id, abv, data_type, is_ready, is_processed FROM studies WHERE ord % 9 <> 4")
def managed_inputs(spark: SparkSession, d: str) -> DataFrame:
    own = {SF.ABV: "if(ord % 9 = 4, ' ', concat(' ', abv))", SF.STUDY: "study_id", SF.KIND: "data_type", SF.READY: "if(is_ready, if(ord % 2 = 0, 'YES', 'Yes'), if(ord % 2 = 0, 'no', ''))", SF.PROCESSED: "if(is_processed, 'yes', 'No')"}
    rows = T.studies(spark, d).selectExpr(*[f"{own.get(h, repr('x, y') if i % 3 else repr(''))} as `{h}`" for i, h in enumerate(SF.HEADINGS)])
    sinks.write_csv_minimal(rows, path := new_path(spark, "managed"), [SF.STUDY])
    return SF.read_managed_inputs(spark, path).select("study_id", "abv", "data_type", "is_ready", "is_processed")


@query("""SELECT 'f' || (p_partkey % 20) || '.csv' AS file, p_size AS "column", 'µr' || (p_partkey % 3) || 'µ' || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand || 'µ' END AS path,
  CASE WHEN p_partkey % 2 = 0 THEN 'NUMERIC' ELSE 'TEXT' END AS declared, CASE WHEN p_partkey % 7 = 0 THEN 3 ELSE 0 END AS patient_column, count(*) AS rows
FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 17 <> 0 AND p_partkey % 19 <> 0 GROUP BY ALL""")
def concept_mappings(spark: SparkSession, d: str) -> DataFrame:
    return _mapping(spark, d)[0].groupBy("file", "column", "path", "declared", "patient_column").agg(F.count("*").alias("rows"))


def _mapping(spark: SparkSession, d: str):
    rows = T.table(spark, d, "part")
    value = (
        F.when(F.expr("p_partkey % 13 = 0"), lines_of(rows, "'bad'", "'r'", "p_brand", "'TEXT'", "''", sep=","))
        .when(F.expr("p_partkey % 19 = 0"), lines_of(rows, "'f.csv:1'", "'r'", sep=",")).when(F.expr("p_partkey % 17 = 0"), lines_of(rows, "'f.csv:2'", "''", "p_brand", "'TEXT'", "''", sep=","))
        .otherwise(lines_of(rows, "concat('f', p_partkey % 20, '.csv: ', p_size)", "concat('\\\\r', p_partkey % 3, '\\\\')", "if(p_partkey % 5 = 0, '', concat('\"', p_brand, '\"'))", "if(p_partkey % 2 = 0, 'numeric', 'word')", "if(p_partkey % 7 = 0, 'a=b;PatientCol = 3', '')", sep=","))
    )
    lines = heads(spark, "file column,root,sup,type,options", "").unionByName(body(rows, "p_partkey", value))
    return SF.read_concept_mapping(spark, put_lines(lines, new_path(spark, "mapping"), "ord", "sub"))


@query("SELECT CASE WHEN p_partkey % 13 = 0 THEN 'BAD_KEY' WHEN p_partkey % 19 = 0 THEN 'TOO_FEW_COLUMNS' ELSE 'NO_ROOT' END AS reason, count(*) AS rows FROM part WHERE p_partkey % 13 = 0 OR p_partkey % 17 = 0 OR p_partkey % 19 = 0 GROUP BY 1")
def dropped_mappings(spark: SparkSession, d: str) -> DataFrame:
    return _mapping(spark, d)[1].groupBy("reason").agg(F.count("*").alias("rows"))


@query("SELECT subject_id, sample_id, consent, 'GRU' AS consent_abbreviation, dbgap_subject_id, dbgap_sample_id FROM sstr")
def sstr_files(spark: SparkSession, d: str) -> DataFrame:
    rows = T.sstr(spark, d).selectExpr("ord", "concat(' ', subject_id) as SUBJECT_ID", "sample_id as SAMPLE_ID", "consent as CONSENT", "'GRU' as consent_abbreviation", "dbgap_subject_id", "dbgap_sample_id")
    return SF.read_sstr(spark, put_table(rows, new_path(spark, "sstr"), "\t", "ord")).drop("ord")


_CODE = "CASE WHEN ord % 11 = 0 THEN '' WHEN ord % 11 = 1 THEN 'x' ELSE '0' || consent END"
_SUBJECTS = f""", listed AS (SELECT ord, CASE WHEN ord % 23 = 0 THEN '' ELSE dbgap_subject_id END AS id, CASE WHEN ord % 3 = 0 THEN '' ELSE subject_id || '.' || (ord % 5) END AS subject_id, {_CODE} AS raw FROM sstr),
coded AS (SELECT *, CASE WHEN regexp_matches(raw, '^[0-9]+$') THEN coalesce(nullif(ltrim(raw, '0'), ''), '0') END AS code FROM listed)
"""


def _subjects(spark: SparkSession, d: str):
    rows = T.sstr(spark, d).selectExpr("ord", "if(ord % 23 = 0, '', dbgap_subject_id) as `dbGaP SubjID`", "if(ord % 3 = 0, '', concat(subject_id, '.', ord % 5)) as SUBJID", f"{_CODE.replace('||', chr(124) * 2)} as gencons", "'more' as other")
    return SF.read_subjects(spark, put_table(rows, new_path(spark, "subjects"), "\t", "ord"))


@query(_SUBJECTS + """, firsts AS (
  SELECT id, arg_min(code, ord) FILTER (code <> '0') AS code, arg_min(subject_id, ord) FILTER (code <> '0') AS subject_id, bool_or(coalesce(code = '0', FALSE)) AS zero, arg_min(subject_id, ord) FILTER (code = '0' AND subject_id <> '') AS zero_id FROM coded WHERE id <> '' GROUP BY 1)
SELECT id AS dbgap_id, CASE WHEN code IS NULL THEN coalesce(zero_id, '') ELSE subject_id END AS subject_id, code, CASE WHEN code IS NOT NULL THEN (SELECT count(*) FROM coded c WHERE c.id = f.id AND c.code NOT IN ('0', f.code)) END AS conflicts FROM firsts f WHERE code IS NOT NULL OR zero""")
def subject_files(spark: SparkSession, d: str) -> DataFrame:
    yes, no, _ = _subjects(spark, d)
    return yes.select("dbgap_id", "subject_id", "code", "conflicts").unionByName(no.select("dbgap_id", "subject_id"), allowMissingColumns=True)


@query(_SUBJECTS + """SELECT CASE WHEN id = '' THEN 'BLANK_SUBJECT' WHEN raw = '' THEN 'BLANK_CONSENT' WHEN code IS NULL THEN 'CONSENT_NOT_A_NUMBER' ELSE 'CONSENT_ZERO' END AS code, CASE WHEN id <> '' AND code = '0' AND raw <> '' THEN 'INFO' ELSE 'WARNING' END AS severity,
  count(*) AS count, array_to_string((list(id || ':' || raw ORDER BY ord))[:10], ',') AS examples FROM coded WHERE id = '' OR coalesce(code, '0') = '0' GROUP BY ALL""")
def subject_issues(spark: SparkSession, d: str) -> DataFrame:
    from cohortflow.operators.aggregates import issue_tally

    return issue_tally(_subjects(spark, d)[2], [], "example", "ord").withColumn("examples", F.array_join("examples", ","))


@query("SELECT dbgap_subject_id AS subject_id, dbgap_sample_id, sample_id FROM sstr WHERE ord % 29 <> 0 AND (dbgap_sample_id <> '' OR sample_id <> '')")
def sample_files(spark: SparkSession, d: str) -> DataFrame:
    rows = T.sstr(spark, d).selectExpr("ord", "if(ord % 29 = 0, '', dbgap_subject_id) as dbGaP_Subject_ID", "dbgap_sample_id as dbGaP_Sample_ID", "sample_id as SAMPID")
    return SF.read_samples(spark, put_table(rows, new_path(spark, "samples"), "\t", "ord"))[0].drop("ord")


@query("SELECT ltrim(n_regionkey::VARCHAR, '0') || (n_regionkey + 1) AS consent_code, arg_min(n_name || ' (' || left(n_name, 3) || ')', n_nationkey) AS label FROM nation GROUP BY n_regionkey")
def consent_dictionaries(spark: SparkSession, d: str) -> DataFrame:
    one = T.table(spark, d, "nation").selectExpr("n_nationkey as ord", "concat('<value code=\"0', n_regionkey, n_regionkey + 1, '\">', n_name, ' (', substring(n_name, 1, 3), ')</value>') as value")
    values = one.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda x: x["value"]), "").alias("v"))
    text = values.select(F.concat(F.lit('<data_table><variable id="a"><name>sex</name><value code="1">male</value></variable><variable id="b"><name>GENCONS</name>'), "v", F.lit('</variable></data_table>')).alias("value"))
    text.repartition(1).write.text(path := new_path(spark, "dictionary"))
    return SF.read_consent_decodings(spark, path, "gencons")


@query("SELECT id, old_id FROM patient_mapping")
def patient_mappings(spark: SparkSession, d: str) -> DataFrame:
    rows = T.patient_mapping(spark, d)
    rows.select(lines_of(rows, "concat(id, ' ')", "study_id", "old_id", sep=",").alias("value")).write.text(path := new_path(spark, "patients"))
    return SF.read_patient_mapping(spark, path)


@query("SELECT old_id, CASE WHEN person_id % 6 = 0 THEN 'C' WHEN person_id % 3 = 0 THEN 'B' ELSE 'A' END || person_id AS new_id FROM id_mapping")
def id_mappings(spark: SparkSession, d: str) -> DataFrame:
    """The last row of an id counts, over two folders of files of unequal sizes."""
    rows, root = T.id_mapping(spark, d), new_path(spark, "ids")
    first = rows.selectExpr("person_id as ord", f"old_id as {SF.OLD_ID}", f"concat('A', person_id) as {SF.NEW_ID}", "'x' as more")
    later = rows.where("person_id % 3 = 0").selectExpr("person_id as ord", f"old_id as {SF.OLD_ID}", "explode(array('B', 'C')) as letter", "person_id", "'a longer cell, so that this smaller file is not the shorter one' as more").where("letter = 'B' or person_id % 6 = 0")
    put_table(first, f"{root}/a", ",", "ord", parts=1)
    put_table(later.selectExpr("ord", "letter", SF.OLD_ID, f"concat(letter, person_id) as {SF.NEW_ID}", "replace(more, ',', ' ') as more"), f"{root}/b", ",", "ord", "letter", parts=1)
    return SF.read_id_mapping(spark, f"{root}/*")


@query("SELECT study_id, consent_code, CASE c_custkey % 3 WHEN 0 THEN 'P' || c_custkey ELSE '[''P' || c_custkey || ''']' END AS raw FROM (SELECT *, 'phs' || lpad((c_nationkey + 1)::VARCHAR, 6, '0') AS study_id, (c_custkey % 4)::VARCHAR AS consent_code FROM customer) WHERE c_custkey % 4 < 3")
def person_trees(spark: SparkSession, d: str) -> DataFrame:
    """Persons of consent groups in the newest of two datasets; a group without a consent in its name is passed over."""
    root, stage = new_path(spark, "persons"), new_path(spark, "persons")
    rows = T.table(spark, d, "customer").selectExpr(f"concat('n-', {T.STUDY.format('c_nationkey')}, '-v1', if(c_custkey % 4 = 3, '', concat('-c', c_custkey % 4))) as g", "concat(c_custkey, '\t', if(c_custkey % 3 = 0, concat('P', c_custkey), concat('[''P', c_custkey, ''']'))) as value", "c_custkey as ord")
    lines = rows.select("g", F.col("ord").alias("ord"), "value").unionByName(rows.select("g").distinct().selectExpr("g", "-1L as ord", "'id\t Identity ' as value"))
    lines.repartition("g").sortWithinPartitions("g", "ord").select("g", "value").write.partitionBy("g").text(stage)
    sinks.move_files(sinks.written_files(spark, stage, "g").selectExpr("path", "concat('set-20250601/study/consent_groups/', g, '/a/mapped-data/Person.tsv') as name"), root)
    names = spark.createDataFrame([("set-20250601",), ("set-20240601",), ("else",)], "name string")
    return SF.read_person_tree(spark, root, FI.latest_dataset(names)).select("study_id", "consent_code", "raw")


@query("SELECT max(name) AS dataset FROM (SELECT 'set-2025' || lpad((n_nationkey % 12 + 1)::VARCHAR, 2, '0') || '10' AS name FROM nation)")
def newest_dataset(spark: SparkSession, d: str) -> DataFrame:
    names = T.table(spark, d, "nation").selectExpr("concat('set-2025', lpad(n_nationkey % 12 + 1, 2, '0'), '10') as name").union(T.table(spark, d, "region").selectExpr("concat('zzz', r_name)"))
    return spark.createDataFrame([(FI.latest_dataset(names),)], "dataset string")


_LINES = """, out AS (SELECT study_id, 'c' || consent_code AS label, study_id || '_allConcepts_c' || consent_code || '.csv' AS name, person_id::VARCHAR AS person_id, path, numeric, CASE WHEN person_id % 5 = 0 THEN text || ' "q", z' ELSE text END AS text FROM legacy_rows JOIN id_mapping USING (old_id) JOIN consents USING (person_id))
"""


def _published(spark: SparkSession, d: str) -> str:
    rows = split_concepts(spark, d).withColumns({"timestamp": F.lit("0"), "text": F.expr("if(person_id % 5 = 0, concat(text, ' \"q\", z'), text)")})
    sinks.write_concepts(rows, stage := new_path(spark, "concepts"))
    sinks.publish_concepts(spark, stage, target := new_path(spark, "published"))
    return target


@query(_LINES + "SELECT person_id, path, numeric, text, '0' AS timestamp, false AS malformed FROM out")
def concept_files(spark: SparkSession, d: str) -> DataFrame:
    return SF.read_all_concepts(spark, f"{_published(spark, d)}/*/allConcepts/*/*_allConcepts_*.csv")


@query(_LINES + "SELECT study_id, label, name, sum(octet_length(encode(person_id || path || numeric || replace(text, '\"', '\"\"'))) + 16)::BIGINT AS size FROM out GROUP BY ALL")
def file_inventories(spark: SparkSession, d: str) -> DataFrame:
    return FI.file_inventory(spark, _published(spark, d)).select("study_id", "label", "name", "size")


@query(_LINES + """, lined AS (SELECT label, name, '"' || person_id || '","' || path || '","' || numeric || '","' || replace(text, '"', '""') || '","0"' AS value FROM out)
SELECT label, name, count(*) AS lines, count(*) AS distinct_places, md5(string_agg(value, chr(10) ORDER BY value)) AS digest FROM lined GROUP BY ALL""")
def concatenated_sources(spark: SparkSession, d: str) -> DataFrame:
    """Every line of the files of all groups, with its file and a place of its own."""
    rows = R.concatenated(spark, f"{_published(spark, d)}/*/allConcepts/*/*.csv").withColumn("label", F.concat(F.lit("c"), F.regexp_extract("name", "_c(\\d+)\\.csv$", 1)))
    counts = rows.groupBy("label", "name").agg(F.count("*").alias("lines"), F.count_distinct("place").alias("distinct_places"))
    return counts.join(digest_of_lines(rows, ["label", "name"], "value", "value", "md5", "\n").withColumnRenamed("fingerprint", "digest"), ["label", "name"])


_REPORTS = ", tally AS (SELECT study_id, severity, code, count(*) AS n FROM reports GROUP BY ALL)\n"


@query(_REPORTS + "SELECT 'job-' || study_id AS \"jobName\", CASE severity WHEN 'INFO' THEN 'input' ELSE 'output' END AS phase, severity, code, n || ' times' AS message, study_id AS study FROM tally")
def report_files(spark: SparkSession, d: str) -> DataFrame:
    """Issues of the reports of all studies, read from a file for each; a broken file among them is passed over."""
    from cohortflow.functions.studies import issue_study

    tally = T.reports(spark, d).groupBy("study_id", "severity", "code").agg(F.count("*").alias("n"))
    issue = F.struct("severity", "code", F.concat("n", F.lit(" times")).alias("message"), F.lit("x").alias("location"), F.create_map(F.lit("studyId"), F.col("study_id")).alias("context"))
    phases = [F.struct(F.collect_list(F.when(c, issue)).alias("issues"), F.struct(F.lit(0).alias("error")).alias("counts")).alias(f"{p}Validation") for p, c in (("input", F.col("severity") == "INFO"), ("output", F.col("severity") != "INFO"))]
    docs = tally.groupBy("study_id").agg(*phases).select("study_id", F.to_json(F.struct(F.concat(F.lit("job-"), "study_id").alias("jobName"), F.lit("r").alias("runId"), F.lit("SUCCESS").alias("status"), "inputValidation", "outputValidation")).alias("value"))
    docs = docs.unionByName(docs.limit(1).select(F.lit("broken").alias("study_id"), F.substring("value", 1, 40).alias("value")))
    docs.repartition("study_id").write.partitionBy("study_id").text(stage := new_path(spark, "reports"))
    sinks.move_files(sinks.written_files(spark, stage, "study_id").selectExpr("path", "concat(study_id, '.json') as name"), root := new_path(spark, "reports"))
    rows = FI.issues(FI.read_reports(spark, f"{root}/*.json"))
    return rows.select("jobName", "phase", "severity", "code", "message", issue_study(F.col("context"), F.col("location"), F.col("message")).alias("study"))


@query("SELECT study_id, abv, CASE WHEN is_ready THEN '\"ready' ELSE '' END AS note FROM studies")
def run_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = T.studies(spark, d).selectExpr("ord", "study_id", "abv", "if(is_ready, '\"ready', '') as note")
    return D.read_run_tsv(spark, put_table(rows, new_path(spark, "run"), "\t", "ord"))


@query("SELECT study_id, abv, CASE WHEN is_ready THEN 'a; b' ELSE '' END AS why FROM studies")
def outcome_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = T.studies(spark, d).selectExpr("study_id", "abv", "if(is_ready, array('a', 'b'), array()) as why")
    sinks.write_reports(path := new_path(spark, "outcomes"), ["study_id"], studies=rows)
    flat, whole = D.read_delimited(spark, f"{path}/studies.csv"), spark.read.schema("study_id string, abv string, why array<string>").json(f"{path}/studies.json")
    return flat.join(whole.select("study_id", F.array_join("why", "; ").alias("w")), "study_id").where("why = w").select("study_id", "abv", "why")


@query(_GENOMIC + """, lists AS (SELECT consent_group, string_agg(source_sample_id, ',' ORDER BY source_sample_id, person_id, sample_source) AS s, string_agg(person_id, ',' ORDER BY source_sample_id, person_id, sample_source) AS p FROM groups GROUP BY 1)
SELECT consent_group, md5(consent_group) AS line FROM lists UNION ALL SELECT consent_group, md5(concat_ws(chr(9), 'vcf_path', 'chromosome', 'isAnnotated', 'isGzipped', 'sample_ids', 'patient_ids', 'sample_relationship', 'related_sample_ids')) FROM lists
UNION ALL SELECT consent_group, md5(concat_ws(chr(9), 'data/vcfInput/' || consent_group || '.chr' || c || '.annotated_remove_modifiers.hpds.vcf.gz', c, 'TRUE', 'TRUE', s, p, '', '')) FROM lists, (SELECT unnest(list_concat(list_transform(range(1, 23), lambda i: i::VARCHAR), ['X'])) AS c)""")
def vcf_index_files(spark: SparkSession, d: str) -> DataFrame:
    sinks.write_vcf_indexes(K.genomic_indexes(genomic_samples(spark, d)), path := new_path(spark, "vcf"))
    return sinks.written_lines(spark, path, "consent_group").select("consent_group", F.md5("value").alias("line"))


@query(_GENOMIC + "SELECT consent_group, person_id || ',' || abv || ',' || source_sample_id AS value FROM groups")
def sample_id_files(spark: SparkSession, d: str) -> DataFrame:
    sinks.write_sample_ids(genomic_samples(spark, d), path := new_path(spark, "sample-ids"))
    return sinks.written_lines(spark, path, "consent_group").select("consent_group", "value")


@query(_IDENTITY + "SELECT identity, study_id, consent_code, row_number() OVER (ORDER BY identity, study_id, consent_code) AS place FROM map")
def identity_map_files(spark: SparkSession, d: str) -> DataFrame:
    """The map read back from files that are ranges, numbered in the order in which they stand."""
    from pyspark.sql.window import Window

    from cohortflow.operators.dedup import with_row_order

    sinks.write_identity_map(identity_map(spark, d), path := new_path(spark, "identities"), per_study=False, files=3)
    rows = with_row_order(D.read_delimited(spark, path))
    return rows.select("identity", "study_id", "consent_code", F.row_number().over(Window.orderBy("ord")).cast("long").alias("place"))


@query("SELECT 'consents' AS \"table\", person_id, study_id AS key FROM consents UNION ALL SELECT 'participants', person_id, source_id FROM participants")
def identity_tables(spark: SparkSession, d: str) -> DataFrame:
    """What the second of two snapshots holds."""
    people, consents, root = T.participants(spark, d), T.consents(spark, d), new_path(spark, "store")
    sinks.write_identity_tables(spark, root, participants=people.where("person_id % 2 = 0"), consents=consents.where("person_id % 2 = 0"))
    sinks.write_identity_tables(spark, root, participants=people, consents=consents)
    back = {t: sinks.read_identity_table(spark, root, t) for t in ("participants", "consents")}
    return back["consents"].select(F.lit("consents").alias("table"), "person_id", F.col("study_id").alias("key")).unionByName(back["participants"].select(F.lit("participants").alias("table"), "person_id", F.col("source_id").alias("key")))


@query(_MANIFEST + """SELECT 'global' AS partition, 'store://global.csv' AS uri, 'g1' AS version_id, '2026-01-02' AS last_updated, md5('g') AS md5
UNION ALL SELECT study_id || '.' || label, 'store://' || study_id || '/allConcepts/' || label || '/' || study_id || '_' || label || '_allConcepts_MERGED.csv', 'v1', '2026-01-01', md5(label) FROM good""")
def published_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as it is read back; with an error among the problems nothing would be there."""
    rows, problems = _manifest(spark, d)
    root = new_path(spark, "manifest")
    if sinks.publish_manifest(rows, problems.where("false").unionByName(problems.where("severity = 'ERROR'").limit(1)), f"{root}/refused", "r1"):
        raise ValueError("a manifest with an error was published")
    sinks.publish_manifest(rows, problems.where("severity <> 'ERROR'"), root, "r2")
    return D.read_delimited(spark, f"{root}/{spark.read.text(f'{root}/current').head()[0]}/manifest")
