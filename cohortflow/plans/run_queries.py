"""Registered queries of whole runs: gates over what jobs returned, merges run twice, and versions of tables and file sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators import aggregates as A
from cohortflow.operators import identity as I
from cohortflow.operators import reshape as R
from cohortflow.plans import adapter as T
from cohortflow.plans import gates as V
from cohortflow.plans import jobs as K
from cohortflow.plans.job_queries import _RUN, _SOURCES, _migrated
from cohortflow.plans.queries import _GENOMIC, _RESOLVED, _SPLIT, query, resolved_patients, split_concepts
from cohortflow.sources import sinks, store
from cohortflow.sources import study_files as SF
from cohortflow.sources.scratch import new_path, written
from cohortflow.sources.streams import remove_files


@query(""", fresh AS (SELECT study_id, count(DISTINCT dbgap_subject_id) AS n FROM sstr WHERE dbgap_subject_id NOT IN (SELECT source_id FROM participants) GROUP BY 1)
SELECT 1 AS load, study_id, 'WARNING' AS severity, 'NO_NEW_PARTICIPANTS' AS code FROM (SELECT DISTINCT study_id FROM sstr) WHERE study_id NOT IN (SELECT study_id FROM fresh)
UNION ALL SELECT 2, study_id, 'WARNING', unnest(['NO_NEW_PARTICIPANTS', 'NO_NEW_SAMPLES']) FROM (SELECT DISTINCT study_id FROM sstr)""")
def load_gates(spark: SparkSession, d: str) -> DataFrame:
    """The gates of a load of all studies, and of the same load over its own result, which brings nothing new."""
    rows = T.sstr(spark, d).withColumn("consent_abbreviation", F.lit("GRU"))
    people, consents, samples, counts = I.load_sstr(T.participants(spark, d), T.consents(spark, d), T.samples(spark, d), rows)
    again = I.load_sstr(written(people, "people"), written(consents, "consents"), written(samples, "samples"), rows)[3]
    return R.union(*[V.load_checks(c, ["study_id"]).withColumn("load", F.lit(i)) for i, c in ((1, counts), (2, again))]).select("load", "study_id", "severity", "code")


@query(_GENOMIC + "SELECT consent_group, 'ERROR' AS severity, 'GROUP_HELD_BACK' AS code FROM held UNION ALL SELECT NULL, 'WARNING', 'NOTHING_TO_INDEX' WHERE (SELECT count(*) FROM groups) = 0")
def genomic_gates(spark: SparkSession, d: str) -> DataFrame:
    """The gates of an index run, over the groups that it indexed and those that it held back."""
    rows, held = K.genomic_groups(T.studies(spark, d), T.consents(spark, d), T.samples(spark, d))
    groups = rows.groupBy("consent_group").agg(F.count("*").alias("samples"))
    return V.genomic_checks(groups, held, groups.count())


@query(_GENOMIC + "SELECT 1 AS version, consent_group AS name, 25 AS lines FROM (SELECT DISTINCT consent_group FROM all_groups) UNION ALL SELECT 2, consent_group, 25 FROM (SELECT DISTINCT consent_group FROM groups)")
def index_sets(spark: SparkSession, d: str) -> DataFrame:
    """Two sets of index files: the first from samples whose ids are mended, the second from all; groups that it holds back are not in it."""
    root, out = new_path(spark, "index-sets"), []
    for samples in (T.samples(spark, d).withColumn("source_sample_id", F.translate("source_sample_id", ",", "")), T.samples(spark, d)):
        stage = new_path(spark, "index-staged")
        sinks.write_vcf_indexes(K.genomic_indexes(K.genomic_groups(T.studies(spark, d), T.consents(spark, d), samples)[0]), stage)
        store.publish_set(spark, root, sinks.written_files(spark, stage, "consent_group").select(F.col("consent_group").alias("name"), "path"))
    for n in (1, 2):
        files = store.read_set(spark, root, n)
        paths = [r["path"] for r in files.select("path").collect()]
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("lines")) if paths else spark.createDataFrame([], "path string, lines long")
        base = F.regexp_extract("path", "([^/]+/[^/]+)$", 1)  # part files of a write share their names
        out.append(files.select("name", base.alias("f")).join(lines.select(base.alias("f"), "lines"), "f").select(F.lit(n).alias("version"), "name", F.col("lines").cast("int").alias("lines")))
    return R.union(*out)


@query(""", ids AS (SELECT study_id, dbgap_subject_id AS s, arg_min(consent, ord) AS consent, CASE WHEN right(study_id, 1) IN ('0', '2', '4', '6', '8') THEN 1 ELSE 2 END AS turn FROM sstr GROUP BY ALL),
firsts AS (SELECT s, row_number() OVER (ORDER BY s) + (SELECT max(person_id) FROM participants) AS pid FROM (SELECT DISTINCT s FROM ids WHERE turn = 1 AND s NOT IN (SELECT source_id FROM participants))),
seconds AS (SELECT s, row_number() OVER (ORDER BY s) + coalesce((SELECT max(pid) FROM firsts), (SELECT max(person_id) FROM participants)) AS pid FROM (SELECT DISTINCT s FROM ids WHERE turn = 2 AND s NOT IN (SELECT source_id FROM participants) AND s NOT IN (SELECT s FROM firsts)))
SELECT study_id, consent AS consent_code, count(*) AS people, sum(coalesce(person_id, f.pid, g.pid))::BIGINT AS numbers FROM ids LEFT JOIN participants ON source_id = s LEFT JOIN firsts f ON f.s = ids.s LEFT JOIN seconds g ON g.s = ids.s GROUP BY ALL""")
def identity_store(spark: SparkSession, d: str) -> DataFrame:
    """Studies loaded into a store in two turns, the second by a writer that began before the first was done: its numbers follow the first's."""
    root = new_path(spark, "identity-store")
    rows = T.sstr(spark, d).withColumn("consent_abbreviation", F.lit("GRU"))
    even = F.substring("study_id", -1, 1).isin("0", "2", "4", "6", "8")
    store.write_changes(spark, root, lambda _: {"participants": ("whole", T.participants(spark, d)), "consents": ("studies", T.consents(spark, d)), "samples": ("whole", T.samples(spark, d))})

    def load(sstr: DataFrame):
        def change(before: dict[str, DataFrame]):
            people, consents, samples, _ = I.load_sstr(before["participants"], before["consents"], before["samples"], sstr)
            return I.changes(before, written(people, "people"), consents, samples, sstr)

        return change

    late, done = load(rows.where(~even)), []

    def overtaken(before: dict[str, DataFrame]):
        out = late(before)
        if not done:
            done.append(store.write_changes(spark, root, load(rows.where(even))))
        return out

    store.write_changes(spark, root, overtaken)
    own = store.tables(spark, root)["consents"].join(rows.select("study_id").distinct(), "study_id", "left_semi")
    return own.groupBy("study_id", "consent_code").agg(F.count("*").alias("people"), F.sum("person_id").alias("numbers"))


_MERGED = _SOURCES + """, folders AS (SELECT study_id, label, count(DISTINCT name) AS sources, md5(string_agg(value || chr(10), '' ORDER BY name, o)) AS first_md5, md5(string_agg(value || chr(10), '' ORDER BY name, o) || 'more' || chr(10)) AS second_md5,
  CASE WHEN label = 'c1' THEN 'SOURCES_CHANGED' WHEN label = 'c3' AND right(study_id, 1) IN ('1', '4', '7') THEN 'REMOVED_NO_SOURCES' ELSE 'UP_TO_DATE' END AS action FROM lined GROUP BY ALL)
"""


def _merge_runs(spark: SparkSession, d: str) -> tuple[str, DataFrame, DataFrame]:
    """Folders merged, some changed or emptied, and merged again: the root, and what became of them in each run."""
    rows = split_concepts(spark, d).withColumns({"timestamp": F.lit("0"), "label": F.concat(F.lit("c"), "consent_code"), "name": F.expr("concat(study_id, '_allConcepts_', person_id % 3, '.csv')")})
    rows = rows.select("study_id", "label", "name", F.expr("concat(lpad(person_id, 9, '0'), path, numeric, text)").alias("o"), sinks.concept_line().alias("value"))
    root = new_path(spark, "merge-root")

    def put(lines: DataFrame) -> None:
        stage = new_path(spark, "merge-staged")
        lines.repartition("study_id", "label", "name").sortWithinPartitions("study_id", "label", "name", "o").drop("o").write.partitionBy("study_id", "label", "name").text(stage)
        sinks.move_files(sinks.written_files(spark, stage, "study_id", "label", "name").selectExpr("path", "concat(study_id, '/allConcepts/', label, '/', name) as name"), root)

    put(rows)
    first, recorded = K.merge_run(spark, root, spark.createDataFrame([], "study_id string, label string, recorded_fingerprint string, recorded_md5 string"))
    folders = first.select("study_id", "label")
    put(folders.where("label = 'c1'").selectExpr("study_id", "label", "concat(study_id, '_allConcepts_z.csv') as name", "'' as o", "'more' as value"))
    gone = folders.where("label = 'c3' and right(study_id, 1) in ('1', '4', '7')").selectExpr("study_id", "label", "explode(array(0, 1, 2)) as i")
    written(remove_files(gone.select(F.concat(F.lit(f"{root}/"), "study_id", F.lit("/allConcepts/"), "label", F.lit("/"), "study_id", F.lit("_allConcepts_"), "i", F.lit(".csv")).alias("path"))), "gone")
    return root, first, K.merge_run(spark, root, recorded)[0]


@query(_MERGED + """SELECT 1 AS run, study_id, label, 'MISSING' AS action, sources, sources AS files_merged, first_md5 AS md5 FROM folders
UNION ALL SELECT 2, study_id, label, action, CASE action WHEN 'REMOVED_NO_SOURCES' THEN 0 WHEN 'SOURCES_CHANGED' THEN sources + 1 ELSE sources END, CASE action WHEN 'SOURCES_CHANGED' THEN sources + 1 ELSE 0 END,
  CASE action WHEN 'UP_TO_DATE' THEN first_md5 WHEN 'SOURCES_CHANGED' THEN second_md5 END FROM folders""")
def merge_runs(spark: SparkSession, d: str) -> DataFrame:
    """What became of each folder in two runs. The second opens only what changed, and removes what lost its sources."""
    _, first, second = _merge_runs(spark, d)
    return R.union(*[df.select(F.lit(i).alias("run"), "study_id", "label", "action", "sources", "files_merged", "md5") for i, df in ((1, first), (2, second))])


@query(_MERGED + """SELECT study_id, label, 'WARNING' AS severity, 'MERGED_FILE_REMOVED' AS code FROM folders WHERE action = 'REMOVED_NO_SOURCES'
UNION ALL SELECT study_id, NULL, 'WARNING', 'STUDY_WITHOUT_FOLDERS' FROM studies WHERE is_ready AND study_id NOT IN (SELECT study_id FROM folders) UNION ALL SELECT NULL, NULL, 'ERROR', 'COUNTS_DIFFER'""")
def merge_gates(spark: SparkSession, d: str) -> DataFrame:
    """The gates of a merge that ran; and that its counts by action add up, which they don't for counts that lack an action."""
    second = _merge_runs(spark, d)[2]
    counts = second.groupBy("action").agg(F.count("*").alias("folders"))
    whole, part = V.merge_consistency(second, counts), V.merge_consistency(second, counts.where("action <> 'SOURCES_CHANGED'"))
    none = F.lit(None).cast("string")
    return V.merge_issues(second, T.studies(spark, d)).unionByName(R.union(whole, part).select(none.alias("study_id"), none.alias("label"), "severity", "code"))


@query("""SELECT v AS variant, 'ERROR' AS severity, code FROM (VALUES ('none', 'GLOBAL_MISSING'), ('unversioned', 'GLOBAL_NOT_VERSIONED'), ('empty', 'GLOBAL_EMPTY'), ('none', 'NO_CONSENT_GROUPS')) t(v, code) WHERE (SELECT count(*) FROM inventory) > 0""")
def global_file_problems(spark: SparkSession, d: str) -> DataFrame:
    """A manifest's global file that is not there, has no version, or holds nothing; the first also without any consent group."""
    files = T.inventory(spark, d)
    groups = files.select(F.concat_ws(".", "study_id", "label").alias("partition")).distinct()
    one = files.agg(F.sum("size").alias("size")).select(F.lit("g1").alias("version_id"), "size")
    variants = {"none": (one.limit(0), groups.limit(0)), "unversioned": (one.withColumn("version_id", F.lit("null")), groups), "empty": (one.withColumn("size", F.lit(0).cast("long")), groups), "good": (one, groups)}
    return R.union(*[V.global_problems(g, k).select(F.lit(v).alias("variant"), "severity", "code") for v, (g, k) in variants.items()])


@query(""", folder_bytes AS (SELECT study_id || '.' || label AS folder, sum(size)::BIGINT AS bytes FROM inventory GROUP BY 1)
SELECT folder, bytes, row_number() OVER (ORDER BY bytes DESC, folder)::INTEGER AS place FROM folder_bytes QUALIFY place <= 20""")
def largest_folders(spark: SparkSession, d: str) -> DataFrame:
    """A report of the twenty largest folders, in the order in which a merge takes them up."""
    from pyspark.sql.window import Window

    sizes = T.inventory(spark, d).groupBy(F.concat_ws(".", "study_id", "label").alias("folder")).agg(F.sum("size").alias("bytes"))
    top = R.largest_first(sizes, "bytes", "folder").limit(20)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.col("bytes").desc(), "folder")))


_BAD_LINE = "ord % 10 = 3"
_LEGACY = f""", lined AS (SELECT *, ord % 10 = 3 AND path LIKE '%price%' AS bad FROM legacy_rows),
classed_lines AS (SELECT CASE WHEN bad THEN 'malformed' WHEN m.person_id IS NULL THEN 'unmapped' WHEN c.study_id IS NULL THEN 'no_consent' ELSE 'written' END AS class, count(*) AS rows, count(DISTINCT old_id) AS ids FROM lined l LEFT JOIN id_mapping m USING (old_id) LEFT JOIN consents c ON c.person_id = m.person_id GROUP BY 1)
"""


@query(_LEGACY + "SELECT class, rows, ids FROM classed_lines")
def legacy_file_counts(spark: SparkSession, d: str) -> DataFrame:
    """A split of legacy concept files, some of whose lines lack cells, which makes them malformed, or have one more, which is passed over."""
    rows = T.legacy_rows(spark, d).withColumn("timestamp", F.lit("0")).withColumnRenamed("old_id", "person_id")
    short = F.concat_ws(",", *[F.concat(F.lit('"'), c, F.lit('"')) for c in ("person_id", "path")])
    value = F.when(F.expr(f"{_BAD_LINE} and path like '%price%'"), short).when(F.expr(_BAD_LINE), F.concat(sinks.concept_line(), F.lit(',"more"'))).otherwise(sinks.concept_line())
    rows.select(value.alias("value")).write.text(path := new_path(spark, "legacy"))
    back = SF.read_all_concepts(spark, path).withColumnRenamed("person_id", "old_id")
    return K.split_concepts(back, T.id_mapping(spark, d), T.consents(spark, d))[1]


@query(_SPLIT + ", lost AS (SELECT DISTINCT old_id FROM keyed WHERE person_id IS NULL) SELECT count(*) AS ids, array_to_string((list(old_id ORDER BY old_id))[:10], ',') AS examples FROM lost HAVING count(*) > 0")
def unmapped_ids(spark: SparkSession, d: str) -> DataFrame:
    return A.unmapped_examples(T.legacy_rows(spark, d), T.id_mapping(spark, d)).withColumn("examples", F.array_join("examples", ","))


@query(_RESOLVED + "SELECT study_id, resolution, old_id FROM resolved WHERE resolution <> 'mapped'")
def unresolved_ids(spark: SparkSession, d: str) -> DataFrame:
    return A.unresolved_ids(resolved_patients(spark, d))


@query(_RUN + """, classes AS (SELECT place, c.study_id, source, CASE WHEN k = 5 THEN 'skipped_no_files' WHEN k = 2 THEN 'failed_no_source' WHEN k = 4 THEN 'failed_multi' WHEN source IS NULL THEN 'failed_other' WHEN coalesce(mapping_rows, 0) = 0 THEN 'skipped_needs_review' WHEN source = 'SSTR' THEN 'loaded_sstr' WHEN k = 1 THEN 'loaded_multi_sstr_malformed' ELSE 'loaded_multi' END AS class
  FROM chosen c LEFT JOIN per USING (study_id) UNION ALL SELECT place, study_id, NULL, 'reused' FROM reused)
SELECT source, class, count(*) AS n, string_agg(study_id, ',' ORDER BY place) AS study_ids FROM classes GROUP BY ALL""")
def migration_ids(spark: SparkSession, d: str) -> DataFrame:
    """The studies of each source and class of a migration: loaded, fallen back, reused, refused."""
    return A.ids_by_outcome(_migrated(spark, d)["outcomes"], ("source", "class"))
