"""Counts, profiles, tallies, fingerprints and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.cells import is_null_word, is_number, trimmed

SEVERITY = {"ERROR": 3, "WARNING": 2, "INFO": 1}


def examples(value: str, order: str, n: int) -> Column:
    """The first n values in order. Rows beyond n are kept out of the result, not out of the counts."""
    return F.transform(F.slice(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), 1, n), lambda x: x["v"])


def first_examples(df: DataFrame, keys: list[str], value: str, order: str, n: int) -> DataFrame:
    """``keys, count, examples`` (the first n in order) without gathering a group: ranks are cut off by a window first."""
    from pyspark.sql.window import Window

    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    few = ranked.where(F.col("_n") <= n).groupBy(*keys).agg(examples(value, "_n", n).alias("examples"))
    return df.groupBy(*keys).agg(F.count("*").alias("count")).join(few, keys)


def issue_tally(issues: DataFrame, keys: list[str], example: str, order: str) -> DataFrame:
    """``keys, code, severity, count, examples``: consent 0 is information, all else a warning."""
    per = first_examples(issues, [*keys, "code"], example, order, 10)
    return per.withColumn("severity", F.when(F.col("code") == "CONSENT_ZERO", "INFO").otherwise("WARNING"))


def rows_per_consent(rows: DataFrame) -> DataFrame:
    return rows.groupBy("study_id", "consent_code").agg(F.count("*").alias("rows"))


def people_per_consent(rows: DataFrame) -> DataFrame:
    return rows.groupBy("study_id", "consent_code").agg(F.count_distinct("person_id").alias("participants"))


def column_profile(cells: DataFrame, field: str = "field", value: str = "value") -> DataFrame:
    """``field, n_values, n_text, observed``: cells that are not empty, those that are no numbers, and the type they make.

    ``observed`` is null for a field without values.
    """
    cells = cells.select(field, trimmed(F.col(value)).alias(value))
    v = F.col(value)
    there = F.coalesce((v != "") & ~is_null_word(v), F.lit(False))
    per = cells.groupBy(field).agg(F.count_if(there).alias("n_values"), F.count_if(there & ~is_number(v)).alias("n_text"))
    return per.withColumn("observed", F.when(F.col("n_values") == 0, F.lit(None)).when(F.col("n_text") > 0, "TEXT").otherwise("NUMERIC"))


def wide_profile(wide: DataFrame, fields: list[str]) -> DataFrame:
    """``column_profile`` of columns side by side: one aggregate of counts for each, without a row for each cell."""
    counts = []
    for i, f in enumerate(fields):
        v = trimmed(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")))
        there = F.coalesce((v != "") & ~is_null_word(v), F.lit(False))
        counts += [F.count_if(there).alias(f"v{i}"), F.count_if(there & ~is_number(v)).alias(f"t{i}")]
    if not counts:
        return wide.sparkSession.createDataFrame([], "field string, n_values long, n_text long, observed string")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"v{i}").alias("n_values"), F.col(f"t{i}").alias("n_text")) for i, f in enumerate(fields)])
    observed = F.when(F.col("n_values") == 0, F.lit(None)).when(F.col("n_text") > 0, "TEXT").otherwise("NUMERIC")
    return wide.agg(*counts).select(F.inline(each)).withColumn("observed", observed)


def profiled_mapping(mapping: DataFrame, profile: DataFrame) -> DataFrame:
    """The mapping with observed types; fields of no values go, and fields that were not seen keep their type."""
    rows = mapping.join(profile, "field", "left")
    return rows.where("n_values is null or n_values > 0").select(*mapping.columns, F.coalesce("observed", "declared").alias("type"))


def consent_groups(sstr: DataFrame) -> DataFrame:
    """Subjects by consent of their first row: ``study_id, consent, participants``."""
    first = sstr.groupBy("study_id", "subject_id").agg(F.min_by("consent", "ord").alias("consent"))
    return first.groupBy("study_id", "consent").agg(F.count("*").alias("participants"))


def cross_consent(ids: DataFrame) -> DataFrame:
    return ids.groupBy("study_id", "identity").agg(F.count_distinct("consent_code").alias("consents")).where("consents > 1")


def duplicates_in_group(ids: DataFrame, keys: list[str], value: str) -> DataFrame:
    return ids.groupBy(*keys).agg((F.count(value) - F.count_distinct(value)).alias("duplicates"))


def ordered_lists(df: DataFrame, keys: list[str], order: list[str], fields: dict[str, str], distinct: bool = False) -> DataFrame:
    """Aligned comma lists of columns in one order. One row of a group's ids: what the format asks for."""
    entry = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c).cast("string").alias(n) for n, c in fields.items()])
    per = df.groupBy(*keys).agg(F.array_sort(F.collect_set(entry) if distinct else F.collect_list(entry)).alias("_l"))
    return per.select(*keys, *[F.array_join(F.col(f"_l.{n}"), ",").alias(n) for n in fields])


def fingerprint(files: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, fingerprint, sources, bytes``: SHA-256 of a folder's sources, a line of name, tab and version for each, in name order.

    A folder may have any number of files: its sorted lines pass through one digest, nothing is gathered.
    """
    from cohortflow.sources.streams import sha256_of_lines

    lines = files.withColumn("_line", F.concat("name", F.lit("\t"), "version_id", F.lit("\n")))
    sizes = files.groupBy(*keys).agg(F.count("*").alias("sources"), F.sum("size").alias("bytes"))
    return sha256_of_lines(lines, keys, "_line", "name").join(sizes, keys)


def content_digest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A digest of a group's rows whatever their order: their count and the sum of their hashes.

    For groups of any size; ``file_md5`` is for the bytes of files. Null cells count as empty.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.md5(F.concat_ws(":", F.count("*"), F.sum(h))).alias("digest"))


def key_profile(df: DataFrame, key: str) -> DataFrame:
    k = trimmed(F.coalesce(F.col(key), F.lit("")))
    return df.agg(F.count("*").alias("rows"), F.count_distinct(F.when(k != "", k)).alias("distinct_keys"), F.count_if(k == "").alias("blank_keys"))


def mapping_checks(mapping: DataFrame) -> DataFrame:
    """Per study: rows, new ids that are no whole numbers, old ids that repeat (and five of them), and blank fields."""
    repeats = mapping.groupBy("study_id", "old_id").agg(F.count("*").alias("n")).where("n > 1")
    per = first_examples(repeats, ["study_id"], "old_id", "old_id", 5).withColumnsRenamed({"count": "repeated_old_ids", "examples": "repeated_examples"})
    blank = (F.coalesce(trimmed(F.col("old_id")), F.lit("")) == "") | (F.coalesce(trimmed(F.col("new_id")), F.lit("")) == "")
    base = mapping.groupBy("study_id").agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(F.col("new_id"), F.lit("")).rlike("^\\d+$")).alias("bad_new_ids"), F.count_if(blank).alias("blank_fields"))
    return base.join(per, "study_id", "left").withColumn("repeated_old_ids", F.coalesce("repeated_old_ids", F.lit(0).cast("long")))


def severity_rank(severity: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv]), severity), F.lit(0))


def severity_counts(issues: DataFrame, keys: list[str]) -> DataFrame:
    return issues.groupBy(*keys).agg(*[F.count_if(F.col("severity") == s).alias(s.lower() + "s") for s in SEVERITY])


def worst(df: DataFrame, keys: list[str], status: str, order: list[str]) -> DataFrame:
    """Each key's status that comes first in ``order``."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(status))
    return df.groupBy(*keys).agg(F.min_by(status, rank).alias(status))


def action_counts(folders: DataFrame) -> DataFrame:
    merged = F.col("action").isin("MISSING", "NO_FINGERPRINT", "SOURCES_CHANGED")
    return folders.groupBy("action").agg(F.count("*").alias("folders"), F.sum(F.when(merged, F.col("sources")).otherwise(0)).cast("long").alias("files_merged"))


def repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("times")).where("times > 1")


def ids_by_outcome(results: DataFrame, by: tuple[str, ...] = ("outcome",)) -> DataFrame:
    """``by, n, study_ids``: the studies of each outcome, or of each source and class, in input order."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("ord", "study_id"))), lambda x: x["study_id"])
    return results.groupBy(*by).agg(F.count("*").alias("n"), F.array_join(ids, ",").alias("study_ids"))


def unresolved(resolved: DataFrame) -> DataFrame:
    """Per study and class: how many mapping rows did not resolve, and ten of their old ids."""
    return first_examples(resolved.where("resolution <> 'mapped'"), ["study_id", "resolution"], "old_id", "old_id", 10)


def unresolved_ids(resolved: DataFrame) -> DataFrame:
    """``study_id, resolution, old_id`` of every mapping row that did not resolve, for a table of any size; ``unresolved`` has ten of each."""
    return resolved.where("resolution <> 'mapped'").select("study_id", "resolution", "old_id")


def unmapped_examples(rows: DataFrame, id_mapping: DataFrame, n: int = 10) -> DataFrame:
    """How many ids of legacy rows the mapping lacks, and the first ``n`` of them: one row, none if it has all."""
    lost = rows.select("old_id").distinct().join(id_mapping.select("old_id"), "old_id", "left_anti").withColumn("_all", F.lit(1))
    return first_examples(lost, ["_all"], "old_id", "old_id", n).select(F.col("count").alias("ids"), "examples")


def table_counts(**tables: DataFrame) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
