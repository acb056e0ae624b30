"""Secret scans with linking of credential parts (operator 6).

Base kinds are found by their patterns alone. Weak kinds (a bare 40-character
key, a session identifier, a service address) mean nothing by themselves: each
is reported only if the parts that complete a credential are found within a scope
of the same text, measured between the nearest edges: parts that touch, overlap or
hold one another are near at any length. A text's parts are passed in order of
their starts, forwards and backwards, with the nearest part so far of each family, so
no parts are joined; a weak part is linked with the nearest of each family it needs. That is
what an interval join of parts, as the query's SQL has it, gives, without its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import cut, documents

#: Kinds in the order in which spans with equal starts are listed.
KINDS = ("assign", "access", "hex", "key", "session", "endpoint")
BASE = KINDS[:3]
#: Keyword letters in either case, spelled out so that every engine folds the same letters.
ASSIGN = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PATTERNS = {
    "assign": ASSIGN,
    "access": "(AKIA[A-Z0-9]{12,})",
    "hex": "([0-9a-f]{32,})",
    "key": "([A-Za-z0-9+/]{40,})",
    "session": "(ASIA[A-Z0-9]{12,})",
    "endpoint": "((?:https?|s3|ftp|postgres|mysql|mongodb|redis|amqp)://[^\\x00-\\x20\"'<>]+)",
}
#: What a part counts as when others look for a complement, and which families a weak kind needs near it.
FAMILY = {"assign": "secret", "hex": "secret", "key": "secret", "access": "id", "session": "id"}
NEEDS = {"key": ("id",), "session": ("secret",), "endpoint": ("id", "secret")}
SCOPE = 256


def may_hold(text: Column) -> dict[str, Column]:
    """For each kind a test that no text with a match fails: plain searches where the pattern has fixed letters, one run of letters for two kinds."""
    low = F.lower(text)  # folds all that the patterns fold, and more
    words = F.lit(False)
    for w in ("password", "passwd", "secret", "token", "api"):
        words |= low.contains(w)
    run = text.rlike("[A-Za-z0-9+/]{32}")
    return {"assign": (text.contains(":") | text.contains("=")) & words, "access": text.contains("AKIA"), "hex": run, "key": run, "session": text.contains("ASIA"), "endpoint": text.contains("://")}


def found(kind: str, text: Column, maybe: Column) -> Column:
    """The matches of one kind in order: ``kind, i, gap, len, ok`` (characters since the last match, and of it).

    Only texts that ``maybe`` lets through are taken apart by the pattern, into matches and what stands between them.
    """
    p = PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(p), F.lit(0))

    def value_length(m: Column) -> Column:
        # The first sign of assignment ends the keyword; blanks and quotes after it are no part of a value.
        return F.length(F.ltrim(F.regexp_replace(m, "^[^:=]*[:=]", ""), F.lit(" \"'")))

    ok = {"assign": lambda m: value_length(m) >= 8, "key": lambda m: (F.length(m) == 40) & ~m.rlike("^[0-9a-f]+$")}.get(kind, lambda m: F.lit(True))
    rows = F.transform(
        F.arrays_zip(F.sequence(F.lit(0), F.size(whole) - 1).alias("i"), F.split(text, p, -1).alias("g"), whole.alias("m")),
        lambda r: F.struct(F.lit(kind).alias("kind"), r["i"].alias("i"), F.length(r["g"]).alias("gap"), F.length(r["m"]).alias("len"), ok(r["m"]).alias("ok")),
    )
    kept = F.filter(rows, lambda r: r["i"].isNotNull() & r["len"].isNotNull())
    return F.when(maybe & text.rlike(p), kept).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,len:int,ok:boolean>>"))


def parts(scanned: DataFrame) -> DataFrame:
    """``row, kind, start, end`` (end exclusive) of every match that is ``ok``, from ``row, found``."""
    each = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(so_far))
    return each.where("ok").select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def kind_rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def entry(kind: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(":", kind, start, end)


def linked(all_parts: DataFrame, scope: int) -> DataFrame:
    """``row, kind, start, end, links`` of the weak parts that have a part of every family they need within ``scope`` characters.

    ``links``: the nearest of each of those families, as ``kind:start:end`` in the families' order. Of parts at one
    distance those that stand before come first, and of these the one that ends last.
    """
    family = F.element_at(F.create_map(*[F.lit(x) for kv in FAMILY.items() for x in kv]), F.col("kind"))
    rows = all_parts.withColumns({"family": family, "rank": kind_rank(F.col("kind"))})
    forwards = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    backwards = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("rank").desc()).rowsBetween(Window.unboundedPreceding, -1)
    families = sorted(set(FAMILY.values()))
    mine = {f: F.col("family") == f for f in families}
    rows = rows.withColumns({f"before_{f}": F.max(F.when(mine[f], F.struct("end", "start", "kind"))).over(forwards) for f in families})
    rows = rows.withColumns({f"after_{f}": F.min(F.when(mine[f], F.struct("start", "rank", "end", "kind"))).over(backwards) for f in families})
    near, link = {}, {}
    for f in families:
        before, after = F.col(f"before_{f}"), F.col(f"after_{f}")
        gaps = F.greatest(F.lit(0), F.col("start") - before["end"]), F.greatest(F.lit(0), after["start"] - F.col("end"))
        first = after.isNull() | (before.isNotNull() & (gaps[0] <= gaps[1]))
        near[f] = F.coalesce(F.least(F.when(before.isNotNull(), gaps[0]), F.when(after.isNotNull(), gaps[1])) <= scope, F.lit(False))
        link[f] = F.when(first, entry(before["kind"], before["start"], before["end"])).otherwise(entry(after["kind"], after["start"], after["end"]))
    whole, links = F.lit(False), F.lit(None).cast("string")
    for kind, needs in NEEDS.items():
        met = F.col("kind") == kind
        for f in needs:
            met &= near[f]
        whole |= met
        links = F.when(F.col("kind") == kind, F.concat_ws("+", *[link[f] for f in needs])).otherwise(links)
    return rows.where(whole).select("row", "kind", "start", "end", links.alias("links"))


SPAN = ("row", "kind", "start", "end", "links")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, keep: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows scanned (``row, doc_id, hit`` and ``kept``, what ``keep`` is for them) and their spans (``row, kind, start, end, links``).

    Offsets count code points of the whole text. A null or empty text has no spans. Rows with
    equal ids are scanned apart; null ids are kept; an empty table gives no rows. Columns but the two named
    are not read unless in ``keep``, so their names don't matter. ``hit``: whether any pattern was met.
    """
    text = F.col("_t")
    maybe = may_hold(text)
    both = F.concat(*[found(k, text, maybe[k]) for k in KINDS])
    kept = F.lit(None).cast("int") if keep is None else keep
    own = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), kept.alias("kept"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    rows = cut(own.select("row", "doc_id", "kept", both.alias("found")), "secret-rows")
    each = cut(parts(rows.where(F.size("found") > 0)), "secret-parts")
    spans = each.where(F.col("kind").isin(*BASE)).withColumn("links", F.lit(None).cast("string")).unionByName(linked(each, scope))
    return rows.select("row", "doc_id", "kept", (F.size("found") > 0).alias("hit")), spans


def listed(spans: DataFrame) -> DataFrame:
    """``row, n_assign, n_access, n_hex, base, spans, links``: counts, and spans and links as text, in order."""
    each = F.struct("start", kind_rank(F.col("kind")).alias("rank"), entry(F.col("kind"), F.col("start"), F.col("end")).alias("text"), "links")
    ordered = F.array_sort(F.collect_list(each))

    def joined(a: Column) -> Column:
        return F.array_join(a, ",")

    per = spans.groupBy("row").agg(ordered.alias("all"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE])
    base = F.filter("all", lambda s: s["rank"] <= len(BASE))
    links = F.filter("all", lambda s: s["links"].isNotNull())
    return per.select(
        "row", *[f"n_{k}" for k in BASE], joined(F.transform(base, lambda s: s["text"])).alias("base"), joined(F.transform("all", lambda s: s["text"])).alias("spans"),
        joined(F.transform(links, lambda s: F.concat(s["text"], F.lit("~"), s["links"]))).alias("links"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = scan(documents(spark, sf_dir))
    out = rows.join(listed(spans), "row", "left")
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        *[F.coalesce(F.col(f"n_{k}"), none).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("spans", "links")],
    )


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", scope: int = SCOPE) -> DataFrame:
    """``df`` with each stretch of text that spans cover replaced by ``<kind>`` of its first span, and the count of characters.

    Rows without spans are returned as they are, null and empty texts among them; repeated rows are redacted each by
    itself, whatever their ids; an empty table gives none. All columns of ``df`` pass through under their own names,
    in a struct of their own. Only rows that a pattern met are shuffled with their texts.
    """
    mine = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows, spans = scan(df, id_col, text_col, scope, mine)
    before = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # A span that begins before an earlier one ends is covered by it or carries it on.
    cover = spans.withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0).cast("long"))).where("end > seen")
    cover = cover.withColumn("joins", (F.col("start") < F.col("seen")) & (F.col("seen") > 0))
    per = cover.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "seen", "joins", "kind"))).alias("cover"), F.max("end").alias("last"))
    at = {c: f"kept.c{i}" for i, c in enumerate(df.columns)}
    text = F.col(at[text_col])
    pieces = F.transform("cover", lambda s: F.when(s["joins"], F.lit("")).otherwise(
        F.concat(text.substr((s["seen"] + 1).cast("int"), (s["start"] - s["seen"]).cast("int")), F.lit("<"), s["kind"], F.lit(">"))))
    clean = F.concat(F.array_join(pieces, ""), F.substring(text, (F.col("last") + 1).cast("int"), F.length(text)))
    new = F.when(F.col("cover").isNull(), text).otherwise(clean)
    plain = rows.where("not hit").select(*[F.col(at[c]).alias(c) for c in df.columns])
    out = rows.where("hit").join(per, "row", "left").withColumn("text", new)
    columns = {c: F.col(p) for c, p in at.items()} | {text_col: F.col("text")}
    if chars_col in df.columns:
        columns[chars_col] = F.when(F.col("cover").isNull(), F.col(at[chars_col])).otherwise(F.length("text").cast(df.schema[chars_col].dataType))
    return plain.unionByName(out.select(*[columns[c].alias(c) for c in df.columns]))


def _sql() -> str:
    def scan_of(kind: str) -> str:
        p = PATTERNS[kind].replace("'", "''")
        ok = {"assign": "length(v) >= 8", "key": "length(v) = 40 AND NOT regexp_full_match(v, '[0-9a-f]+')"}.get(kind, "true")
        return f"""
  SELECT doc_id, '{kind}' AS kind, (e - length(m))::BIGINT AS start, e::BIGINT AS "end" FROM (
    SELECT doc_id, m, v, sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
      SELECT doc_id, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[:len(ms)]) AS g FROM (
        SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS ms, regexp_extract_all(text, '{p}', 1) AS vs, string_split_regex(text, '{p}') AS gs
        FROM documents WHERE regexp_matches(text, '{p}')))) WHERE {ok}"""

    family = "CASE WHEN kind IN ('access', 'session') THEN 'id' WHEN kind <> 'endpoint' THEN 'secret' END"
    rank = f"list_position({list(KINDS)}, kind)"
    text = "kind || ':' || start || ':' || \"end\""
    needs = " UNION ALL ".join(f"SELECT '{k}' AS kind, '{f}' AS family, {i} AS nth, {len(v)} AS wanted" for k, v in NEEDS.items() for i, f in enumerate(v))
    return f"""
WITH parts AS ({" UNION ALL ".join(map(scan_of, KINDS))}),
fam AS (SELECT *, {family} AS family, {rank} AS rank FROM parts),
needs AS ({needs}),
near AS (
  SELECT p.doc_id, p.kind, p.start, p."end", nth, wanted, f.kind || ':' || f.start || ':' || f."end" AS link,
    row_number() OVER (PARTITION BY p.doc_id, p.kind, p.start, nth ORDER BY greatest(0, p.start - f."end", f.start - p."end"), (f.start, f.rank) > (p.start, p.rank),
      CASE WHEN (f.start, f.rank) < (p.start, p.rank) THEN -f."end" ELSE f.start END, CASE WHEN (f.start, f.rank) < (p.start, p.rank) THEN -f.start ELSE f.rank END) AS place
  FROM fam p JOIN needs USING (kind) JOIN fam f ON f.doc_id = p.doc_id AND f.family = needs.family AND f.start <= p."end" + {SCOPE} AND f."end" >= p.start - {SCOPE}),
weak AS (SELECT doc_id, kind, start, "end", string_agg(link, '+' ORDER BY nth) AS links FROM near WHERE place = 1 GROUP BY doc_id, kind, start, "end", wanted HAVING count(*) = wanted),
spans AS (SELECT doc_id, kind, start, "end", NULL AS links FROM parts WHERE kind IN {BASE} UNION ALL SELECT * FROM weak),
per AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
    string_agg({text}, ',' ORDER BY start, {rank}) FILTER (kind IN {BASE}) AS base, string_agg({text}, ',' ORDER BY start, {rank}) AS spans,
    string_agg({text} || '~' || links, ',' ORDER BY start, {rank}) FILTER (links IS NOT NULL) AS links
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(links, '') AS links
FROM documents d LEFT JOIN per USING (doc_id)
"""


SQL = _sql()
