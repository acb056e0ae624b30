"""Mixing sources to target weights (operator 3).

Each source's rows are put in a shuffled order and laid end to end as a stream
of words, which is cut into blocks of equal length. The schedule is a row of
2^m slots: slot k maps through the van der Corput point of k (its bits reversed)
into the cumulative weights of the sources, which are whole numbers of cells, so
every source gets exactly as many slots as it has blocks to give, evenly spread.
A slot's rank within its source says which block it takes; a source whose target
is above its size is read again from the start. Slots and blocks are joined on
(source, rank), which yields the pieces of rows that the mix takes, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import cut, documents, running_total

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: A block is a 65,536th of all words, but this long at most.
SLOTS, LONGEST_BLOCK = 65_536, 65_536
WORD = "[^\\x20\\x09-\\x0D]+"
#: Cells of the schedule that one row of the first step stands for.
RUN = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, idx, source_size, w, target`` from rows with ``source`` and ``size``.

    Sources in code point order, null last, weigh as in ``weights``, repeating. All
    words are shared by weight; a target stops at ``max_repeats`` times its source's
    size and the rest is shared again. Sorted by size per weight, a source is above its
    limit exactly if its share is, once those before it are taken out. One narrow row for each
    source, not more, passes through single-task windows here and in ``schedule``.
    """
    idx = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = by_source.withColumn("idx", idx.cast("long"))
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), ((F.col("idx") - 1) % len(weights) + 1).cast("int")))
    rise = Window.orderBy((F.col("source_size") / F.col("w")).asc(), "idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    cap = F.col("source_size") * max_repeats
    s = s.withColumns({"cap": cap, "c": F.sum(cap).over(rise) - cap, "wc": F.sum("w").over(rise) - F.col("w")})
    s = s.withColumns({"t": F.sum("source_size").over(everything), "ws": F.sum("w").over(everything)})
    s = s.withColumn("capped", (F.col("t") - F.col("c")) * F.col("w") > F.col("cap") * (F.col("ws") - F.col("wc")))
    s = s.withColumns({
        "c_all": F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything),
        "w_all": F.sum(F.when(F.col("capped"), F.col("w")).otherwise(0)).over(everything),
    })
    shared = (F.col("w") * (F.col("t") - F.col("c_all"))).cast("double") / (F.col("ws") - F.col("w_all")).cast("double")
    return s.select("source", "idx", "source_size", "w", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """``slot, idx, rank``: which block of which source each slot takes.

    Source cells lie end to end on [0, N); with 2^m >= N, cell j is the point of slot
    reverse(j), so the slots of a source are spread as the van der Corput points are.
    """
    cells = F.ceil(F.floor("target") / block).cast("long")
    n = targets.withColumn("cells", cells)
    n = n.withColumns({"first": F.sum("cells").over(Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cells"), "n": F.sum("cells").over(Window.partitionBy())})
    n = n.withColumn("m", F.length(F.bin(F.greatest(F.col("n") - 1, F.lit(1)))))
    runs = n.where("cells > 0").select("idx", "first", "cells", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("cells") - 1) / RUN))).alias("run"))
    runs = runs.repartition("idx", "run")
    j = runs.select("idx", "m", F.explode(F.sequence(F.col("first") + F.col("run") * RUN, F.col("first") + F.least(F.col("cells"), (F.col("run") + 1) * RUN) - 1)).alias("j"))
    slot = F.conv(F.reverse(F.expr("lpad(bin(j), m, '0')")), 2, 10).cast("long")
    slots = j.select("idx", slot.alias("slot"), F.expr("shiftright(0L + " + "conv(reverse(lpad(bin(j), m, '0')), 2, 10), greatest(m - 12, 0))").alias("_part"), F.lit(1).cast("long").alias("_one"))
    return running_total(slots, ["idx"], "_part", [F.col("slot")], "_one", "rank").select("slot", "idx", "rank")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows with their targets, and the pieces that the mix takes of them.

    Rows: ``row, doc_id, size, source_size, target, kept``, one for each row of ``df`` (``kept``: what ``keep`` is for
    it). Pieces: ``row, slot, epoch, start, length`` (words from ``start`` of the row's text, in slot order).
    Every source's pieces add up to its target, rounded down; none is taken more than three times.
    A null text has size 0, as an empty one, and is never taken; null is a source of its own, the
    last; rows with equal ids stay apart, ordered by (md5 of id and text, id, size); an empty table gives no rows.
    Columns but the three named are not read unless in ``keep``, so their names don't matter.
    """
    words = F.coalesce(F.size(F.regexp_extract_all(F.col("_t"), F.lit(f"({WORD})"), F.lit(1))), F.lit(0))
    own = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("_t"),
        (F.lit(None).cast("int") if keep is None else keep).alias("kept"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("_t", F.lit("")))))
    rows = cut(own.select("row", "doc_id", "source", F.when(F.col("_t").isNull(), 0).otherwise(words).cast("long").alias("size"), key.alias("_h"), "kept"), "mix-rows")
    targets = cut(source_targets(rows), "mix-targets")
    block = block_of(targets)

    named = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).select("row", "doc_id", "size", "idx", "source_size", "target", "_h", "kept")
    placed = named.drop("kept").where("size > 0").withColumn("_part", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    order = [F.col("_h"), F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("row")]
    placed = cut(running_total(placed, ["idx"], "_part", order, "size", "at").drop("_h", "_part"), "mix-placed")

    turn = placed.withColumn("_end", F.floor("target").cast("long"))
    turn = turn.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_end") / F.col("source_size")))).alias("epoch"))
    turn = turn.withColumns({"_from": F.col("at") + F.col("epoch") * F.col("source_size")})
    turn = turn.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("_end"))).where("_from < _to")
    parts = turn.select("row", "idx", "epoch", "_from", "_to", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))).alias("rank"))
    taken = parts.join(schedule(targets, block), ["idx", "rank"])
    start = F.greatest(F.col("_from"), F.col("rank") * block)
    pieces = taken.select("row", "slot", "epoch", (start - F.col("_from")).alias("start"), (F.least(F.col("_to"), (F.col("rank") + 1) * block) - start).alias("length"))
    return named.select("row", "doc_id", "size", "source_size", "target", "kept"), pieces


def block_of(targets: DataFrame) -> int:
    """The words of a block."""
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).head()[0]
    return max(1, min(LONGEST_BLOCK, total // SLOTS))


def remix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df``, each as many times as the mix takes at least half of its words: 0 to 3, in the order of the schedule.

    A copy stands where the first slot that reads it does, so that files written of the result are mixed as they are read.
    Null, empty and blank texts hold no words, so none is taken. Repeated rows count one by one; an empty table gives
    no rows. All columns of ``df`` pass through under their own names, in a struct of their own.
    """
    mine = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows, pieces = mix(df, id_col, text_col, source_col, mine)
    turns = pieces.groupBy("row", "epoch").agg(F.sum("length").alias("length"), F.min("slot").alias("slot"))
    taken = turns.groupBy("row").agg(F.sum("length").alias("taken"), F.sort_array(F.collect_list("slot")).alias("slots"))
    copies = F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int")
    wanted = rows.select("row", "size").join(taken, "row").select("row", F.explode(F.slice("slots", F.lit(1), copies)).alias("slot"))
    wanted = cut(wanted, "mix-copies")
    slots = (wanted.agg(F.max("slot")).head()[0] or 0) + 1
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = rows.select("row", "kept").join(wanted, "row")
    # Slots are equal blocks, so equal ranges of them are equal parts.
    dealt = both.repartitionById(parts, F.floor(F.col("slot") * parts / slots).cast("int")).sortWithinPartitions("slot", "row")
    return dealt.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(df.columns)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, pieces = mix(documents(spark, sf_dir))
    taken = pieces.groupBy("row").agg(F.sum("length").alias("taken"), F.min("slot").alias("first_slot"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_slot")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS h FROM documents),
by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS idx FROM sized GROUP BY source),
weighed AS (SELECT *, ([5, 2, 1])[(idx - 1) % 3 + 1]::BIGINT AS w, source_size * 3 AS cap FROM by_source),
risen AS (
  SELECT *, (sum(cap) OVER r - cap)::BIGINT AS c, (sum(w) OVER r - w)::BIGINT AS wc, (sum(source_size) OVER ())::BIGINT AS t, (sum(w) OVER ())::BIGINT AS ws
  FROM weighed WINDOW r AS (ORDER BY source_size / w, idx ROWS UNBOUNDED PRECEDING)),
flagged AS (SELECT *, (t - c) * w > cap * (ws - wc) AS capped FROM risen),
totals AS (SELECT *, coalesce(sum(cap) FILTER (capped) OVER (), 0)::BIGINT AS c_all, coalesce(sum(w) FILTER (capped) OVER (), 0)::BIGINT AS w_all FROM flagged),
targets AS (
  SELECT source, idx, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (w * (t - c_all))::DOUBLE / (ws - w_all)::DOUBLE END AS target,
    greatest(1, least({LONGEST_BLOCK}, t // {SLOTS})) AS block FROM totals),
ends AS (SELECT *, ceil(floor(target) / block)::BIGINT AS cells, sum(ceil(floor(target) / block)::BIGINT) OVER (ORDER BY idx)::BIGINT AS last, sum(ceil(floor(target) / block)::BIGINT) OVER ()::BIGINT AS n FROM targets),
slots AS (
  SELECT idx, slot, row_number() OVER (PARTITION BY idx ORDER BY slot) - 1 AS rank
  FROM (SELECT idx, list_sum(list_transform(range(0, m), lambda i: ((j >> i) & 1) << (m - 1 - i)))::BIGINT AS slot
    FROM (SELECT idx, length(bin(greatest(n - 1, 1))) AS m, unnest(range(last - cells, last)) AS j FROM ends))),
placed AS (
  SELECT doc_id, size, idx, source_size, target, block, floor(target)::BIGINT AS full_words,
    (sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS begins
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (full_words // source_size) * size + greatest(0, least(begins + size, full_words % source_size) - begins) END::BIGINT AS taken,
  CASE WHEN size > 0 AND begins < full_words THEN slot END AS first_slot
FROM placed LEFT JOIN slots ON slots.idx = placed.idx AND slots.rank = begins // block
"""
