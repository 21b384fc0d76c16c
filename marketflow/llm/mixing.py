"""Mixing sources to target weights by weighted fair queueing.

Sources in code point order, null last, weigh 5, 2, 1 and so on again, and share the total of all sizes. A target
stops at `most` times its source's size; what is left over is shared again by weight until no target is above.
Every source offers its documents in a shuffled order (by the md5 of doc_id), as often as `most` allows. A document's
virtual finish time is the running total of its source's words divided by the source's target. All offers, sorted by
finish time, are taken until the total budget is spent; the last one may be cut.

No window holds a whole source: running totals are taken per (source, slice of the md5) over the totals of earlier
slices, and the global order per bin of finish time over the totals of earlier bins; only the bin in which the budget
ends is sorted by rows.

Null texts have size 0. Documents of size 0 take nothing. Repeated rows are documents of their own. An empty table
gives no rows. Size: words [^\\x20\\x09-\\x0D]+.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import stored

WEIGHTS = (5, 2, 1)
MOST = 3
BINS = 16384
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(skey, source_size, target) of each source from rows (skey, source_size); one row per source in one task."""
    everything = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(everything.orderBy("skey")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")).cast("long")
    sources = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    filling = everything.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(filling), F.lit(0))
    shares = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    sources = sources.withColumns({"left": left, "shares": shares})
    full = F.col("cap") * F.col("shares") <= F.col("weight") * F.col("left")
    sources = sources.withColumn("full", full)
    # The sources that are not full share what the full ones leave; the first of them holds both numbers.
    first = F.max(F.when(~F.col("full"), F.struct("shares", (-F.col("left")).alias("minus")))).over(all_rows)
    share = (F.col("weight") * -first["minus"]).cast("double") / first["shares"].cast("double")
    return sources.select(
        "skey", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, bins: int = BINS) -> DataFrame:
    """(doc_id, row_key, size, source_size, target, taken) for each row of `docs`.

    row_key is a hash of doc_id, source and text that joins the result back to its rows.
    """
    skey = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    rows = stored(docs.select(
        "doc_id", skey.alias("skey"), F.xxhash64("doc_id", "source", "text").alias("row_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn"),
    ))
    rows = rows.withColumn("slice", F.substring("turn", 1, 3))
    slices = rows.groupBy("skey", "slice").agg(F.sum("size").alias("words"))
    goals = targets(slices.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, most)
    earlier = Window.partitionBy("skey").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("skey", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    placed = rows.join(slices.join(goals, "skey"), ["skey", "slice"])
    inside = Window.partitionBy("skey", "slice").orderBy("turn", "doc_id", "size", "row_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = stored(placed.select(
        "doc_id", "row_key", "skey", "turn", "size", "source_size", "target",
        (F.col("before") + F.sum("size").over(inside)).alias("finish"),
    ))
    offers = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("copy"))
    offers = offers.withColumn("time", _time(F.col("copy"))).where("size > 0 AND target > 0")
    offers = offers.withColumn("bin", F.least(F.floor(F.col("time") * bins), F.lit(2 * bins)).cast("int"))
    upto = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    per_bin = offers.groupBy("bin").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cut = per_bin.where(F.col("upto") >= budget).orderBy("bin").first()
    end = None
    if cut is not None:
        order = Window.partitionBy("bin").orderBy("time", "skey", "turn", "finish").rowsBetween(Window.unboundedPreceding, 0)
        edge = offers.where(F.col("bin") == cut.bin).withColumn("upto", F.sum("size").over(order) + (cut.upto - cut.words))
        end = edge.where(F.col("upto") >= budget).orderBy("upto").first()
    taken = F.lit(0).cast("long")
    for copy in range(most):
        here = F.struct(_time(F.lit(copy)).alias("time"), "skey", "turn", "finish")
        got = F.col("size")
        if end is not None:
            there = F.struct(F.lit(end.time), F.lit(end.skey), F.lit(end.turn), F.lit(end.finish).cast("long"))
            part = F.lit(end.size - (end.upto - budget)).cast("long")
            got = F.when(here < there, F.col("size")).when(here == there, part).otherwise(0)
        taken = taken + F.when((F.col("size") > 0) & (F.col("target") > 0), got).otherwise(0)
    return placed.select("doc_id", "row_key", "size", "source_size", "target", taken.alias("taken"))


def _time(copy):
    """Virtual finish time of a copy of a row, null without a target."""
    words = F.col("finish") + copy * F.col("source_size")
    return words.cast("double") / F.when(F.col("target") > 0, F.col("target"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents that the mix takes, with `taken` words each; of repeated rows one stays, with all they take."""
    if "taken" in docs.columns:
        docs = docs.drop("taken")
    takes = mix(docs, weights, most).groupBy("doc_id", "row_key").agg(F.sum("taken").alias("taken")).where("taken > 0")
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "source", "text")).dropDuplicates(["doc_id", "__key"]).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.__key") == F.col("t.row_key"))
    return keyed.join(takes.alias("t"), same).select(*[F.col(f"d.`{c}`") for c in docs.columns], "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents
), s AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey
), w AS (
  SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS INTEGER)] AS BIGINT) AS weight,
         3 * source_size AS cap
  FROM s
), f AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS BIGINT) AS room,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS BIGINT) AS shares
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), skey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT *, cap * shares <= weight * room AS is_full,
         max(CASE WHEN NOT cap * shares <= weight * room THEN shares END) OVER () AS open_shares
  FROM f
), t AS (
  SELECT skey, source_size,
         CASE WHEN is_full THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * (SELECT min(room) FROM g WHERE NOT is_full AND shares = open_shares) AS DOUBLE)
                   / CAST(open_shares AS DOUBLE) END AS target
  FROM g
), p AS (
  SELECT d.*, source_size, target,
         CAST(sum(size) OVER (PARTITION BY skey ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS finish
  FROM d JOIN t USING (skey)
), o AS (
  SELECT *, CAST(finish + copy * source_size AS DOUBLE) / target AS due
  FROM p, (SELECT unnest([0, 1, 2]) AS copy) WHERE size > 0 AND target > 0
), c AS (
  SELECT *, sum(size) OVER (ORDER BY due, skey, turn, finish ROWS UNBOUNDED PRECEDING) - size AS before FROM o
), k AS (
  SELECT skey, turn, finish,
         CAST(sum(greatest(0, least(size, (SELECT sum(size) FROM d) - before))) AS BIGINT) AS taken
  FROM c GROUP BY skey, turn, finish
)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(k.taken, 0) AS taken
FROM p LEFT JOIN k ON p.skey = k.skey AND p.turn = k.turn AND p.finish = k.finish AND p.size > 0
"""
