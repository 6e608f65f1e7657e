"""Mixing sources to target weights by weighted fair queueing.

Every source has a queue of its documents in a shuffled order that depends on the document id alone; after its last
document a queue starts again, up to ``MAX_REPEATS`` times in all. A copy in a queue gets a virtual finish time: the
words of its source up to and with it, divided by the source's target. All copies are sorted by that time over all
sources with a range sort and the order is cut where the budget of words is used up, to the nearest whole copy.

A source is summed in parts: documents are dealt to (source, hash range) groups of a bounded size, each group is
summed by itself and shifted by the sums before it, so a source with a third of all rows is no single task. Only
narrow rows are moved, never the text.

Defined cases: documents without words are never taken (taken 0) and change nothing; null sources are one source that
comes last in code point order; rows equal in id, source and size may swap places, which changes no result; an empty
table gives an empty mix; the input may have further columns of any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import sums_before, word_count
from shelfwise.operators.joins import attach
from shelfwise.operators.materialise import settle

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1:"
# Documents of one source that are summed in one group, about.
GROUP_ROWS = 4_000


def _sources(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """source, source_size, source_rows, rank (0, 1, .. in code point order, null last) and weight."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    ranked = sums_before(sums.withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1).cast("long")),
                         ["last", "source"], "one", "rank")
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    return settle(ranked.withColumn("weight", weight).drop("last", "one"), "sources").frame


def share_out(sources: DataFrame, budget: float, repeats: int) -> DataFrame:
    """Add ``target``: the budget by weight, none above ``repeats`` times its source, the excess reshared by weight.

    The targets are min(cap, rate * weight); the rate is raised until the set of capped sources stays the same. Each
    step is one aggregation to one row.
    """
    cap = F.col("source_size") * F.lit(repeats)
    rate, capped_before = 0.0, -1
    first = sources.agg(F.sum("weight").alias("w")).first()["w"]
    if first:
        rate = budget / first
        while True:
            full = F.lit(rate) * F.col("weight") > cap
            line = sources.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("used"),
                               F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("w")).first()
            if line["n"] == capped_before or line["w"] == 0:
                break
            rate, capped_before = (budget - line["used"]) / line["w"], line["n"]
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(rate) * F.col("weight")))


def queues(rows: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS,
           budget_share: float = 1.0) -> DataFrame:
    """``rows`` (doc_id, source, size, ..) with source_size, target, rank and ``upto``, the words of the source's
    queue up to and with the document in its first round (null for documents without words)."""
    sources = _sources(rows, weights)
    totals = sources.agg(F.sum("source_size").alias("words"), F.max("source_rows").alias("most")).first()
    groups = max(1, -(-(totals["most"] or 0) // GROUP_ROWS))
    shared = settle(share_out(sources, (totals["words"] or 0) * budget_share, repeats), "targets")
    facts = shared.frame.select(F.col("source").alias("of"), "source_size", "target", "rank")
    wide = attach(rows, facts, {"source": "of"})
    shuffled = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    spread = F.conv(F.substring(shuffled, 1, 8), 16, 10).cast("long")
    dealt = wide.withColumn("turn", shuffled).withColumn(
        "part", F.floor(spread * groups / F.lit(1 << 32)).cast("long"))
    sums = dealt.groupBy("rank", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(F.col("rank").alias("rank_"), F.col("part").alias("part_"),
                         F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("rank", "part").orderBy("turn", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    summed = dealt.withColumn("within", F.sum("size").over(inside))
    joined = summed.join(shifts, (F.col("rank") == F.col("rank_")) & (F.col("part") == F.col("part_")))
    return joined.withColumn("upto", F.when(F.col("size") > 0, F.col("shift") + F.col("within"))).drop(
        "rank_", "part_", "shift", "within", "turn", "part")


def finish_time(upto: Column, round_no: Column) -> Column:
    """Virtual finish time of a copy; the target is reached at 1."""
    return (round_no * F.col("source_size") + upto).cast("double") / F.col("target")


def cut(queued: DataFrame, repeats: int = MAX_REPEATS, budget_share: float = 1.0) -> DataFrame:
    """``queued`` with ``copies``, how often the mix takes the document, and ``taken``, the words of those copies."""
    budget = (queued.agg(F.sum("size").alias("n")).first()["n"] or 0) * budget_share
    copies = (
        queued.filter(F.col("upto").isNotNull() & (F.col("target") > 0))
        .select("rank", "size", "upto", "source_size", "target",
                F.explode(F.array(*[F.lit(r).cast("long") for r in range(repeats)])).alias("round_no"))
        .select("rank", "size", "upto", "round_no", finish_time(F.col("upto"), F.col("round_no")).alias("finish")))
    order = ["finish", "rank", "round_no", "upto"]
    lined = sums_before(copies, order, "size", "before")
    last = lined.filter(2 * F.col("before") + F.col("size") <= 2 * budget).orderBy(
        *[F.desc(c) for c in order]).select(*order).limit(1).collect()
    if not last:
        return queued.withColumn("copies", F.lit(0).cast("long")).withColumn("taken", F.lit(0).cast("long"))
    end = F.struct(*[F.lit(last[0][c]).alias(c) for c in order])

    def inside(round_no: int) -> Column:
        r = F.lit(round_no).cast("long")
        key = F.struct(finish_time(F.col("upto"), r).alias("finish"), F.col("rank").alias("rank"),
                       r.alias("round_no"), F.col("upto").alias("upto"))
        kept = F.col("upto").isNotNull() & (F.col("target") > 0)
        return F.when(kept, F.when(key <= end, 1).otherwise(0)).otherwise(0).cast("long")

    counted = queued.withColumn("copies", sum((inside(r) for r in range(1, repeats)), inside(0)))
    return counted.withColumn("taken", F.col("copies") * F.col("size"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS,
         budget_share: float = 1.0) -> DataFrame:
    """doc_id, source, size, hash (of the text), source_size, target, copies and taken of every document."""
    rows = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              F.xxhash64("text").alias("hash")), "mix-rows").frame
    queued = settle(queues(rows, weights, repeats, budget_share), "queues").frame
    return cut(queued, repeats, budget_share)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS,
        budget_share: float = 1.0) -> DataFrame:
    """The documents of the mix, with their own columns; a document taken twice is there twice."""
    keys = ["doc_id", "source", "hash"]
    taken = plan(docs, weights, repeats, budget_share).filter("copies > 0").select(*keys, "copies")
    # Rows that agree in id, source and text are numbered on both sides, so each meets one plan row.
    alike = Window.partitionBy("__id", "__source", "__hash").orderBy("__source")
    right = taken.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                         F.col("hash").alias("__hash"), F.col("copies").alias("__copies"))
    right = right.withColumn("__no", F.row_number().over(alike)).select(
        *[F.col(c).alias(c + "r") for c in right.columns], F.col("__no").alias("__nor"))
    left = docs.select("*", F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                       F.xxhash64("text").alias("__hash")).withColumn("__no", F.row_number().over(alike))
    match = [F.col(c).eqNullSafe(F.col(c + "r")) for c in ("__id", "__source", "__hash", "__no")]
    joined = left.join(right, match[0] & match[1] & match[2] & match[3])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copiesr")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
