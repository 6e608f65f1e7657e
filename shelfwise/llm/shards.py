"""Sharding along a Hilbert curve over quantised metadata.

Source, language and length are each quantised to 32 steps; documents are sorted by the index of their cell on the
three-dimensional Hilbert curve and the order is cut into runs of equal row counts (law ``rows``: counts differ by
one at most). Documents close on the curve are close in every dimension, so a filter on any of them prunes shards.

Source and language are quantised by their share of the rows in code point order, so a source with a third of the
rows takes its own steps and the order of values is kept; the length by its binary logarithm. Within a cell rows are
ordered by their values and then by a hash of the text. Equal texts stay together: all rows of a group lie where its
smallest row does (by curve, source, language), so a group is cut only where a run ends within it or it is longer than
a run.

Defined cases: null texts have no bytes (length 0, checksum of nothing); null sources and languages come last; rows
that are equal in all columns used may swap places, which changes no result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import let, sums_before
from shelfwise.operators.joins import attach
from shelfwise.operators.materialise import settle

BITS = 5
ROW_OVERHEAD = 8


def hilbert_index(axes: Sequence[Column], bits: int = BITS) -> Column:
    """The place of a cell on the Hilbert curve; each axis is a long in [0, 2^bits).

    The axes are turned into the transposed index bit plane by bit plane (highest first), Gray-coded, and the planes
    are interleaved. All loops run as array functions on a small state, so the expression stays small.
    """
    n = len(axes)
    one = F.lit(1).cast("long")

    def turn(x: Column, plane: Column) -> Column:
        """Undo the rotation of one bit plane, axis after axis."""
        low = plane - one

        def axis(v: Column, i: Column) -> Column:
            first, own = F.get(v, F.lit(0)), F.get(v, i)
            swap = first.bitwiseXOR(own).bitwiseAND(low)
            inverted = F.transform(v, lambda e, j: F.when(j == 0, e.bitwiseXOR(low)).otherwise(e))
            swapped = F.transform(v, lambda e, j: F.when(i == 0, e).when((j == 0) | (j == i), e.bitwiseXOR(swap))
                                  .otherwise(e))
            return F.when(own.bitwiseAND(plane) != 0, inverted).otherwise(swapped)

        return F.aggregate(F.array(*[F.lit(i) for i in range(n)]), x, axis)

    planes = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)])
    turned = F.aggregate(planes, F.array(*[a.cast("long") for a in axes]), turn)

    def gray(v: Column) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(v, F.array().cast("array<long>"), lambda acc, e: F.concat(acc, F.array(
            e.bitwiseXOR(F.coalesce(F.get(acc, F.size(acc) - 1), zero)))))

    def finish(v: Column) -> Column:
        last = F.get(v, F.lit(n - 1))
        flip = F.aggregate(planes, F.lit(0).cast("long"), lambda acc, q: F.when(
            last.bitwiseAND(q) != 0, acc.bitwiseXOR(q - one)).otherwise(acc))
        return F.struct(v.alias("v"), flip.alias("flip"))

    def interleave(state: Column) -> Column:
        spots = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"))
                          for b in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(spots, F.lit(0).cast("long"), lambda acc, s: acc * 2 + F.getbit(
            F.get(state["v"], s["i"]).bitwiseXOR(state["flip"]), s["b"]).cast("long"))

    return let(let(let(turned, gray), finish), interleave)


def _steps(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """Each value of a column with its step: its share of the rows before it, in code point order, null last."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).withColumn("last", F.col(column).isNull())
    placed = settle(sums_before(counts, ["last", column], "n", "before"), "steps").frame
    total = placed.agg(F.coalesce(F.sum("n"), F.lit(1)).alias("all")).first()["all"]
    step = F.floor((F.col("before") + F.col("n") / 2) * F.lit(1 << bits) / F.lit(total)).cast("long")
    return placed.select(F.col(column).alias(f"of_{column}"), step.alias(f"step_{column}"))


def shard(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, source, lang, size, text_crc32, curve, law, shard, slot and grown_shard of every document.

    ``curve`` is the place a row is put at: its own, or that of the smallest row with an equal text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = settle(docs.select(
        "doc_id", "source", "lang",
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.length(text).cast("long").alias("chars"),
        F.xxhash64(text).alias("hash")), "shard-rows").frame
    placed = attach(rows, _steps(rows, "source", BITS), {"source": "of_source"})
    placed = attach(placed, _steps(rows, "lang", BITS), {"lang": "of_lang"})
    length = F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(F.col("chars") + 1)).cast("long"))
    curved = placed.withColumn("curve", hilbert_index([F.col("step_source"), F.col("step_lang"), length]))
    curved = settle(curved.drop("step_source", "step_lang"), "curved").frame
    # Only texts that occur several times are looked up; the length is that of the text, so it is the group's own.
    groups = curved.groupBy("hash", "text_crc32", "chars").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("curve", "source", "lang")).alias("first")).filter("n > 1")
    groups = groups.select(F.col("hash").alias("of_hash"), F.col("text_crc32").alias("of_crc32"),
                           F.col("chars").alias("of_chars"), "first")
    together = attach(curved, groups, {"hash": "of_hash", "text_crc32": "of_crc32", "chars": "of_chars"}).withColumn(
        "at", F.coalesce("first", F.struct("curve", "source", "lang"))).drop("first")
    ordered = sums_before(
        together.withColumn("one", F.lit(1).cast("long")),
        ["at", "chars", "hash", "source", "lang", "doc_id"], "one", "place")
    total = rows.count()
    return ordered.select(
        "doc_id", "source", "lang", "size", "text_crc32", F.col("at.curve").alias("curve"), F.lit("rows").alias("law"),
        *_runs("place", total, n_shards), F.lit(None).cast("int").alias("grown_shard"))


def _runs(place: str, total: int, n_shards: int) -> list[Column]:
    """Cut 0..total-1 into runs whose lengths differ by one at most; the slot counts within the run."""
    number = f"({place} * {n_shards} div {max(total, 1)})"
    return [F.expr(f"cast({number} as int)").alias("shard"),
            F.expr(f"{place} - ({number} * {total} + {n_shards - 1}) div {n_shards}").alias("slot")]


def write_shards(spark: SparkSession, docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write ``docs`` as one folder per shard, each file ordered by slot; ``doc_id`` must be unique."""
    at = placed.select(F.col("doc_id").alias("__id"), F.col("shard").alias("shard_no"), F.col("slot").alias("slot_no"))
    joined = attach(docs, at, {"doc_id": "__id"}, how="inner")
    joined.repartitionByRange("shard_no", "slot_no").sortWithinPartitions("shard_no", "slot_no") \
        .drop("slot_no").write.partitionBy("shard_no").parquet(path)
