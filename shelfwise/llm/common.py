"""Expressions and small steps shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.operators.joins import JoinTuning
from shelfwise.operators.materialise import settle

# Words are runs of anything but these: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
# Lookups that are joined to texts are broadcast only when they are this small, else the join is a shuffle.
LOOKUP = JoinTuning(max_rows=400_000, max_bytes=48 * 1024 * 1024)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def others(df: DataFrame, taken: Sequence[str]) -> list[Column]:
    """The columns of ``df`` whose names do not clash with ``taken`` (compared without case, as Spark does)."""
    names = {t.lower() for t in taken}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sums_before(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order`` (which must be total).

    Rows are range-partitioned and written; each range is summed by itself and shifted by the sums of the ranges
    before it. Only those sums, one per range, are broadcast; their number is that of the shuffle partitions.
    """
    ranges = shuffle_partitions(df.sparkSession)
    placed = settle(
        df.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges"
    ).frame
    sums = placed.groupBy("__range").agg(F.sum(value).alias("__sum"))
    shifts = sums.select(
        F.col("__range").alias("__r"),
        F.coalesce(F.sum("__sum").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__shift"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(shifts), F.col("__range") == F.col("__r"))
        .withColumn(out, F.col("__shift") + F.col("__within"))
        .drop("__range", "__r", "__shift", "__within")
    )
