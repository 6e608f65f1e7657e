"""Number rows in order without sorting them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.materialise import settle


def number_in_order(df: DataFrame, group: str, order: Sequence[str], out: str, first: int = 1) -> DataFrame:
    """Add ``out``: first, first+1, ... per ``group`` value in ``order`` (which must be total).

    Rows are range-partitioned and written; each range is numbered by itself and shifted by the row counts of the
    ranges before it. Only those counts, one per group value and range, are broadcast.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = settle(
        df.repartitionByRange(ranges, group, *order).withColumn("__range", F.spark_partition_id()), "numbered"
    ).frame
    # Groups lie next to each other in the ranges, so this table has at most ranges + groups rows.
    shifts = settle(
        placed.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__n"))
        .select(F.col(group).alias("__g"), F.col("__range").alias("__r"),
                F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__range").rowsBetween(
                    Window.unboundedPreceding, -1)), F.lit(0)).alias("__shift")),
        "shifts",
    )
    inside = Window.partitionBy(group, "__range").orderBy(*order)
    side = F.broadcast(shifts.frame) if shifts.fits() else shifts.frame
    return (
        placed.withColumn("__at", F.row_number().over(inside))
        .join(side, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__r")), "left")
        .withColumn(out, F.col("__shift") + F.col("__at") + (first - 1))
        .drop("__range", "__at", "__g", "__r", "__shift")
    )
