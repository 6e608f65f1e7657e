"""Groups of equal rows: count them, find the first of a key, write copies back out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.materialise import Settled, settle

COPIES_PER_CHUNK = 100_000


def _names(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    """Key values held by more than one row, with their row count. Only the key columns are read."""
    return (
        df.select(*_names(keys)).groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)
    )


def _alike(df: DataFrame, columns: Sequence[str], count: str, tuning: JoinTuning) -> DataFrame:
    """Groups of equal rows with ``count`` and their hash ``row_hash``, of those rows only whose hash repeats.

    A first pass counts 64-bit row hashes, so what is shuffled is narrow. Only rows whose hash repeats are then
    compared column by column, so a hash collision cannot produce a false hit.
    """
    hashed = df.select(*_names(columns), F.xxhash64(*_names(columns)).alias("row_hash"))
    suspects = repeated_keys(hashed, ["row_hash"]).select("row_hash")
    return (
        attach(hashed, suspects, {"row_hash": "row_hash"}, "left_semi", tuning)
        .groupBy("row_hash", *_names(columns)).agg(F.count(F.lit(1)).alias(count))
    )


def repeated_rows(df: DataFrame, columns: Sequence[str], count: str = "copies", tuning: JoinTuning = DEFAULT_TUNING,
                  ) -> Settled:
    """Whole rows that occur more than once, one line each, with ``count`` and their hash ``row_hash``."""
    return settle(_alike(df, columns, count, tuning).filter(F.col(count) > 1), "repeated-rows")


def attach_row_copies(df: DataFrame, columns: Sequence[str], count: str, tuning: JoinTuning = DEFAULT_TUNING,
                      ) -> DataFrame:
    """Add ``count``: how many rows equal this one over ``columns`` (null where it is unique).

    Where all rows of a hash were found equal, the hash alone says so, and whole rows are neither broadcast nor moved.
    Only rows of a hash that different rows share are looked up by all their columns.
    """
    groups = _alike(df, columns, count, tuning).groupBy("row_hash").agg(
        F.count(F.lit(1)).alias("__groups"), F.max(count).alias(count))
    hashes = settle(groups.filter(F.col(count) > 1), "repeated-hashes")
    sure = hashes.narrowed(hashes.frame.filter("__groups = 1").drop("__groups"))
    hashed = df.withColumn("row_hash", F.xxhash64(*_names(columns)))
    marked = attach(hashed, sure, {"row_hash": "row_hash"}, "left", tuning)
    shared = hashes.frame.filter("__groups > 1").select("row_hash")
    if shared.isEmpty():
        return marked.drop("row_hash")
    inside = attach(hashed.select(*_names(columns), "row_hash"), hashes.narrowed(shared), {"row_hash": "row_hash"},
                    "left_semi", tuning)
    repeated = settle(inside.groupBy("row_hash", *_names(columns)).agg(F.count(F.lit(1)).alias("__more"))
                      .filter("__more > 1"), "repeated-rows")
    on = {"row_hash": "row_hash", **{c: c for c in columns}}
    return attach(marked, repeated, on, "left", tuning).withColumn(count, F.coalesce(count, "__more")).drop(
        "row_hash", "__more")


def expand_copies(weighted: DataFrame, copies: str) -> DataFrame:
    """Write each row out ``copies`` times. Large groups are cut into chunks that are spread over tasks."""
    spark = weighted.sparkSession
    few = weighted.filter(F.col(copies).between(1, COPIES_PER_CHUNK))
    many = (
        weighted.filter(F.col(copies) > COPIES_PER_CHUNK)
        .withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / COPIES_PER_CHUNK))))
        .withColumn(copies, F.least(F.lit(COPIES_PER_CHUNK), F.col(copies) - F.col("__chunk") * COPIES_PER_CHUNK))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *_names(weighted.columns), "__chunk")
        .drop("__chunk")
    )

    def written_out(part: DataFrame) -> DataFrame:
        return part.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)

    return written_out(few).unionByName(written_out(many))


def hot_apart(df: DataFrame, keys: Sequence[str], repeated: Settled, count: str = "copies",
              tuning: JoinTuning = DEFAULT_TUNING) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``df`` whose key has few copies, which one task may gather, and those of the hot keys, if any.
    ``repeated`` holds the repeated keys with their row count."""
    hot = settle(repeated.frame.filter(F.col(count) >= tuning.hot_floor).select(*_names(keys)), "hot-keys")
    if hot.frame.isEmpty():
        return df, None
    on = {k: k for k in keys}
    return attach(df, hot, on, "left_anti", tuning), attach(df, hot, on, "left_semi", tuning)


def key_survivors(df: DataFrame, keys: Sequence[str], columns: Sequence[str], tuning: JoinTuning = DEFAULT_TUNING,
                  repeated: Settled | None = None) -> DataFrame:
    """For each repeated key the smallest row over all columns (nulls first), as the struct ``survivor``."""
    twice = repeated_keys(df, keys) if repeated is None else repeated.frame
    twice = twice.select(*_names(keys)) if repeated is None else repeated.narrowed(twice.select(*_names(keys)))
    inside = attach(df.select(*_names(columns)), twice, {k: k for k in keys}, "left_semi", tuning)
    return inside.groupBy(*_names(keys)).agg(F.min(F.struct(*_names(columns))).alias("survivor"))
