"""Whole-frame cleaning driven by the schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfwise import constants as C
from shelfwise.functions import text
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.materialise import settle


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_frame(df: DataFrame) -> DataFrame:
    """Clean every string column, pass the others through; names and order stay."""
    strings = set(string_columns(df))
    return df.select(*[(text.clean_text(c).alias(c) if c in strings else F.col(f"`{c}`"))
                       for c in df.columns])


def repair_cells(df: DataFrame, corrections: Mapping[str, str] = C.CELL_CORRECTIONS) -> DataFrame:
    """Repair damaged cells in all string columns."""
    return df.withColumns({c: text.repair_cell(F.col(f"`{c}`"), corrections) for c in string_columns(df)})


def repair_cells_from(df: DataFrame, dictionary: DataFrame, damaged: str = "damaged", repaired: str = "repaired",
                      columns: Sequence[str] | None = None, tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Repair damaged cells (those holding ``?``) of the listed or all string columns from a dictionary table of any
    size. Of several lines for one damaged text the smallest repair counts; lines without ``?`` or repair never do."""
    known = dictionary.filter(F.col(damaged).contains("?") & F.col(repaired).isNotNull())
    lookup = settle(known.groupBy(F.col(damaged).alias("__damaged")).agg(F.min(repaired).alias("__repaired")), "repairs")
    order = df.columns
    for c in string_columns(df) if columns is None else columns:
        df = attach(df, lookup, {c: "__damaged"}, tuning=tuning).withColumn(
            c, F.coalesce("__repaired", F.col(f"`{c}`"))).drop("__repaired")
    return df.select(*[f"`{c}`" for c in order])


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the listed columns that exist, in the frame's order."""
    return df.select(*[f"`{c}`" for c in df.columns if c in set(columns)])


def null_brands(df: DataFrame, columns: Sequence[str] = C.BRAND_COLUMNS) -> DataFrame:
    """Turn "no brand" words into nulls."""
    return df.withColumns({c: text.null_if_missing_brand(F.col(c)) for c in columns})


def left_over_missing_brands(df: DataFrame, columns: Sequence[str] = C.BRAND_COLUMNS) -> DataFrame:
    """Count of "no brand" words still present per column: all zero after ``null_brands``."""
    sums = df.agg(*[F.coalesce(F.sum(F.col(c).isin(*C.MISSING_BRANDS).cast("long")), F.lit(0)).alias(c)
                    for c in columns])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("left_over")) for c in columns
    ])).alias("line")).select("line.*")
