"""Label numbers for the category levels, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.constants import GLOBAL_LEVELS, UNKNOWN_LABEL
from shelfwise.operators.brands import stacked_values
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.materialise import Settled, settle
from shelfwise.operators.numbering import number_in_order


def _present(df: DataFrame, columns: Sequence[str]) -> None:
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"label column {c!r} not found")


def build_label_map(df: DataFrame, row_id: str, columns: Sequence[str] = GLOBAL_LEVELS) -> DataFrame:
    """(column_name, value, idx): ``<UNK>`` is 0, other values count from 1 in order of first appearance."""
    _present(df, columns)
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    seen = (
        df.select(row_id, F.explode(lines).alias("line"))
        .filter(F.col("line.value").isNotNull() & (F.col("line.value") != UNKNOWN_LABEL))
        .groupBy("line.column_name", "line.value").agg(F.min(row_id).alias("first_row"))
    )
    numbered = number_in_order(seen, "column_name", ["first_row", "value"], "idx").select("column_name", "value", "idx")
    unknown = df.sparkSession.createDataFrame([(c, UNKNOWN_LABEL, 0) for c in columns],
                                              "column_name string, value string, idx long")
    return unknown.unionByName(numbered)


def category_index(df: DataFrame, columns: Sequence[str], missing: str = "nan") -> DataFrame:
    """(column_name, value, idx): categories in alphabetical order from 0; a missing cell is a category too."""
    values = stacked_values(df, columns).select("column_name", F.coalesce("value", F.lit(missing)).alias("value"))
    return number_in_order(values.distinct(), "column_name", ["value"], "idx", first=0)


def _one_column(parts: dict[str, Settled], label_map: Settled, column: str, key: str, value: str) -> Settled:
    """The lookup of one column, judged by its own size; empty for a column the map does not know."""
    part = parts.get(column) or label_map.narrowed(label_map.frame.limit(0))
    return part.narrowed(part.frame.select(F.col(key).alias("__key"), F.col(value).alias("__found")))


def encode_labels(df: DataFrame, label_map: DataFrame, columns: Sequence[str] = GLOBAL_LEVELS, prefix: str = "",
                  tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Add ``<column>_idx``; missing and unseen values give 0.

    With ``prefix`` the columns read are ``<prefix><column>``, numbered with the map of ``<column>``: that is how
    corrected labels share the numbers of the observed ones.
    """
    _present(df, [prefix + c for c in columns])
    known = settle(label_map, "label-map")
    parts = known.parts("column_name")
    for c in columns:
        df = (
            attach(df, _one_column(parts, known, c, "value", "idx"), {prefix + c: "__key"}, tuning=tuning)
            .withColumn(f"{prefix}{c}_idx", F.coalesce("__found", F.lit(0)).cast("int")).drop("__found")
        )
    return df


def decode_labels(df: DataFrame, label_map: DataFrame, columns: Sequence[str] = GLOBAL_LEVELS, idx_suffix: str = "_idx",
                  tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Turn ``pred_<column><idx_suffix>`` numbers into the labels ``pred_<column>``."""
    known = settle(label_map, "label-map")
    parts = known.parts("column_name")
    for c in columns:
        source = f"pred_{c}{idx_suffix}"
        df = (
            attach(df, _one_column(parts, known, c, "idx", "value"), {source: "__key"}, tuning=tuning)
            .withColumnRenamed("__found", f"pred_{c}").drop(source)
        )
    return df


def level_target(column: str, is_error: Column, prefix: str = "correct_") -> Column:
    """What the corrector should predict: the observed number of a right row, the corrected one of a wrong row."""
    return F.when(is_error, F.col(f"{prefix}{column}_idx")).otherwise(F.col(f"{column}_idx"))
