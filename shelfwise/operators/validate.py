"""Data-quality rules, the clean/excluded split and the excluded report.

Two flavours. In ``all_members`` every row of a duplicate group is flagged and each row carries its reasons. In
``surplus`` one row per group survives and the report has one line per distinct offending row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from shelfwise import constants as C
from shelfwise.config import RULE_ORDER, Dataset, Profile
from shelfwise.functions.text import wrong_barcode, wrong_day, year_out_of_range
from shelfwise.operators.copies import (
    attach_row_copies, expand_copies, hot_apart, key_survivors, repeated_keys, repeated_rows,
)
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.materialise import Settled, settle

REASONS = "error_reason"


def with_empty_reasons(df: DataFrame) -> DataFrame:
    return df.withColumn(REASONS, F.array().cast("array<string>"))


def _add_reason(df: DataFrame, wrong: Column, reason: str) -> DataFrame:
    return df.withColumn(REASONS, F.when(wrong, F.array_append(REASONS, F.lit(reason))).otherwise(F.col(REASONS)))


def flag_duplicate_rows(df: DataFrame, columns: Sequence[str], tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Flag every member of a group of rows equal in all ``columns``."""
    marked = attach_row_copies(df, columns, "__copies", tuning)
    return _add_reason(marked, F.col("__copies").isNotNull(), C.ROW_REASON).drop("__copies")


def flag_duplicate_keys(df: DataFrame, keys: Sequence[str], tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Flag every row whose key occurs more than once; null is a key value like any other.

    Few repeated keys are broadcast. Where they are many, the rows move once and are counted key by key; only hot keys
    are known beforehand, and their rows stay where they are.
    """
    repeated = settle(repeated_keys(df, keys, "__copies"), "repeated-keys")
    if repeated.fits(tuning.max_rows, tuning.max_bytes):
        marked = attach(df, repeated, {k: k for k in keys}, tuning=tuning)
    else:
        few, hot = hot_apart(df, keys, repeated, "__copies", tuning)
        marked = few.withColumn("__copies", F.count(F.lit(1)).over(Window.partitionBy(*[f"`{k}`" for k in keys])))
        marked = marked if hot is None else marked.unionByName(hot.withColumn("__copies", F.lit(2).cast("long")))
    return _add_reason(marked, F.coalesce("__copies", F.lit(1)) > 1, C.KEY_REASON).drop("__copies")


def flag_barcode_length(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One reason per offending column. Missing and empty barcodes pass."""
    for c in columns:
        df = _add_reason(df, wrong_barcode(F.col(c)), C.BARCODE_REASON)
    return df


def _is_date(field: StructField) -> bool:
    return isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType))


def flag_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text must be a year-month-day in range; a typed date only has its year checked."""
    for c in columns:
        typed = _is_date(df.schema[c])
        wrong = F.coalesce(year_out_of_range(F.col(c)), F.lit(False)) if typed else wrong_day(F.col(c).cast("string"))
        df = _add_reason(df, wrong, C.DATE_REASON)
    return df


def flag_errors(df: DataFrame, dataset: Dataset, rules: Sequence[str], columns: Sequence[str] | None = None,
                tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Add the array ``error_reason``, running the active rules in their fixed order."""
    columns = list(columns or df.columns)
    checks: dict[str, Callable[[DataFrame], DataFrame]] = {
        "duplicate_row": lambda d: flag_duplicate_rows(d, columns, tuning),
        "duplicate_key": lambda d: flag_duplicate_keys(d, dataset.primary_keys, tuning),
        "barcode_length": lambda d: flag_barcode_length(d, dataset.barcode_columns),
        "date_format": lambda d: flag_dates(d, dataset.date_columns),
    }
    flagged = with_empty_reasons(df)
    for rule in RULE_ORDER:
        if rule in rules:
            flagged = checks[rule](flagged)
    return flagged


def clean_rows(flagged: DataFrame) -> DataFrame:
    """Rows without a reason, without the reason column."""
    return flagged.filter(F.size(REASONS) == 0).drop(REASONS)


def excluded_rows(flagged: DataFrame) -> DataFrame:
    """Rows with reasons, the reasons joined to one text in rule order."""
    return flagged.filter(F.size(REASONS) > 0).withColumn(REASONS, F.array_join(REASONS, ", "))


def excluded_schema(schema: StructType) -> StructType:
    """Schema of the excluded table: that of the data plus the reason text."""
    return StructType([*schema.fields, StructField(REASONS, StringType())])


def surplus_duplicate_rows(df: DataFrame, columns: Sequence[str], tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Of every group of equal rows all copies but one."""
    repeated = repeated_rows(df, columns, "__copies", tuning).frame.drop("row_hash")
    return expand_copies(repeated.withColumn("__copies", F.col("__copies") - 1), "__copies")


def _key_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str], tuning: JoinTuning,
                repeated: Settled | None = None) -> DataFrame:
    """Distinct rows inside repeated keys, with ``__copies`` and whether the row is the key's survivor."""
    survivors = key_survivors(df, keys, columns, tuning, repeated)
    inside = attach(df.select(*[f"`{c}`" for c in columns]), survivors, {k: k for k in keys}, "inner", tuning)
    first = F.struct(*[f"`{c}`" for c in columns]).eqNullSafe(F.col("survivor"))
    return inside.withColumn("__first", first).drop("survivor").groupBy(*[f"`{c}`" for c in columns], "__first").agg(
        F.count(F.lit(1)).alias("__copies"))


def surplus_duplicate_keys(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                           tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Of every key group all rows but the first by all columns, nulls first.

    Where the repeated keys are too many to broadcast, the rows move once and are put in order key by key; only those
    of hot keys are grouped by their values.
    """
    columns = list(columns or df.columns)
    repeated: Settled | None = settle(repeated_keys(df, keys, "__copies"), "repeated-keys")
    if not repeated.fits(tuning.max_rows, tuning.max_bytes):
        few, hot = hot_apart(df.select(*[f"`{c}`" for c in columns]), keys, repeated, "__copies", tuning)
        place = F.row_number().over(Window.partitionBy(*[f"`{k}`" for k in keys]).orderBy(*[f"`{c}`" for c in columns]))
        surplus = few.withColumn("__place", place).filter("__place > 1").drop("__place")
        return surplus if hot is None else surplus.unionByName(_surplus_of_groups(hot, keys, columns, tuning))
    return _surplus_of_groups(df, keys, columns, tuning, repeated)


def _surplus_of_groups(df: DataFrame, keys: Sequence[str], columns: Sequence[str], tuning: JoinTuning,
                       repeated: Settled | None = None) -> DataFrame:
    groups = _key_groups(df, keys, columns, tuning, repeated)
    left = F.col("__copies") - F.when(F.col("__first"), 1).otherwise(0)
    return expand_copies(groups.withColumn("__copies", left).drop("__first").filter("__copies > 0"), "__copies")


def barcode_length_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose barcode has a wrong length; empty text counts, null does not."""
    return df.filter(wrong_barcode(F.col(column), empty_fails=True))


def first_date_column(schema: StructType) -> str:
    for field in schema.fields:
        if isinstance(field.dataType, DateType):
            return field.name
    raise ValueError("the data has no column of type date")


def date_year_rows(df: DataFrame) -> DataFrame:
    """Rows whose first date column lies outside the accepted years."""
    return df.filter(year_out_of_range(F.col(first_date_column(df.schema))))


def _hit_lines(df: DataFrame, dataset: Dataset, rules: Sequence[str], columns: Sequence[str],
               tuning: JoinTuning) -> DataFrame:
    """(reason, columns..) of every offending row, at least one line per distinct row and rule."""
    checks: dict[str, Callable[[], tuple[str, DataFrame]]] = {
        "duplicate_row": lambda: (C.ROW_REASON, repeated_rows(df, columns, tuning=tuning).frame),
        "duplicate_key": lambda: (C.KEY_REASON, _key_groups(df, dataset.primary_keys, columns, tuning)
                                  .filter(~F.col("__first") | (F.col("__copies") > 1))),
        "barcode_length": lambda: (C.BARCODE_REASON, barcode_length_rows(df, dataset.barcode_columns[0])),
        "date_format": lambda: (C.DATE_REASON, date_year_rows(df)),
    }
    hits = [checks[rule]() for rule in RULE_ORDER if rule in rules]
    if not hits:
        return df.select(F.lit(None).cast("string").alias("reason"), *[f"`{c}`" for c in columns]).limit(0)
    lines = [found.select(F.lit(reason).alias("reason"), *[f"`{c}`" for c in columns]) for reason, found in hits]
    union = lines[0]
    for more in lines[1:]:
        union = union.unionByName(more)
    return union


def rule_hits(df: DataFrame, dataset: Dataset, rules: Sequence[str], columns: Sequence[str] | None = None,
              tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """(reason, columns..): one line per distinct offending row and rule, duplicates in the surplus flavour."""
    return _hit_lines(df, dataset, rules, list(columns or df.columns), tuning).distinct()


def excluded_report(df: DataFrame, dataset: Dataset, profile: Profile, columns: Sequence[str] | None = None,
                    tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """(reasons array, columns..): each distinct offending row with its distinct reasons, sorted."""
    columns = list(columns or df.columns)
    hits = _hit_lines(df, dataset, profile.rules, columns, tuning)
    grouped = hits.groupBy(*[f"`{c}`" for c in columns]).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
    return grouped.select("reasons", *[f"`{c}`" for c in columns])


def without_excluded(clean: DataFrame, excluded: DataFrame) -> DataFrame:
    """Distinct clean rows that do not occur in the excluded rows. Both are grouped together, so that whole rows move
    once; copies are folded before."""
    columns = [f"`{c}`" for c in clean.columns]
    lines = clean.withColumn("__out", F.lit(0)).unionByName(excluded.select(*columns, F.lit(1).alias("__out")))
    groups = lines.groupBy(*columns).agg(F.max("__out").alias("__out"))
    return groups.filter("__out = 0").drop("__out")
