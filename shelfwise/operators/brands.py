"""Brand completion, standard spelling by frequency, unification through a mapping table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.constants import BRAND_COLUMNS
from shelfwise.functions.text import alphanumeric_form, brand_root
from shelfwise.operators.clean import keep_columns
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.materialise import settle
from shelfwise.operators.similar import similar_brand_mapping


def stacked_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One line (column_name, value) per row and listed column, in a single pass over the input."""
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in columns])
    return df.select(F.explode(lines).alias("line")).select("line.*")


def _most_frequent(count: str, value: str) -> Column:
    """The value with the highest count, the smallest text on ties. Mergeable, so groups are never gathered."""
    return F.min(F.struct((-F.col(count)).alias("rank"), F.col(value).alias("value")))["value"]


def mode_per_group(df: DataFrame, group: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent non-null value per group; the smallest on ties."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*group).agg(_most_frequent("__n", value).alias(out))


def _spelling_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n, normal_form) of the distinct values that have a normal form."""
    counts = stacked_values(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("normal_form", alphanumeric_form(F.col("value"))).filter(F.col("normal_form").isNotNull())


def _standards(counts: DataFrame) -> DataFrame:
    return (
        counts.groupBy("column_name", "normal_form")
        .agg(_most_frequent("n", "value").alias("standard"), F.count(F.lit(1)).alias("spellings"))
        .filter(F.col("spellings") > 1)
        .drop("spellings")
    )


def spelling_mapping(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, normal_form, standard): for each normal form with several spellings the most frequent one."""
    return _standards(_spelling_counts(df, columns))


def standardise_by_frequency(df: DataFrame, columns: Sequence[str], output_columns: Sequence[str] | None = None,
                             tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Replace each value by the most frequent spelling of its normal form.

    Nulls and values without any letter or digit stay as they are. Few values are looked up as they are; only where they
    are too many to broadcast is the normal form made again row by row.
    """
    if columns:
        counts = settle(_spelling_counts(df, columns), "spelling-counts")
        mapping = settle(_standards(counts.frame), "spellings")
        key, by_value = "normal_form", counts.fits(tuning.max_rows, tuning.max_bytes)
        if by_value:
            both = attach(counts.frame.drop("n"), mapping, {"column_name": "column_name", "normal_form": "normal_form"},
                          "inner", tuning)
            key, mapping = "value", settle(both.filter("value <> standard"), "respelled")
        for c in columns:
            part = mapping.frame.filter(F.col("column_name") == c).select(key, "standard")
            keyed = df.withColumn("__form", F.col(f"`{c}`") if by_value else alphanumeric_form(F.col(c)))
            df = (
                attach(keyed, mapping.narrowed(part), {"__form": key}, tuning=tuning)
                .withColumn(c, F.coalesce("standard", c)).drop("__form", "standard")
            )
    return keep_columns(df, output_columns or df.columns)


def root_mapping(df: DataFrame, column: str, upper_first: bool = False, unify_empty: bool = True) -> DataFrame:
    """(root, standard): the archived variant, which unifies values of empty root too and skips null roots."""
    rooted = df.select(alphanumeric_form(F.col(column), upper_first).alias("root"), F.col(column).alias("value"))
    if not unify_empty:
        rooted = rooted.filter(F.col("root") != "")
    return mode_per_group(rooted.filter(F.col("root").isNotNull()), ["root"], "value", "standard")


def root_standardise(df: DataFrame, column: str, upper_first: bool = False, unify_empty: bool = True,
                     tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    mapping = root_mapping(df, column, upper_first, unify_empty)
    keyed = df.withColumn("__root", alphanumeric_form(F.col(column), upper_first))
    return (
        attach(keyed, mapping, {"__root": "root"}, tuning=tuning)
        .withColumn(column, F.coalesce("standard", column)).drop("__root", "standard")
    )


def first_per_code(reference: DataFrame, code: str, brand: str, order: Sequence[str], named_only: bool) -> DataFrame:
    """(code, found_brand): brand of the first reference row per code, or of the first row that names one."""
    rows = reference.filter(F.col(brand) != "") if named_only else reference
    first = F.min(F.struct(*order, F.col(brand).alias("__brand")))["__brand"]
    return rows.groupBy(F.col(code).alias("code")).agg(first.alias("found_brand"))


def complete_brand(df: DataFrame, reference: DataFrame, order: Sequence[str], barcode: str = "barcode",
                   code: str = "code", brand: str = "brand", columns: Sequence[str] = BRAND_COLUMNS,
                   named_only: bool = False, tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Fill missing brands from a reference list by barcode; the row count cannot change.

    ``named_only=False`` takes the brand of the first reference row of a code, even when that row names none, and
    fills nulls. ``named_only=True`` takes the first non-empty brand and fills nulls and empty text. A missing
    barcode matches a missing code. ``order`` columns say which reference row is first.
    """
    found = first_per_code(reference, code, brand, order, named_only)
    joined = attach(df, found, {barcode: "code"}, tuning=tuning)

    def filled(c: str) -> Column:
        if named_only:
            return F.when(F.coalesce(F.col(c), F.lit("")) == "", F.coalesce("found_brand", c)).otherwise(F.col(c))
        return F.coalesce(F.col(c), F.col("found_brand"))

    return joined.withColumns({c: filled(c) for c in columns}).drop("found_brand")


def replace_by_mapping(df: DataFrame, columns: Sequence[str], mapping: DataFrame, key: str = "brand",
                       value: str = "standard_brand", tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Replace values found in the mapping, once (results are not looked up again). Of several lines for one key
    the largest standard counts."""
    lookup = settle(
        mapping.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__from"))
        .agg(F.max(value).alias("__to_value")),
        "mapping",
    )
    for c in columns:
        df = (
            attach(df, lookup, {c: "__from"}, tuning=tuning)
            .withColumn(c, F.coalesce("__to_value", c)).drop("__to_value")
        )
    return df


def root_brands(df: DataFrame, columns: Sequence[str] = BRAND_COLUMNS) -> DataFrame:
    return df.withColumns({c: brand_root(F.col(c)) for c in columns})


def brand_counts(df: DataFrame, columns: Sequence[str] = BRAND_COLUMNS) -> DataFrame:
    """(brand, freq) over all listed columns together."""
    return (
        stacked_values(df, columns).filter(F.col("value").isNotNull())
        .groupBy(F.col("value").alias("brand")).agg(F.count(F.lit(1)).alias("freq"))
    )


def rooted_values(df: DataFrame, columns: Sequence[str] = BRAND_COLUMNS) -> DataFrame:
    """(value, root, freq) for each distinct value of all listed columns together. Roots are costly, and a table has far
    fewer brands than rows."""
    counts = (
        stacked_values(df, columns).filter(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("freq"))
    )
    return counts.select("value", brand_root(F.col("value")).alias("root"), "freq")


def root_counts(values: DataFrame) -> DataFrame:
    """(brand, freq) of the roots of ``rooted_values``."""
    return values.groupBy(F.col("root").alias("brand")).agg(F.sum("freq").alias("freq"))


def build_brand_mapping(df: DataFrame, columns: Sequence[str] = BRAND_COLUMNS, threshold: float = 0.85,
                        tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """(brand, standard_brand) for the roots of the brand columns."""
    return similar_brand_mapping(root_counts(rooted_values(df, columns)), threshold, tuning=tuning)


def unify_brands(df: DataFrame, columns: Sequence[str] = BRAND_COLUMNS, mapping: DataFrame | None = None,
                 threshold: float = 0.85, tuning: JoinTuning = DEFAULT_TUNING) -> tuple[DataFrame, DataFrame]:
    """Reduce brands to their roots and replace them by a mapping: the given one, or one built from the data.

    Returns the frame and the mapping used, so that it can be saved and reused.
    """
    if mapping is not None:
        return replace_by_mapping(root_brands(df, columns), columns, mapping, tuning=tuning), mapping
    values = settle(rooted_values(df, columns), "brand-values")
    built = settle(similar_brand_mapping(root_counts(values.frame), threshold, tuning=tuning), "brand-mapping")
    if not values.fits(tuning.max_rows, tuning.max_bytes):
        return replace_by_mapping(root_brands(df, columns), columns, built.frame, tuning=tuning), built.frame
    # Few values: each one's outcome is known before the rows are read again.
    known = attach(values.frame, built, {"root": "brand"}, tuning=tuning).select(
        "value", F.coalesce("standard_brand", "root").alias("outcome")).filter("outcome <> value")
    return replace_by_mapping(df, columns, known, "value", "outcome", tuning), built.frame
