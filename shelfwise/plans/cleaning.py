"""The two cleaning plans, from raw table to clean and excluded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfwise.config import ALL_MEMBERS, SURPLUS, Dataset, Profile, profile
from shelfwise.operators.brands import complete_brand, standardise_by_frequency, unify_brands
from shelfwise.operators.clean import clean_frame, null_brands
from shelfwise.operators.hierarchy import hierarchy_warnings
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning
from shelfwise.operators.materialise import run_folder, settle
from shelfwise.operators.validate import (
    clean_rows, excluded_report, excluded_rows, excluded_schema, flag_errors, without_excluded,
)
from shelfwise.sources.tables import read_table, write_table


def present(columns: Sequence[str], df: DataFrame) -> list[str]:
    return [c for c in columns if c in df.columns]


def standardised(raw: DataFrame, dataset: Dataset, rules: Profile, tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Clean text, null the "no brand" words, give each listed column its most frequent spelling.

    The cleaned rows are written once: the steps after it read them several times, mostly a few columns each.
    """
    cleaned = settle(null_brands(clean_frame(raw), present(dataset.brand_columns, raw)), "cleaned").frame
    return standardise_by_frequency(cleaned, present(rules.standard_columns, raw), raw.columns, tuning)


def clean_and_validate(raw: DataFrame, dataset: Dataset, rules: Profile | None = None,
                       tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """All rows, cleaned and standardised, with their reasons; every member of a duplicate group is flagged."""
    rules = rules or profile(dataset.dataset_type, ALL_MEMBERS)
    # Row hashes, suspect rows, keys and the result all read the standardised rows.
    rows = settle(standardised(raw, dataset, rules, tuning), "standardised").frame
    return flag_errors(rows, dataset, rules.rules, raw.columns, tuning)


def run_clean_and_validate(spark: SparkSession, dataset: Dataset, rules: Profile | None = None,
                           tuning: JoinTuning = DEFAULT_TUNING) -> tuple[int, int]:
    """Raw table to clean and excluded tables; returns the row counts of both."""
    raw = read_table(spark, dataset.table("raw"))
    with run_folder(spark):
        flagged = settle(clean_and_validate(raw, dataset, rules, tuning), "flagged").frame
        write_table(clean_rows(flagged), dataset.table("clean"), raw.schema)
        write_table(excluded_rows(flagged), dataset.table("excluded"), excluded_schema(raw.schema))
    return (read_table(spark, dataset.table("clean")).count(), read_table(spark, dataset.table("excluded")).count())


def clean_and_unify(raw: DataFrame, dataset: Dataset, reference: DataFrame, reference_order: Sequence[str],
                    mapping: DataFrame | None = None, tuning: JoinTuning = DEFAULT_TUNING,
                    ) -> tuple[DataFrame, DataFrame]:
    """Clean text, null and complete brands, unify them; returns the rows and the brand mapping used."""
    brands = list(dataset.brand_columns)
    completed = complete_brand(null_brands(clean_frame(raw), brands), reference, reference_order,
                               barcode=dataset.barcode_columns[0], columns=brands, tuning=tuning)
    # Read for the counts of brands and again for their replacement.
    unified, used = unify_brands(settle(completed, "completed").frame, brands, mapping, tuning=tuning)
    return unified.select(*raw.columns), used


def run_clean_and_unify(spark: SparkSession, dataset: Dataset, reference: DataFrame, reference_order: Sequence[str],
                        mapping_table: str, reuse_mapping: bool = True, rules: Profile | None = None,
                        drop_excluded: bool = False, tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Raw table to clean and excluded tables; returns the hierarchy warnings.

    ``reuse_mapping`` reads the saved brand mapping, else one is built and saved. ``drop_excluded`` also takes the
    excluded rows out of the clean table.
    """
    rules = rules or profile(dataset.dataset_type, SURPLUS)
    raw = read_table(spark, dataset.table("raw"))
    saved = read_table(spark, mapping_table) if reuse_mapping else None
    with run_folder(spark):
        rows, used = clean_and_unify(raw, dataset, reference, reference_order, saved, tuning)
        write_table(rows, dataset.table("clean"), raw.schema)
        if not reuse_mapping:
            write_table(used, mapping_table, "brand string, standard_brand string")
        clean = read_table(spark, dataset.table("clean"))
        write_table(excluded_report(clean, dataset, rules, tuning=tuning), dataset.table("excluded"))
        if drop_excluded:
            write_table(without_excluded(clean, read_table(spark, dataset.table("excluded"))), dataset.table("clean"))
    return hierarchy_warnings(read_table(spark, dataset.table("clean")))
