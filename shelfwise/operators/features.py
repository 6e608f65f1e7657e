"""Feature vectors for the label models, fitted on the training rows only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF, HashingTF, Normalizer, OneHotEncoder, RegexTokenizer, SQLTransformer, VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.constants import GLOBAL_LEVELS
from shelfwise.functions.text import describe, level_path
from shelfwise.operators.joins import attach
from shelfwise.operators.labels import category_index
from shelfwise.operators.materialise import Settled, settle


def hashed_words(column: str, width: int) -> list:
    """The built-in text embedding: word counts hashed to ``width`` places, rare words weighing more, of length 1."""
    return [
        RegexTokenizer(inputCol=column, outputCol=f"{column}_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol=f"{column}_words", outputCol=f"{column}_tf", numFeatures=width),
        IDF(inputCol=f"{column}_tf", outputCol=f"{column}_idf"),
        Normalizer(inputCol=f"{column}_idf", outputCol=f"{column}_vec"),
    ]


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns become features. ``label_columns`` are number columns such as ``<level>_idx``.

    ``embedding`` gives the pipeline stages that turn a text column into the vector ``<column>_vec``; any stages of
    ``pyspark.ml`` that can be saved will do.
    """

    text_columns: tuple[str, ...] = ("description", "hierarchy_path")
    category_columns: tuple[str, ...] = ("color_desc", "size_desc")
    value_columns: tuple[str, ...] = ()
    label_columns: tuple[str, ...] = ()
    text_width: int = 1 << 12
    embedding: Callable[[str, int], list] = hashed_words


def with_texts(df: DataFrame, levels: Sequence[str] = GLOBAL_LEVELS) -> DataFrame:
    """Add the item ``description`` and its ``hierarchy_path``."""
    return df.withColumns({
        "description": describe(F.col("item_desc"), F.col("local_brand_name"), F.col("global_brand_name")),
        "hierarchy_path": level_path([F.col(c) for c in levels]),
    })


def value_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One line with mean and population deviation per column, as ``<column>_mean`` and ``<column>_std``."""
    stats = []
    for c in columns:
        stats += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.agg(*stats)


def standard_scores(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_z``: distance from the mean in deviations; a constant column gives 0."""
    stats = value_stats(df if fitted_on is None else fitted_on, columns)
    joined = df.join(F.broadcast(stats))  # one line of numbers
    scores = {
        f"{c}_z": (F.col(c) - F.col(f"{c}_mean"))
        / F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std"))
        for c in columns
    }
    return joined.withColumns(scores).drop(*stats.columns)


def _score_stage(train: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    line = value_stats(train, columns).first()
    # A column without any value has no mean; its scores are null whatever stands here.
    terms = [f"(CAST(`{c}` AS DOUBLE) - ({line[f'{c}_mean'] or 0.0!r})) / ({line[f'{c}_std'] or 1.0!r}) AS `{c}_z`"
             for c in columns]
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


MISSING_CATEGORY = "nan"


@dataclass(frozen=True)
class FittedFeatures:
    """The category numbers of the training rows, and the pipeline behind them.

    A category column becomes its number by a lookup join, and one place of the vector per category, however many
    there are: only the number of categories passes through the driver. Unseen categories have no place.
    """

    categories: DataFrame
    sizes: Mapping[str, int]
    pipeline: PipelineModel

    def numbered(self, df: DataFrame) -> DataFrame:
        return _numbered(df, settle(self.categories, "categories"), self.sizes)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.numbered(df))

    def save(self, path: str) -> None:
        self.categories.write.mode("overwrite").parquet(f"{path}/categories")
        self.pipeline.write().overwrite().save(f"{path}/pipeline")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedFeatures:
        categories = spark.read.parquet(f"{path}/categories")
        return FittedFeatures(categories, _sizes(categories), PipelineModel.load(f"{path}/pipeline"))


def _sizes(categories: DataFrame) -> dict[str, int]:
    """One number per category column."""
    return {line["column_name"]: line["n"] for line in
            categories.groupBy("column_name").agg((F.max("idx") + 1).cast("int").alias("n")).collect()}


def _numbered(df: DataFrame, categories: Settled, sizes: Mapping[str, int]) -> DataFrame:
    """Add ``<column>_at``: the number of the category; unseen ones get the number after the last."""
    parts = categories.parts("column_name")
    for c, size in sizes.items():
        part = parts[c]
        lookup = part.narrowed(part.frame.select(F.col("value").alias("__value"), F.col("idx").alias("__idx")))
        filled = df.withColumn(f"{c}_cat", F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)))
        df = attach(filled, lookup, {f"{c}_cat": "__value"}).withColumn(
            f"{c}_at", F.coalesce("__idx", F.lit(size)).cast("double")).drop("__idx", f"{c}_cat")
    return df


def fit_features(train: DataFrame, spec: FeatureSpec = FeatureSpec(), out: str = "features") -> FittedFeatures:
    """Fit the whole feature plan; its transform adds the vector column ``out`` to any frame."""
    texts = train.select(*[F.col(c).cast("string").alias(c) for c in spec.category_columns])
    categories = settle(category_index(texts, spec.category_columns, MISSING_CATEGORY).select(
        "column_name", "value", "idx"), "categories")
    sizes = _sizes(categories.frame)
    stages = [s for c in spec.text_columns for s in spec.embedding(c, spec.text_width)]
    if spec.value_columns:
        stages.append(_score_stage(train, spec.value_columns))
    # The place kept for numbers beyond the training rows is the last one, which is dropped: unseen means all zeros.
    stages += [OneHotEncoder(inputCol=f"{c}_at", outputCol=f"{c}_vec", handleInvalid="keep", dropLast=True)
               for c in spec.category_columns]
    parts = [f"{c}_vec" for c in spec.text_columns] + [f"{c}_z" for c in spec.value_columns]
    parts += [f"{c}_vec" for c in spec.category_columns] + list(spec.label_columns)
    stages.append(VectorAssembler(inputCols=parts, outputCol=out, handleInvalid="keep"))
    rows = _numbered(train, categories, sizes)
    return FittedFeatures(categories.frame, sizes, Pipeline(stages=stages).fit(rows))


def add_features(df: DataFrame, fitted: FittedFeatures, out: str = "features") -> DataFrame:
    """The input columns plus the vector, without the steps in between."""
    return fitted.transform(df).select(*df.columns, out)
