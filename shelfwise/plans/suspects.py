"""Train the label models, and use them to list rows that are probably filed wrongly."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.constants import GLOBAL_LEVELS
from shelfwise.operators.features import FeatureSpec, FittedFeatures, add_features, fit_features, with_texts
from shelfwise.operators.labels import build_label_map, decode_labels, encode_labels
from shelfwise.operators.materialise import run_folder, settle
from shelfwise.operators.metrics import confusion, for_sink, level_accuracy, suspects
from shelfwise.operators.model import LevelModels, score_errors, train_error_model, train_level_models
from shelfwise.sources.tables import read_table, tag_split, write_csv_with_index, write_table


@dataclass(frozen=True)
class SuspectSettings:
    levels: Sequence[str] = GLOBAL_LEVELS
    label: str = "is_error"
    row_id: str = "row_id"
    kind: str = "logistic"
    epochs: int = 100
    level_epochs: int = 100
    correct_levels: bool = False  # also learn and predict the right levels
    text_width: int = 1 << 12


def _spec(settings: SuspectSettings) -> FeatureSpec:
    return FeatureSpec(label_columns=tuple(f"{c}_idx" for c in settings.levels), text_width=settings.text_width)


def train(train_rows: DataFrame, model_dir: str, settings: SuspectSettings = SuspectSettings(),
          resume: bool = False) -> None:
    """Fit everything on the training rows and save it under ``model_dir``.

    ``resume`` trains a perceptron on from the saved weights; other kinds start afresh, so they refuse it.
    """
    spark = train_rows.sparkSession
    if resume and (settings.kind != "perceptron" or settings.correct_levels):
        raise ValueError("resume is possible for kind='perceptron' without level models only")
    with run_folder(spark):
        _train(train_rows, model_dir, settings, resume)


def _train(train_rows: DataFrame, model_dir: str, settings: SuspectSettings, resume: bool) -> None:
    spark = train_rows.sparkSession
    label_map = build_label_map(train_rows, settings.row_id, settings.levels)
    label_map.write.mode("overwrite").parquet(f"{model_dir}/label_map")
    label_map = read_table(spark, f"{model_dir}/label_map")
    rows = encode_labels(with_texts(train_rows, settings.levels), label_map, settings.levels)
    if settings.correct_levels:
        absent = [f"correct_{c}" for c in settings.levels if f"correct_{c}" not in rows.columns]
        if absent:
            raise ValueError(f"the corrector needs the corrected levels: {absent} not found")
        rows = encode_labels(rows, label_map, settings.levels, prefix="correct_")
    # The fits read a few columns many times; the others are not carried along.
    spec = _spec(settings)
    read = [*spec.text_columns, *spec.category_columns, *spec.value_columns, *spec.label_columns, settings.label]
    read += [f"correct_{c}_idx" for c in settings.levels] if settings.correct_levels else []
    rows = settle(rows.select(*[f"`{c}`" for c in dict.fromkeys(read)]), "training").frame
    fitted = fit_features(rows, spec)
    ready = settle(add_features(rows, fitted), "vectors").frame  # read by every fit
    before = PipelineModel.load(f"{model_dir}/errors") if resume else None
    errors = train_error_model(ready, settings.label, kind=settings.kind, epochs=settings.epochs, start_from=before)
    fitted.save(f"{model_dir}/features")
    errors.write().overwrite().save(f"{model_dir}/errors")
    if settings.correct_levels:
        train_level_models(ready, settings.levels, settings.label, epochs=settings.level_epochs).save(
            spark, f"{model_dir}/levels")


def predict(spark: SparkSession, rows: DataFrame, model_dir: str, settings: SuspectSettings = SuspectSettings(),
            ) -> DataFrame:
    """The rows with ``pred_is_error``, ``pred_probs`` and, for the corrector, ``pred_<level>``."""
    label_map = read_table(spark, f"{model_dir}/label_map")
    encoded = encode_labels(with_texts(rows, settings.levels), label_map, settings.levels)
    scored = score_errors(add_features(encoded, FittedFeatures.load(spark, f"{model_dir}/features")),
                          PipelineModel.load(f"{model_dir}/errors"))
    helpers = ["description", "hierarchy_path", "features", *[f"{c}_idx" for c in settings.levels]]
    if settings.correct_levels:
        predicted = LevelModels.load(spark, f"{model_dir}/levels").predict(scored)
        scored = decode_labels(predicted, label_map, settings.levels)
    return scored.drop(*helpers)


def inference_metrics(scored: DataFrame, settings: SuspectSettings = SuspectSettings()) -> DataFrame:
    """(metric, value) of predictions with known labels: the confusion counts, accuracy, precision, recall and f1 and,
    where levels are predicted, the accuracy of each level over the right rows."""
    line = confusion(scored, settings.label, "pred_is_error")
    rows = line.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in line.columns
    ])).alias("m")).select("m.*")
    found = [c for c in settings.levels if f"pred_{c}" in scored.columns]
    if not found:
        return rows
    levels = level_accuracy(scored, [(c, c, f"pred_{c}") for c in found], settings.label)
    return rows.unionByName(levels.select(
        F.concat(F.lit("accuracy_"), "level").alias("metric"), F.col("accuracy").alias("value")))


def write_suspects(found: DataFrame, sink: str, settings: SuspectSettings = SuspectSettings(),
                   csv_path: str | None = None) -> None:
    """Replace the suspects table (text and flag columns cast to its types), and write the predictions as CSV with a
    row number where a path is given."""
    flags = [c for c in (settings.label, "pred_is_error") if c in found.columns]
    texts = [f.name for f in found.schema.fields if f.name not in flags and f.dataType.simpleString() == "string"]
    rows = for_sink(found, [settings.row_id, *[c for c in texts if c != settings.row_id]], flags)
    write_table(rows, sink)
    if csv_path is not None:
        write_csv_with_index(read_table(found.sparkSession, sink), csv_path, [settings.row_id])


def run_suspects(spark: SparkSession, train_rows: DataFrame | None, test_rows: DataFrame | None, mode: str,
                 model_dir: str, settings: SuspectSettings = SuspectSettings(), resume: bool = False,
                 k: int = 10) -> DataFrame | None:
    """``train`` fits and saves; ``inference`` returns all predictions (corrector) or only the suspects."""
    train_side, test_side = tag_split(train_rows, test_rows)
    if mode == "train":
        train(train_side, model_dir, settings, resume)
        return None
    if mode == "inference":
        scored = predict(spark, test_side, model_dir, settings)
        if settings.correct_levels:
            return scored
        return suspects(settle(scored, "scored").frame, settings.label, "pred_is_error", "pred_probs",
                        [settings.row_id], k)
    raise ValueError(f"unknown mode {mode!r}: use train or inference")
