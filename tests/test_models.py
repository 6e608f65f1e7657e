from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfwise.operators import model
from shelfwise.operators.features import FeatureSpec, FittedFeatures, add_features, fit_features
from shelfwise.operators.materialise import settle
from shelfwise.operators.model import score_errors, train_error_model, train_level_models
from shelfwise.plans import suspects
from shelfwise.plans.suspects import SuspectSettings, inference_metrics, run_suspects, write_suspects

LEVELS = ("l1", "l2")
SETTINGS = dict(levels=LEVELS, text_width=64, epochs=30, level_epochs=20)


@pytest.fixture(scope="module")
def items(spark):
    """Rows whose first level contradicts their text are errors."""
    return spark.range(120).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 2 == 0, "fresh milk bottle").otherwise("cotton shirt").alias("item_desc"),
        F.lit("TEX").alias("local_brand_name"), F.lit("BRAND").alias("global_brand_name"),
        F.when(F.col("id") % 3 == 0, None).otherwise("RED").alias("color_desc"), F.lit("M").alias("size_desc"),
        F.when((F.col("id") % 2 == 0) != (F.col("id") % 10 == 0), "FOOD").otherwise("NO FOOD").alias("l1"),
        F.when(F.col("id") % 2 == 0, "DAIRY").otherwise("TEXTILE").alias("l2"),
        (F.col("id") % 10 == 0).cast("int").alias("is_error"),
        F.when(F.col("id") % 10 == 0, "FOOD").alias("correct_l1"),
        F.when(F.col("id") % 10 == 0, "DAIRY").alias("correct_l2"),
    )


def test_binary_plan(spark, items, tmp_path):
    folder = str(tmp_path / "model")
    settings = SuspectSettings(**SETTINGS)
    assert run_suspects(spark, items, None, "train", folder, settings) is None
    found = run_suspects(spark, None, items, "inference", folder, settings)
    assert {"pred_is_error", "pred_probs", "split"} <= set(found.columns)
    # The errors are learnable, so no label is contradicted and the ten most suspicious rows are all errors.
    assert found.count() == 10 and found.filter("is_error = 0").count() == 0


def test_only_columns_the_fits_read_are_written(spark, items, tmp_path, monkeypatch):
    written = {}

    def noted(df, label="step"):
        written[label] = set(df.columns)
        return settle(df, label)

    monkeypatch.setattr(suspects, "settle", noted)
    suspects.train(items.withColumn("ballast", F.lit("x")), str(tmp_path / "model"), SuspectSettings(**SETTINGS))
    read = {"description", "hierarchy_path", "color_desc", "size_desc", "l1_idx", "l2_idx", "is_error"}
    assert written["training"] == read and written["vectors"] == read | {"features"}


def test_corrector_plan(spark, items, tmp_path):
    folder = str(tmp_path / "model")
    settings = SuspectSettings(**SETTINGS, correct_levels=True)
    run_suspects(spark, items, None, "train", folder, settings)
    predicted = run_suspects(spark, None, items, "inference", folder, settings)
    assert predicted.count() == items.count()
    assert predicted.filter("is_error = 1 and (pred_l1 <> 'FOOD' or pred_l2 <> 'DAIRY')").count() == 0
    assert predicted.filter("is_error = 0 and pred_l1 <> l1").count() == 0
    values = {r["metric"]: r["value"] for r in inference_metrics(predicted, settings).collect()}
    assert values["accuracy_l1"] == values["accuracy_l2"] == 1.0 and values["tp"] + values["fn"] == 12
    write_suspects(predicted, str(tmp_path / "sink"), settings, str(tmp_path / "csv"))
    sink = spark.read.parquet(str(tmp_path / "sink"))
    assert dict(sink.dtypes)["pred_is_error"] == "boolean" and dict(sink.dtypes)["row_id"] == "string"
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 120


def test_perceptron_trains_and_resumes(spark, items):
    rows = items.withColumn("features", array_to_vector(F.array(
        F.col("is_error").cast("double"), (F.col("row_id") % 3).cast("double"))))
    first = train_error_model(rows, kind="perceptron", epochs=20)
    again = train_error_model(rows, kind="perceptron", epochs=1, start_from=first)
    for fitted in (first, again):
        scored = score_errors(rows, fitted)
        assert scored.filter("pred_is_error <> is_error").count() == 0
        low, high = scored.agg(F.min("pred_probs"), F.max("pred_probs")).first()
        assert 0 <= low < high <= 1


def test_features_are_fitted_on_the_training_rows(spark, items, tmp_path):
    rows = items.withColumns({"description": F.col("item_desc"), "hierarchy_path": F.col("l1"), "v": F.col("row_id")})
    spec = FeatureSpec(text_width=16, value_columns=("v",), label_columns=("is_error",))
    fitted = fit_features(rows.filter("row_id < 60"), spec)
    fitted.save(str(tmp_path / "features"))
    unseen = rows.withColumn("color_desc", F.lit("PURPLE"))
    ready = add_features(unseen, FittedFeatures.load(spark, str(tmp_path / "features"))).orderBy("row_id")
    vector = ready.first()["features"]
    # 16 + 16 words, 1 score, RED and nan, M, 1 label; an unseen colour has no place of its own.
    assert len(vector) == 16 + 16 + 1 + 2 + 1 + 1
    assert list(vector.toArray()[33:35]) == [0.0, 0.0]
    assert vector.toArray()[32] == pytest.approx((0 - 29.5) / 17.318102, abs=1e-5)
    # An embedding of one's own, and a value column without values.
    own = FeatureSpec(text_columns=("description",), embedding=lambda c, w: [SQLTransformer(
        statement=f"SELECT *, char_length({c}) AS {c}_vec FROM __THIS__")], value_columns=("none",))
    given = rows.withColumn("none", F.lit(None).cast("double"))
    assert add_features(given, fit_features(given, own)).first()["features"][0] in (12.0, 17.0)


def test_errors(spark, items, tmp_path):
    with pytest.raises(ValueError):
        run_suspects(spark, None, None, "train", str(tmp_path))
    with pytest.raises(ValueError):
        run_suspects(spark, items, None, "guess", str(tmp_path))
    with pytest.raises(ValueError):
        train_error_model(items, kind="oracle")
    with pytest.raises(ValueError, match="correct_l1"):
        train_level_models(items.withColumns({"l1_idx": F.lit(9_999), "features": array_to_vector(F.array(F.lit(1.0)))}),
                           ["l1"])
    with pytest.raises(ValueError, match="correct_l2"):
        run_suspects(spark, items.drop("correct_l2"), None, "train", str(tmp_path),
                     SuspectSettings(**SETTINGS, correct_levels=True))
    with pytest.raises(ValueError, match="resume"):
        run_suspects(spark, items, None, "train", str(tmp_path), SuspectSettings(**SETTINGS), resume=True)


def test_many_labels(spark, monkeypatch):
    """More labels than any list of coefficients should hold: the number is learnt bit by bit, also when the tree of
    labels comes in several blocks."""
    rows = spark.range(3000).select(
        "id", F.lit(0).alias("is_error"), (F.col("id") * 7 % 30_000).cast("int").alias("l1_idx"),
        F.lit(0).alias("correct_l1_idx"))
    bits = F.array(*[F.getbit(F.col("l1_idx").cast("long"), F.lit(b)).cast("double") for b in range(15)])
    ready = rows.withColumn("features", array_to_vector(bits))
    monkeypatch.setattr(model, "BLOCK_PATHS", 1100)
    models = train_level_models(ready, ["l1"], epochs=20)
    assert models.bits == (15,) and models.paths.select("block").distinct().count() == 3
    assert models.predict(ready).filter("pred_l1_idx <> l1_idx").count() == 0


def test_tree_holds_the_paths():
    paths = np.array([[1, 5], [1, 2], [3, 5], [0, 0], [1, 2]])
    steps, ordered = model.label_tree(paths, (2, 3))
    assert ordered.tolist() == [[0, 0], [1, 2], [1, 5], [3, 5]]
    for code in range(32):
        node = 0
        for i, step in enumerate(steps):
            node = step[(code >> (4 - i)) & 1, node] if node >= 0 else -1
        found = [[code >> 3, code & 7]] if node >= 0 else []
        assert found == [p for p in ordered.tolist() if p == [code >> 3, code & 7]]
        assert node < 0 or ordered[node].tolist() == found[0]


def test_children_follow_their_parents(spark):
    """The second level alone would point elsewhere; only labels that occur under the first are given."""
    lines = [(0, 1, 1, [1.0, 0.0]), (0, 2, 2, [0.0, 1.0])] * 20
    rows = spark.createDataFrame([(i, e, a, b, a, b, f) for i, (e, a, b, f) in enumerate(lines)],
                                 "id int, is_error int, l1_idx int, l2_idx int, correct_l1_idx int, correct_l2_idx int, f array<double>")
    ready = rows.withColumn("features", array_to_vector("f"))
    models = train_level_models(ready, ["l1", "l2"], epochs=50)
    mixed = ready.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(0.9))))
    found = models.predict(mixed).select("pred_l1_idx", "pred_l2_idx").distinct().collect()
    assert [tuple(r) for r in found] in ([(1, 1)], [(2, 2)])
    assert models.predict(ready).filter("pred_l1_idx <> l1_idx or pred_l2_idx <> l2_idx").count() == 0
    assert models.predict(ready.limit(0)).count() == 0


def test_saved_levels_predict_the_same(spark, tmp_path):
    rows = spark.range(60).select("id", F.lit(0).alias("is_error"), (F.col("id") % 5).cast("int").alias("l1_idx"),
                                  F.lit(0).alias("correct_l1_idx"),
                                  array_to_vector(F.array(*[(F.col("id") % 5 == i).cast("double") for i in range(5)])).alias("features"))
    models = train_level_models(rows, ["l1"], epochs=30)
    models.save(spark, str(tmp_path / "levels"))
    again = model.LevelModels.load(spark, str(tmp_path / "levels"))
    assert again.predict(rows).filter("pred_l1_idx <> l1_idx").count() == 0
    assert np.array_equal(again.weights, models.weights)


def test_bits_are_fitted_without_a_line_for_each(spark):
    """Rows stay as they are however many bits their labels have, and the weights are those of one logistic model over
    a line for each bit of each row."""
    rng = np.random.default_rng(3)
    lines, packed_lines = [], []
    x = np.where(rng.random((40, 4)) < 0.5, 0, rng.normal(size=(40, 4)))
    labels = [[int(a), int(b)] for a, b in zip(rng.integers(0, 4, 40), np.where(rng.random(40) < 0.2, -1, rng.integers(0, 8, 40)))]
    for row, label in zip(x, labels):
        packed_lines.append((*[v if v >= 0 else None for v in label], row.tolist()))
        bits = [(label[0] >> 1) & 1, label[0] & 1, *[(label[1] >> k) & 1 for k in (2, 1, 0)]]
        known = [1, 1, *[int(label[1] >= 0)] * 3]
        for i in range(5):
            if known[i]:
                vector = np.zeros((5, 10))
                vector[i] = [*row, *[b * k if j < i else 0 for j, (b, k) in enumerate(zip(bits, known))], 1]
                lines.append((float(bits[i]), vector.ravel().tolist()))
    long = spark.createDataFrame(lines, "y double, v array<double>").withColumn("x", array_to_vector("v"))
    wanted = LogisticRegression(featuresCol="x", labelCol="y", maxIter=100, regParam=1e-4, family="binomial",
                                fitIntercept=False).fit(long).coefficients.toArray().reshape(5, 10)
    rows = spark.createDataFrame(packed_lines, "__t0 long, __t1 long, f array<double>").withColumn("x", array_to_vector("f"))
    slices = rows.repartition(3).mapInArrow(model._packed((2, 3), "x"), "slice binary").rdd.map(lambda r: bytes(r["slice"]))
    assert slices.map(lambda s: len(model._matrices(s)[1])).sum() == 40
    found = model._fit_bits(slices, 5, 4, 100)
    assert np.abs(found - wanted).max() < 0.05 * np.abs(wanted).max()
