from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features as X
from shelfwise.operators import labels as L
from shelfwise.operators import metrics as M
from shelfwise.operators.joins import JoinTuning

SHUFFLE = JoinTuning(max_rows=0, hot_floor=1, rows_per_salt=1)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(3, "B", "x"), (1, "A", None), (2, "B", "y"), (4, None, "<UNK>"), (5, "C", "x")],
                                 "row_id int, l1 string, l2 string")


def test_label_map_counts_by_first_appearance(rows):
    found = {(r.column_name, r.value): r.idx for r in L.build_label_map(rows, "row_id", ["l1", "l2"]).collect()}
    assert found == {("l1", "<UNK>"): 0, ("l1", "A"): 1, ("l1", "B"): 2, ("l1", "C"): 3,
                     ("l2", "<UNK>"): 0, ("l2", "y"): 1, ("l2", "x"): 2}


@pytest.mark.parametrize("tuning", [JoinTuning(), SHUFFLE])
def test_encode_and_decode(spark, rows, tuning):
    learned = L.build_label_map(rows, "row_id", ["l1", "l2"])
    fresh = spark.createDataFrame([(1, "B", "new", "A"), (2, None, "x", None), (3, "A", "y", "C")],
                                  "row_id int, l1 string, l2 string, correct_l1 string")
    coded = L.encode_labels(fresh, learned, ["l1", "l2"], tuning=tuning)
    coded = L.encode_labels(coded, learned, ["l1"], prefix="correct_", tuning=tuning)
    got = [(r.l1_idx, r.l2_idx, r.correct_l1_idx) for r in coded.orderBy("row_id").collect()]
    assert got == [(2, 0, 1), (0, 2, 0), (1, 1, 3)]
    target = coded.select("row_id", L.level_target("l1", F.col("row_id") == 1).alias("t")).orderBy("row_id")
    assert [r.t for r in target.collect()] == [1, 0, 1]
    guessed = coded.select("row_id", F.col("l1_idx").alias("pred_l1_idx"), (F.col("l2_idx") + 7).alias("pred_l2_idx"))
    decoded = L.decode_labels(guessed, learned, ["l1", "l2"], tuning=tuning).orderBy("row_id").collect()
    assert [(r.pred_l1, r.pred_l2) for r in decoded] == [("B", None), ("<UNK>", None), ("A", None)]


def test_missing_label_column(rows):
    with pytest.raises(ValueError):
        L.build_label_map(rows, "row_id", ["nope"])


def test_category_index(rows):
    found = {(r.column_name, r.value): r.idx for r in L.category_index(rows, ["l1"]).collect()}
    assert found == {("l1", "A"): 0, ("l1", "B"): 1, ("l1", "C"): 2, ("l1", "nan"): 3}


def test_standard_scores(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [(r.a_z, r.b_z) for r in X.standard_scores(df, ["a", "b"]).orderBy("a").collect()] == [(-1, 0), (1, 0)]


def scored(spark, lines):
    return spark.createDataFrame(lines, "id int, is_error int, pred_is_error int, pred_probs double")


def test_confusion_and_weights(spark):
    df = scored(spark, [(1, 1, 1, .9), (2, 1, 0, .2), (3, 0, 0, .1), (4, 0, 1, .6), (5, 0, 0, .1)])
    line = M.confusion(df, "is_error", "pred_is_error").first()
    assert (line.tn, line.fp, line.fn, line.tp) == (2, 1, 1, 1)
    assert (line.accuracy, line.precision, line.recall, line.f1) == (0.6, 0.5, 0.5, 0.5)
    weights = {r.label: r.weight for r in M.class_weights(df, "is_error").collect()}
    assert weights == {0: pytest.approx(5 / 6), 1: pytest.approx(5 / 4)}
    none = M.confusion(df.filter("id = 3"), "is_error", "pred_is_error").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    lonely = {r.label: r.weight for r in M.class_weights(df.filter("is_error = 0"), "is_error").collect()}
    assert lonely == {0: 0.5, 1: 1.5}


def test_level_accuracy(spark):
    df = spark.createDataFrame([(0, 1, 1, 2, 2), (0, 1, 2, 3, 3), (1, 1, 9, 9, 8)], "e int, a int, pa int, b int, pb int")
    levels = [("a", "a", "pa"), ("b", "b", "pb")]
    assert {r.level: (r.rows, r.accuracy) for r in M.level_accuracy(df, levels, "e").collect()} == {
        "a": (2, 0.5), "b": (2, 1.0)}
    assert M.level_accuracy(df.filter("e = 1"), levels, "e").count() == 0


def test_suspects(spark):
    df = scored(spark, [(1, 1, 1, .9), (2, None, 0, .2), (3, 0, 1, .7)])
    assert sorted(r.id for r in M.suspects(df, "is_error", "pred_is_error", "pred_probs", ["id"]).collect()) == [2, 3]
    right = scored(spark, [(i, 0, 0, i % 3 / 10) for i in range(20)])
    top = M.suspects(right, "is_error", "pred_is_error", "pred_probs", ["id"], k=3).collect()
    assert [r.id for r in top] == [2, 5, 8]
    cast = M.for_sink(df, ["id"], ["is_error", "pred_is_error"])
    assert dict(cast.dtypes) == {"id": "string", "is_error": "boolean", "pred_is_error": "boolean",
                                 "pred_probs": "double"}
