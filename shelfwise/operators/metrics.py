"""Scores of predictions, class weights, suspects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) for labels 0 and 1: all rows / (2 * rows of the class), an absent class counting as 1."""
    flag = F.col(label).cast("int")
    sums = df.agg(*[F.count(F.when(flag == v, 1)).alias(f"n{v}") for v in (0, 1)])
    total = F.col("n0") + F.col("n1")
    lines = [F.struct(F.lit(v).alias("label"), F.col(f"n{v}").alias("n"),
                      (total / (2.0 * F.greatest(F.col(f"n{v}"), F.lit(1)))).alias("weight")) for v in (0, 1)]
    return sums.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One line: tn, fp, fn, tp, accuracy, precision, recall, f1. A zero denominator gives 0."""
    t, p = F.col(truth).cast("int"), F.col(predicted).cast("int")
    cells = {"tn": (t == 0) & (p == 0), "fp": (t == 0) & (p == 1), "fn": (t == 1) & (p == 0), "tp": (t == 1) & (p == 1)}
    sums = df.agg(*[F.count(F.when(hit, 1)).alias(name) for name, hit in cells.items()])
    tn, fp, fn, tp = (F.col(name) for name in cells)
    return sums.select(
        *cells,
        _share(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def level_accuracy(df: DataFrame, levels: Sequence[tuple[str, str, str]], label: str) -> DataFrame:
    """(level, rows, accuracy) over rows with label 0. ``levels`` holds (name, truth column, prediction column)."""
    right = df.filter(F.col(label).cast("int") == 0)
    sums = right.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(F.col(t).eqNullSafe(F.col(p)).cast("double")).alias(f"a{i}") for i, (_, t, p) in enumerate(levels)],
    )
    lines = F.array(*[F.struct(F.lit(name).alias("level"), F.col("rows"), F.col(f"a{i}").alias("accuracy"))
                      for i, (name, _, _) in enumerate(levels)])
    return sums.filter(F.col("rows") > 0).select(F.explode(lines).alias("line")).select("line.*")


def mismatches(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows whose prediction differs from the label; a missing label differs from everything."""
    return df.filter(F.coalesce(F.col(truth).cast("int") != F.col(predicted).cast("int"), F.lit(True)))


def top_suspects(df: DataFrame, score: str, tie: Sequence[str], k: int = 10) -> DataFrame:
    """The k rows most likely wrong."""
    return df.orderBy(F.desc(score), *tie).limit(k)


def suspects(df: DataFrame, truth: str, predicted: str, score: str, tie: Sequence[str], k: int = 10) -> DataFrame:
    """The mismatches; where there are none, the k most suspicious rows instead."""
    wrong = mismatches(df, truth, predicted)
    return top_suspects(df, score, tie, k) if wrong.isEmpty() else wrong


def for_sink(df: DataFrame, text_columns: Sequence[str], flag_columns: Sequence[str]) -> DataFrame:
    """Cast to the types of the suspects table."""
    casts = {c: F.col(c).cast("string") for c in text_columns}
    casts |= {c: F.col(c).cast("int").cast("boolean") for c in flag_columns}
    return df.withColumns(casts)
