from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import copies
from shelfwise.operators.joins import JoinTuning, attach, hot_keys, salted_join
from shelfwise.operators.materialise import settle, shared_dir
from shelfwise.operators.numbering import number_in_order

SHUFFLE = JoinTuning(max_rows=0, hot_floor=20, rows_per_salt=10)


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def skewed(spark):
    """Half of the rows have key 'hot' or no key at all."""
    return spark.range(0, 400, numPartitions=4).select(
        F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 4 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("key"),
        (F.col("id") % 50).alias("v"))


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("hot", 1), (None, 2), ("k1", 3), ("k2", 4), ("unused", 5)], "code string, found int")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_both_routes_agree(spark, skewed, lookup, how):
    small = attach(skewed, lookup, {"key": "code"}, how)
    large = attach(skewed, lookup, {"key": "code"}, how, SHUFFLE)
    plain = skewed.join(lookup, F.col("key").eqNullSafe(F.col("code")), how).drop("code")
    assert bag(small) == bag(large) == bag(plain)


def test_routes_are_planned_as_meant(spark, skewed, lookup):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = attach(skewed, lookup, {"key": "code"})._jdf.queryExecution().executedPlan().toString()
        large = attach(skewed, lookup, {"key": "code"}, tuning=SHUFFLE)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small and "hashpartitioning" not in small
    assert "SortMergeJoin" in large and "NestedLoop" not in large


def test_hot_rows_are_spread(spark, skewed, lookup):
    """With salts the rows of one key meet in several tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach(skewed, lookup, {"key": "code"}, tuning=SHUFFLE).withColumn("task", F.spark_partition_id())
        tasks = {r.key: r.n for r in joined.groupBy("key").agg(F.count_distinct("task").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks["hot"] > 1 and tasks[None] > 1


def test_hot_key_list_is_bounded(spark, skewed):
    assert max(r["__salts"] for r in hot_keys(skewed, ["key"], JoinTuning(hot_floor=20, rows_per_salt=30)).collect()) == 4
    assert hot_keys(skewed, ["key"], JoinTuning(hot_floor=1)).count() == skewed.select("key").distinct().count()
    assert hot_keys(skewed, ["key"], JoinTuning(hot_floor=101)).count() == 0


def test_settle_measures(spark, lookup):
    kept = settle(lookup)
    assert kept.measure()[0] == 5
    assert kept.fits(5, 10_000) and not kept.fits(4, 10_000) and not kept.fits(5, 10)
    assert kept.path.startswith(shared_dir(spark))
    assert kept.narrowed(kept.frame.limit(1)).measure() == kept.measure()


def test_repeated_rows_and_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, 1), (None, 1), ("b", 2)], "x string, y int")
    for tuning in (JoinTuning(), SHUFFLE):
        rows = {(r.x, r.y): r.copies for r in copies.repeated_rows(df, ["x", "y"], tuning=tuning).frame.collect()}
        assert rows == {("a", 1): 2, (None, 1): 2}
    assert {r.x: r.copies for r in copies.repeated_keys(df, ["x"]).collect()} == {"a": 3, None: 2}
    survivors = {r.x: tuple(r.survivor) for r in copies.key_survivors(df, ["x"], ["x", "y"]).collect()}
    assert survivors == {"a": ("a", None), None: (None, 1)}


def test_copies_are_attached_without_moving_whole_rows(spark):
    # The repeated rows are too large to broadcast, their hashes are not.
    df = spark.createDataFrame([(f"{i % 60}" + "x" * 1000, i % 60) for i in range(100)], "x string, y int")
    got = copies.attach_row_copies(df, ["x", "y"], "n", JoinTuning(max_bytes=10_000))
    assert Counter(r.n for r in got.collect()) == {2: 80, None: 20}
    assert not any("/base-" in f for f in got.inputFiles()), "the rows were written and shuffled to meet their copies"


@pytest.mark.parametrize("tuning", [JoinTuning(), SHUFFLE])
def test_rows_that_share_a_hash_are_told_apart(spark, monkeypatch, tuning):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, 1), (None, 1), (None, 1), ("b", 2)], "x string, y int")
    monkeypatch.setattr(copies.F, "xxhash64", lambda *c: F.length(F.coalesce(F.col("x"), F.lit("?"))).cast("long"))
    got = copies.attach_row_copies(df, ["x", "y"], "n", tuning)
    assert bag(got) == {(2, "a", 1): 2, (None, "a", None): 1, (3, None, 1): 3, (None, "b", 2): 1}


def test_expand_copies_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(copies, "COPIES_PER_CHUNK", 7)
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 8), ("d", 50), ("e", 0)], "x string, n long")
    written = Counter(r.x for r in copies.expand_copies(df, "n").collect())
    assert written == {"a": 1, "b": 7, "c": 8, "d": 50}


def test_numbering(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), ((F.col("id") * 37) % 200).alias("o"))
    numbered = number_in_order(df, "g", ["o"], "n", first=0).collect()
    for g in range(3):
        ordered = sorted((r.o, r.n) for r in numbered if r.g == g)
        assert [n for _, n in ordered] == list(range(len(ordered)))


def test_salted_join_directly(spark, skewed, lookup):
    joined = salted_join(skewed, lookup, ["key"], ["code"], "left", SHUFFLE)
    assert joined.count() == skewed.count()
