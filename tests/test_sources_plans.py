from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.config import ALL_MEMBERS, SURPLUS, Dataset, profile
from shelfwise.plans.cleaning import run_clean_and_unify, run_clean_and_validate
from shelfwise.sources import tables as S
from workload.base import cleaned, products


def test_ragged_csv(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("is_error,l1,correct_l1,brand\n0,NO FOOD,,TEX\n1,FOOD,NO FOOD,\n0,SHORT\n", encoding="utf8")
    schema = "is_error int, l1 string, correct_l1 string, brand string"
    assert [tuple(r) for r in S.read_csv(spark, str(path), schema).collect()] == [
        (0, "NO FOOD", None, "TEX"), (1, "FOOD", "NO FOOD", None), (0, "SHORT", None, None)]
    reported = S.read_csv(spark, str(path), schema, keep_corrupt=True).collect()
    assert [r["_corrupt_record"] for r in reported] == [None, None, "0,SHORT"]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"lang": "French", "word": "a", "more": [1]}\n{"word": "b"}\n', encoding="utf8")
    assert [tuple(r) for r in S.read_json_lines(spark, str(path)).collect()] == [("French", "a"), (None, "b")]


def test_replace_reads_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_table(spark.range(5).toDF("n"), path)
    S.write_table(S.read_table(spark, path).withColumn("n", F.col("n") + 10), path, "n string")
    assert sorted(r.n for r in S.read_table(spark, path).collect()) == ["10", "11", "12", "13", "14"]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert sorted(p.name for p in (tmp_path / "t" / "_versions").iterdir() if p.name[0] != ".") == ["ok1", "v1"]
    S.append_rows(spark.createDataFrame([("9",)], "n string"), path)
    assert S.read_table(spark, path).count() == 6


@pytest.mark.parametrize("plain", [True, False])
@pytest.mark.parametrize("step", ["write", "_complete", "_clear"])
def test_a_replacement_that_dies_leaves_a_whole_table(spark, tmp_path, monkeypatch, step, plain):
    path = str(tmp_path / "t")
    old, new = spark.range(5).toDF("n"), spark.range(7).toDF("n")
    if plain:
        old.write.parquet(path)
    else:
        for _ in range(2):
            S.write_table(old, path)

    def die(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        if step == "write":
            new = new.withColumn("n", F.when(F.col("n") == 6, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
        else:
            broken.setattr(S, step, die)
        with pytest.raises(Exception, match="lost"):
            S.write_table(new, path)
    assert S.read_table(spark, path).count() == (7 if step == "_clear" else 5)
    assert not S.create_if_absent(spark, path, "n long")
    S.write_table(spark.range(3).toDF("n"), path)
    assert S.read_table(spark, path).count() == 3
    assert [p.name for p in (tmp_path / "t").iterdir() if p.name[0] != "."] == ["_versions"]
    assert len([p for p in (tmp_path / "t" / "_versions").iterdir() if p.name[0] != "."]) == 2


def test_the_first_write_that_dies_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        S.write_table(bad, path)
    assert S.create_if_absent(spark, path, "n long")
    S.append_rows(spark.range(2).toDF("n"), path)
    assert S.read_table(spark, path).count() == 2


@pytest.mark.parametrize("step", ["SET LOCATION", "RENAME TO shelfwise_swap__old", "RENAME TO shelfwise_swap$"])
def test_a_catalogue_replacement_that_dies(spark, monkeypatch, step):
    name = "shelfwise_swap"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    changed = "RENAME" in step
    run = type(spark).sql

    def die(self, query, *args, **kwargs):
        if re.search(step, query):
            raise OSError("lost")
        return run(self, query, *args, **kwargs)

    try:
        S.write_table(spark.range(5).toDF("n"), name)
        new = spark.range(7).toDF("n").withColumn("more", F.lit(1)) if changed else spark.range(7).toDF("n")
        with monkeypatch.context() as broken:
            broken.setattr(type(spark), "sql", die)
            with pytest.raises(OSError):
                S.write_table(new, name)
        # Between the two renames the new table is whole, and the next read puts it in place.
        assert S.read_table(spark, name).count() == (7 if step.endswith("$") else 5)
        S.write_table(S.read_table(spark, name).filter("n > 2").select("n"), name)
        S.append_rows(spark.range(1).toDF("n"), name)
        assert S.read_table(spark, name).count() == (5 if step.endswith("$") else 3)
    finally:
        for line in spark.sql("SHOW TABLES").collect():
            if line["tableName"].startswith(name):
                spark.sql(f"DROP TABLE {line['tableName']}")


def test_catalogue_tables(spark):
    name = "shelfwise_test_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        assert S.create_if_absent(spark, name, "id string not null, n long")
        assert not S.create_if_absent(spark, name, "id string not null, n long")
        S.append_rows(spark.createDataFrame([("a", 1)], "id string, n long"), name)
        S.append_rows(spark.createDataFrame([("b", 2)], "id string, n long"), name)
        S.write_table(S.read_table(spark, name).filter("n > 1"), name)
        assert [tuple(r) for r in S.read_table(spark, name).collect()] == [("b", 2)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_concat_and_split(spark):
    a, b = spark.createDataFrame([("x", 1)], "c string, n int"), spark.createDataFrame([("y",)], "c string")
    assert sorted(map(tuple, S.concat_sources([a, b], "rank").collect())) == [("x", 1, 0), ("y", None, 1)]
    train, test = S.tag_split(None, b)
    assert train.first()["split"] == "train" and test.first()["split"] == "test"


def test_text_sinks(spark, tmp_path):
    counts = spark.createDataFrame([("mot", 2)], "word string, freq long")
    S.write_word_list(counts, str(tmp_path / "w"))
    assert spark.read.text(str(tmp_path / "w")).first()[0] == "mot 2"
    S.write_csv_with_index(spark.createDataFrame([("b",), ("a",)], "c string"), str(tmp_path / "i"), ["c"])
    rows = S.read_csv(spark, str(tmp_path / "i"), "index long, c string").collect()
    assert sorted(map(tuple, rows)) == [(0, "a"), (1, "b")]


@pytest.fixture
def dataset(spark, tables, tmp_path):
    data = Dataset(*[str(tmp_path / n) for n in ("raw", "clean", "excluded")])
    raw = products(spark, tables).withColumn("made_on", F.lit("2020-01-01").cast("date"))
    S.write_table(raw, data.raw)
    return data


def test_validate_plan_keeps_every_row(spark, dataset):
    clean, excluded = run_clean_and_validate(spark, dataset, profile("supermarket", ALL_MEMBERS))
    raw = S.read_table(spark, dataset.raw)
    assert clean + excluded == raw.count() and clean and excluded
    assert S.read_table(spark, dataset.clean).columns == raw.columns
    assert S.read_table(spark, dataset.excluded).columns == [*raw.columns, "error_reason"]
    assert S.read_table(spark, dataset.clean).filter("item_desc rlike '[a-zé]'").count() == 0


def test_products_lie_evenly(spark, tables):
    sizes = [r["count"] for r in products(spark, tables).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 207 and len(sizes) == 4 and max(sizes) < 2 * min(sizes)


def test_unify_plan(spark, dataset, tmp_path):
    reference = spark.createDataFrame([("0000000000011", "FOUND", 1)], "code string, brand string, o int")
    mapping = str(tmp_path / "mapping")
    rules = profile("movie", SURPLUS)
    warnings = run_clean_and_unify(spark, dataset, reference, ["o"], mapping, reuse_mapping=False, rules=rules)
    clean = S.read_table(spark, dataset.clean)
    assert clean.count() == S.read_table(spark, dataset.raw).count()
    assert clean.filter("local_brand_name = 'FOUND'").count() == 1
    assert S.read_table(spark, mapping).columns == ["brand", "standard_brand"]
    assert warnings.count() > 0
    report = S.read_table(spark, dataset.excluded)
    assert report.columns[0] == "reasons" and report.count() > 0
    kept = clean.distinct().count() - report.count()
    run_clean_and_unify(spark, dataset, reference, ["o"], mapping, rules=rules, drop_excluded=True)
    assert S.read_table(spark, dataset.clean).count() == kept


def test_products_are_worked_on_by_all_tasks(spark, tables):
    """The part table is one small file; its rows are dealt to all tasks before they are cleaned."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = cleaned(spark, tables, with_id=True).filter("row_id % 3 = 0").withColumn("task", F.spark_partition_id())
    shares = [line["count"] for line in own.groupBy("task").count().collect()]
    assert len(shares) >= tasks and max(shares) < 2 * sum(shares) / tasks
