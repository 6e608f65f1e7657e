from __future__ import annotations

import pytest

from shelfwise.operators import brands as B
from shelfwise.operators.clean import left_over_missing_brands, null_brands, repair_cells, repair_cells_from
from shelfwise.operators.hierarchy import hierarchy_summary, hierarchy_warnings, inconsistent_children
from shelfwise.operators.joins import JoinTuning
from shelfwise.operators.words import word_frequency
from shelfwise.sources.tables import concat_sources

SHUFFLE = JoinTuning(max_rows=0, hot_floor=1, rows_per_salt=1)
BOTH = pytest.mark.parametrize("tuning", [JoinTuning(), SHUFFLE])


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


@BOTH
def test_standard_spelling(spark, tuning):
    cells = ["L'OREAL", "L'OREAL", "L OREAL", "---", "???", None, "", "TEX", "t-e-x"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, b string")
    got = column(B.standardise_by_frequency(df, ["b"], tuning=tuning), "b")
    # Ties go to the smallest text; nothing happens to cells without letters and digits.
    assert got == ["L'OREAL"] * 3 + ["---", "???", None, "", "TEX", "TEX"]


def test_spellings_are_looked_up_by_value(spark):
    df = spark.createDataFrame(list(enumerate(["TEX", "TEX", "t-e-x", None, "", "--"])), "i int, b string")
    got = B.standardise_by_frequency(df, ["b"])
    assert column(got, "b") == ["TEX"] * 3 + [None, "", "--"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan, "normal forms of few values are not made again row by row"


def test_archived_spelling(spark):
    cells = ["L'OREAL", "L'OREAL", "L OREAL", "--", "??", "??", None, "Tex"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, b string")
    assert column(B.root_standardise(df, "b"), "b") == ["L'OREAL"] * 3 + ["??"] * 3 + [None, "Tex"]
    kept = B.root_standardise(df, "b", unify_empty=False)
    assert column(kept, "b")[3:6] == ["--", "??", "??"]


def test_mode(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), ("h", None), ("k", "z"), ("k", "z"), ("k", "a")],
                               "g string, v string")
    assert {r.g: r.mode for r in B.mode_per_group(df, ["g"], "v").collect()} == {"g": "a", "k": "z"}


@BOTH
def test_completion(spark, tuning):
    left = spark.createDataFrame([(0, "1", None, "G"), (1, "2", None, None), (2, None, None, None), (3, "9", "L", None),
                                  (4, "1", "", None)],
                                 "i int, barcode string, local_brand_name string, global_brand_name string")
    first = spark.createDataFrame([("1", "A", 0), ("2", None, 1), (None, "NOCODE", 2)], "code string, brand string, o int")
    second = spark.createDataFrame([("1", "B", 0), ("2", "C", 1)], "code string, brand string, o int")
    reference = concat_sources([first, second], rank="source")
    by_row = B.complete_brand(left, reference, ["source", "o"], tuning=tuning)
    assert column(by_row, "local_brand_name") == ["A", None, "NOCODE", "L", ""]
    assert column(by_row, "global_brand_name") == ["G", None, "NOCODE", None, "A"]
    named = B.complete_brand(left, reference, ["source", "o"], named_only=True, tuning=tuning)
    assert column(named, "local_brand_name") == ["A", "C", "NOCODE", "L", "A"]
    assert by_row.count() == left.count()


@BOTH
def test_mapping_is_applied_once(spark, tuning):
    df = spark.createDataFrame([(0, "A"), (1, "B"), (2, None), (3, "Z")], "i int, b string")
    mapping = spark.createDataFrame([("A", "B"), ("B", "C"), ("B", "D"), (None, "X")], "brand string, standard_brand string")
    assert column(B.replace_by_mapping(df, ["b"], mapping, tuning=tuning), "b") == ["B", "D", None, "Z"]


def test_unify_builds_and_reuses(spark):
    cells = ["LA COURONNE 12", "LA COURONNE", "LA COURONN IMPORT", "TEX", "PETIT BATEAU NUIT"]
    df = spark.createDataFrame([(i, c, c) for i, c in enumerate(cells)],
                               "i int, local_brand_name string, global_brand_name string")
    built, mapping = B.unify_brands(df)
    expected = ["LA COURONNE"] * 3 + ["TEX", "PETIT BATEAU"]
    assert column(built, "local_brand_name") == expected
    assert [tuple(r) for r in mapping.collect()] == [("LA COURONN", "LA COURONNE")]
    assert column(B.unify_brands(df, mapping=mapping)[0], "global_brand_name") == expected
    assert {r.brand: r.freq for r in B.brand_counts(B.root_brands(df)).collect()}["LA COURONNE"] == 4


@BOTH
def test_roots_are_made_once_a_value(spark, tuning):
    cells = ["LA COURONNE 12", "LA COURONNE", "LA COURONN IMPORT", "", None, "12", " TEX  NET "]
    df = spark.createDataFrame([(i, c, None) for i, c in enumerate(cells)],
                               "i int, local_brand_name string, global_brand_name string")
    built, _ = B.unify_brands(df, tuning=tuning)
    assert column(built, "local_brand_name") == ["LA COURONNE"] * 3 + ["", None, "12", "TEX"]
    assert column(built, "global_brand_name") == [None] * 7
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan, "roots of few values are looked up, not made again row by row"


def test_null_brands(spark):
    df = spark.createDataFrame([("SANS MARQUE", "TEX"), (None, "?")], "local_brand_name string, global_brand_name string")
    assert sum(r.left_over for r in left_over_missing_brands(df).collect()) == 2
    assert sum(r.left_over for r in left_over_missing_brands(null_brands(df)).collect()) == 0


def test_repair_all_text_columns(spark):
    df = spark.createDataFrame([("Misi?n", 1, "Acci?n")], "a string, n int, b string")
    assert tuple(repair_cells(df).first()) == ("Misión", 1, "Acción")


def test_hierarchy(spark):
    df = spark.createDataFrame([("P", "x", "m"), ("Q", "x", "m"), ("Q", "x", "n"), (None, "y", "n"), ("P", "y", None),
                                ("P", None, "o"), ("Q", None, "o")], "l1 string, l2 string, l3 string")
    warnings = hierarchy_warnings(df, [("l1", "l2"), ("l2", "l3")])
    found = {(r.child_level, r.child_value): r.parents for r in warnings.collect()}
    assert found == {("l2", "x"): ["P", "Q"], ("l2", None): ["P", "Q"], ("l3", "n"): ["x", "y"]}
    one = inconsistent_children(df, "l1", "l2")
    assert one.columns == ["l2", "Corresponding_l1"] and one.count() == 2


def test_words(spark):
    df = spark.createDataFrame([("French", "Mot"), ("French", "mot"), ("French", "deux mots"), ("German", "Wort"),
                                ("French", None), ("French", "")], "lang string, word string")
    assert [tuple(r) for r in word_frequency(df).collect()] == [("mot", 2)]


@BOTH
def test_repair_from_a_table(spark, tuning):
    df = spark.createDataFrame([(1, "Misi?n", "Acci?n"), (2, None, "Acci?n"), (3, "whole", "unknown?"), (3, "Misi?n", "")],
                               "id int, a string, `b.c` string")
    known = spark.createDataFrame([("Misi?n", "Misión"), ("Misi?n", "Zz"), ("Acci?n", "Acción"), ("whole", "never"),
                                   (None, "no"), ("unknown?", None)], "damaged string, repaired string")
    found = sorted((tuple(r) for r in repair_cells_from(df.withColumnRenamed("b.c", "b"), known, tuning=tuning).collect()), key=repr)
    assert found == sorted([(1, "Misión", "Acción"), (2, None, "Acción"), (3, "whole", "unknown?"), (3, "Misión", "")], key=repr)
    only = repair_cells_from(df.withColumnRenamed("b.c", "b"), known, columns=["a"], tuning=tuning)
    assert only.filter("b = 'Acción'").count() == 0 and only.columns == ["id", "a", "b"]


def test_summary_is_bounded(spark):
    """A child with very many parents lists the first few with the full count; the limit is set before the shuffle."""
    df = spark.range(50_000).selectExpr("'all' as child", "concat('p', lpad(id, 6, '0')) as parent").unionByName(
        spark.createDataFrame([("one", "p"), ("two", "q"), ("two", "p"), ("two", None), (None, "a"), (None, "b")],
                              "child string, parent string"))
    found = hierarchy_summary(df, [("parent", "child")], listed=3)
    rows = {r["child_value"]: (r["n_parents"], r["first_parents"]) for r in found.collect()}
    assert rows == {"all": (50_000, ["p000000", "p000001", "p000002"]), "two": (2, ["p", "q"]), None: (2, ["a", "b"])}
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    assert hierarchy_summary(df.limit(0), [("parent", "child")]).count() == 0
