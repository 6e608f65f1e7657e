from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.config import ALL_MEMBERS, SURPLUS, Dataset, Profile, as_profile, check_declared_parameters, profile
from shelfwise.operators import joins
from shelfwise.operators import validate as V
from shelfwise.operators.joins import JoinTuning

DATA = Dataset("r", "c", "e")
SHUFFLE = JoinTuning(max_rows=0, hot_floor=2, rows_per_salt=1)
SCHEMA = "country_id string, barcode string, non_active_date string, item string"
ROWS = [
    ("1", "1234567", "2024-01-01", "a"), ("1", "1234567", "2024-01-01", "a"),  # equal rows
    ("1", "12345678", "2024-01-01", "b"), ("1", "12345678", None, "c"),  # equal keys
    ("2", None, "2024-02-30", "d"), ("2", None, "x", "e"),  # a missing key is a key
    ("3", "12", "1950-01-01", "f"), ("3", "1234567890", "9999-12-31", "g"),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("tuning", [JoinTuning(), SHUFFLE])
def test_all_members(rows, tuning):
    flagged = V.flag_errors(rows, DATA, profile("supermarket").rules, tuning=tuning)
    reasons = {}
    for r in flagged.collect():
        reasons.setdefault(r["item"], []).append(r["error_reason"])
    row, key, code, date = "all_line_duplicate", "primary_key_duplicate", "wrong_barcode_length", "wrong_date"
    assert reasons == {"a": [[row, key]] * 2, "b": [[key]], "c": [[key]], "d": [[key, date]], "e": [[key, date]],
                       "f": [[code, date]], "g": [[]]}
    clean, excluded = V.clean_rows(flagged), V.excluded_rows(flagged)
    assert clean.columns == rows.columns and clean.count() + excluded.count() == len(ROWS)
    assert excluded.filter("item = 'f'").first()["error_reason"] == "wrong_barcode_length, wrong_date"
    assert excluded.schema.simpleString() == V.excluded_schema(rows.schema).simpleString()


@pytest.mark.parametrize("tuning", [JoinTuning(), SHUFFLE])
def test_surplus(rows, tuning):
    assert [r["item"] for r in V.surplus_duplicate_rows(rows, rows.columns, tuning).collect()] == ["a"]
    surplus = V.surplus_duplicate_keys(rows, ["country_id", "barcode"], tuning=tuning)
    assert sorted(r["item"] for r in surplus.collect()) == ["a", "b", "e"]  # survivors: a, c (null first), d
    report = {r["item"]: r["reasons"] for r in
              V.excluded_report(rows, DATA, profile("supermarket", SURPLUS), tuning=tuning).collect()}
    assert report == {"a": ["all_line_duplicate", "primary_key_duplicate"], "b": ["primary_key_duplicate"],
                      "e": ["primary_key_duplicate"], "f": ["wrong_barcode_length"]}


def test_clean_minus_excluded_drops_every_copy(rows):
    report = V.excluded_report(rows, DATA, profile("supermarket", SURPLUS))
    assert sorted(r["item"] for r in V.without_excluded(rows, report).collect()) == ["c", "d", "g"]


def test_subtraction_moves_rows_once(spark):
    clean = spark.createDataFrame([(1, None), (1, None), (2, "b"), (None, None), (3, "c"), (3, "c")], "n int, t string")
    excluded = spark.createDataFrame([("x", None, 1), ("y", "b", 9), ("z", None, 7), ("x", None, 1)], "why string, t string, n int")
    left = V.without_excluded(clean, excluded)
    assert left.schema == clean.schema
    assert sorted(map(str, map(tuple, left.collect()))) == ["(2, 'b')", "(3, 'c')", "(None, None)"]
    plan = left._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_partitioning_does_not_matter(rows):
    rules = profile("supermarket").rules
    first = sorted(map(str, V.flag_errors(rows, DATA, rules).collect()))
    again = V.flag_errors(rows.repartition(7, F.rand(3)), DATA, rules)
    assert sorted(map(str, again.collect())) == first


def test_several_barcode_columns_repeat_the_reason(spark):
    df = V.with_empty_reasons(spark.createDataFrame([("1", "22"), ("", None)], "a string, b string"))
    assert [r["error_reason"] for r in V.flag_barcode_length(df, ["a", "b"]).collect()] == [
        ["wrong_barcode_length"] * 2, []]


def test_typed_dates(spark):
    days = [dt.date(1962, 1, 1), dt.date(1963, 1, 1), dt.date(9999, 1, 1), dt.date(2101, 1, 1), None]
    df = spark.createDataFrame([(i, d, dt.date(1900, 1, 1)) for i, d in enumerate(days)], "i int, d date, later date")
    assert [r.i for r in V.date_year_rows(df).collect()] == [0, 3]
    flagged = V.flag_dates(V.with_empty_reasons(df), ["d"]).orderBy("i").collect()
    assert [len(r["error_reason"]) for r in flagged] == [1, 0, 0, 1, 0]
    with pytest.raises(ValueError):
        V.date_year_rows(df.select("i"))


def test_report_without_rules_is_empty(rows):
    assert V.excluded_report(rows, DATA, Profile((), ())).count() == 0


def test_profiles():
    assert profile("movie", ALL_MEMBERS).standard_columns == ()
    assert "date_format" not in profile("supermarket", SURPLUS).rules
    assert as_profile({"standard_columns": None, "rules": ["duplicate_row"]}) == Profile((), ("duplicate_row",))
    with pytest.raises(ValueError):
        profile("cinema")
    with pytest.raises(ValueError):
        as_profile({"rules": ["no_such_rule"]})
    with pytest.raises(ValueError):
        DATA.table("other")
    assert DATA.table("raw") == "r"


def test_declared_parameters():
    check_declared_parameters(["a"], [{"id": "t", "trigger": {"x": "a"}}, {"id": "u", "trigger": None}])
    with pytest.raises(ValueError):
        check_declared_parameters(["a"], [{"id": "t", "trigger": {"x": "b"}}])


@pytest.mark.parametrize("hot_floor", [100, 3])
def test_many_repeated_keys_move_the_rows_once(spark, monkeypatch, hot_floor):
    """Too many repeated keys to broadcast: the rows are not written and joined, and hot keys are still told apart."""
    lines = [(k, n, v) for k, n in ((1, 1), (None, 2), (3, None), (4, 0)) for v in ([5, 5, None, 2] if k == 1 else [7, 6][:n])]
    df = spark.createDataFrame(lines, "k int, n int, v int")
    tuning = JoinTuning(max_rows=0, hot_floor=hot_floor)
    if hot_floor == 100:
        monkeypatch.setattr(joins, "salted_join", lambda *_: pytest.fail("rows were joined to their keys"))
    flagged = V.flag_duplicate_keys(V.with_empty_reasons(df), ["k", "n"], tuning)
    assert flagged.count() == len(lines)
    twice = {(r["k"], r["n"]) for r in flagged.filter(F.size("error_reason") > 0).collect()}
    assert twice == {(1, 1), (None, 2), (3, None)}
    assert flagged.filter(F.size("error_reason") == 0).count() == 0
    surplus = V.surplus_duplicate_keys(df, ["k", "n"], tuning=tuning).collect()
    assert sorted(map(repr, map(tuple, surplus))) == sorted(map(repr, [
        (1, 1, 2), (1, 1, 5), (1, 1, 5), (None, 2, 7), (3, None, 7)]))
