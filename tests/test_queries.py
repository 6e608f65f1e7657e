"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="the given tables are not here")


def same_form(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return tuple(map(same_form, value)) if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def test_registry():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 60


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, sql, name):
    frame = contract.queries()[name](spark, str(TABLES))
    columns = sorted(frame.columns)
    rows = Counter(tuple(same_form(r[c]) for c in columns) for r in frame.collect())
    assert rows, "an empty result proves nothing"
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        return
    found = sql.execute(oracle)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = Counter(tuple(same_form(dict(zip(names, line))[c]) for c in columns) for line in found.fetchall())
    assert rows == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
