"""Every registered query that has checking SQL against it."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from crmweave.testbed.registry import CHECKS, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, checker, name):
    df = contract.queries()[name](spark, str(DATA))
    cursor = checker.execute(contract.oracle_sql()[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, df.collect()) == want

