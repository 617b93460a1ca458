"""Every registered query against the same result in SQL."""

from __future__ import annotations

import math
from decimal import Decimal

import pytest
from conftest import TESTDATA

import __spark_entry__ as registry

duckdb = pytest.importorskip("duckdb")
SF = TESTDATA / "sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    yield con
    con.close()


def text(value) -> str:
    """A value as comparable text; numbers keep their type's form, so 1 differs from 1.0."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        raise AssertionError("decimals do not compare across engines")
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(text(r[i]) for i in order) for r in rows))


def test_each_query_has_sql():
    own = {n for n in registry.queries() if n.startswith("q_")}
    assert own <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_result(spark, checker, name):
    found = registry.queries()[name](spark, str(SF))
    expected = checker.execute(registry.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    ours, theirs = table(found.columns, found.collect()), table(names, expected.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert registry.entry(spark).count() > 0
