"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from fieldpulse.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return repr(round(float(value), 6) + 0.0)
    return repr(value)


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_each_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert table(got.collect(), got.columns) == table(cursor.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() == 5
