"""The registered queries that SQL can express, against it on the small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from fieldpulse.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    got = QUERIES[name](spark, FOLDER)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
