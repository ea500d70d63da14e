"""Every query with SQL, on the smallest sample tables, against DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _cell(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_query_equals_sql(spark, name):
    got = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(map(_cell, r)) for r in got.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted((tuple(map(_cell, r)) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert {"flight", "frame", "selected", "reject_reason"} == set(entry.entry(spark).columns)
