"""Every query with SQL against DuckDB on the same tables, and the others for their shape."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from corpuslens.plans.queries import ORACLES, QUERIES

from .conftest import SF, plain


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.sql(f"create view {os.path.splitext(f.name)[0]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df, want = QUERIES[name](spark, SF), duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    rows = sorted((tuple(map(plain, r)) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall()), key=repr)
    assert got == rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
