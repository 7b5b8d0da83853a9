"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from martwell.plans.catalog import QUERIES
from martwell.plans.oracle import ORACLE_SQL
from martwell.sources.testdata import RAW_TABLES

SF = os.environ.get("MARTWELL_TEST_SF", "/root/testdata/sf0.001")


def _norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{round(v, 4):.4f}"
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    lines = sorted("\x1f".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return len(lines), cols, hashlib.sha256("\x1e".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW_TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "category", "total_sales"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert _digest(got) == _digest(want)
