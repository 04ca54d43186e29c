"""Registered queries against their DuckDB oracles on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tidewatch.plans.catalog import QUERIES
from tidewatch.plans.oracle import ORACLE_SQL
from tidewatch.sources.tables import TABLES

from conftest import SF_SMALL


def _norm(v):
    if v is None:
        return "NULL"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "item_id", "cnt", "rank"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _bag(sdf.columns, [tuple(r) for r in sdf.collect()]) == _bag(ocols, rel.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_schema_is_clean(spark, name):
    cols = E.queries()[name](spark, SF_SMALL).columns
    assert len(cols) == len(set(cols))
    assert not [c for c in cols if c.startswith("_")]
