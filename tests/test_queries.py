"""Every registered query against its SQL twin, at the smallest scale."""

from __future__ import annotations

from datetime import date, datetime
from functools import lru_cache

import duckdb
import pytest
from helpers import plan

import __spark_entry__ as contract
from workload import oracles, registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    return v.isoformat() if isinstance(v, (date, datetime)) else str(v)


@pytest.fixture(scope="module", autouse=True)
def shared_tables():
    """Working tables are built once for all queries of this module."""
    kept = registry._Stored
    registry._Stored = lru_cache(kept)
    yield
    registry._Stored = kept


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(oracles.FINAL)
    assert set(registry.queries()) <= set(contract.queries()) and set(oracles.FINAL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    for node in ("Python", "Cartesian", "NestedLoop"):
        assert node not in plan(df)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted(tuple(norm(row[i]) for i in at) for row in cursor.fetchall())
    assert got == expected and got


def test_entry(spark):
    assert contract.entry(spark).count() == 50
