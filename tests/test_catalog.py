"""Every query with SQL equals DuckDB at the smallest scale."""

import math
import os

import duckdb
import pytest
from conftest import DATA

from folioflow.plans.catalog import ORACLES, QUERIES

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.columns, got.collect()) == table(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_flagship(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
