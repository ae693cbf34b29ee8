"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from perennia.plans.catalog import QUERIES
from perennia.plans.oracle import SQL

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def comparable(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in values]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    frame = QUERIES[name](spark, str(DATA))
    got = comparable(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = database.execute(SQL[name])
    want = comparable([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_queries(spark, name):
    frame = QUERIES[name](spark, str(DATA))
    got = frame.collect()
    assert got
    if "r2" in frame.columns and name != "mlp_regression_deep":
        assert all(r.r2 > 0 for r in got)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
