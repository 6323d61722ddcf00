"""Every registered query against its SQL in DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF_DIR, plan_of
from fareloom.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()
# All pairs, and rows that leave the JVM.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]
# The queries over the training-data tables have their own tests.


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(0.0 if value == 0 else value)
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    cursor = duck.execute(ORACLES[key])
    expected = _table([d[0] for d in cursor.description], cursor.fetchall())
    found = _table(df.columns, df.collect())
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    plan = plan_of(df)
    assert not [node for node in UNWANTED if node in plan]


def test_every_query_has_sql_and_is_handed_out():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
