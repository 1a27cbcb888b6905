"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as driver
from rivulet.plans.catalog import all_queries
from rivulet.plans.oracle import all_oracles

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted(repr(tuple(cell(r[i]) for i in order)) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(got, df.columns) == normal(result.fetchall(), columns)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_no_query_crosses_or_leaves_the_jvm(spark):
    for name, build in QUERIES.items():
        plan = build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert word not in plan, (name, word)
