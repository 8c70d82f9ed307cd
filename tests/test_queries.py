"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from stratica.proofs import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no tables")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr("nan" if r[i] != r[i] else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert canonical([tuple(r) for r in frame.collect()], frame.columns) == canonical(result.fetchall(), columns)


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert len(frame.columns) == 65 and frame.count() > 0
