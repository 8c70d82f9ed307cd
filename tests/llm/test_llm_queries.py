"""Registered queries against their SQL, and those without SQL against the whole table."""

import os

import pytest

from stratica.llm.queries import ORACLES, QUERIES

TABLES = "documents labels pages benchmark conversations".split()


@pytest.fixture(scope="module")
def duck(folder):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(folder):
        pytest.skip("no tables")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    frame = QUERIES[name](spark, folder)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "Arrow" not in plan
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert canonical([tuple(r) for r in frame.collect()], frame.columns) == canonical(result.fetchall(), columns)


@pytest.mark.parametrize("name", ["op1_quality_fm", "op8_toxicity"])
def test_scores_every_document(spark, duck, folder, name):
    rows = QUERIES[name](spark, folder).collect()
    ids = [i for i, in duck.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]
    assert sorted(r["doc_id"] for r in rows) == ids
    cut = 0.3 if name.startswith("op1") else 0.7
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut) for r in rows)
