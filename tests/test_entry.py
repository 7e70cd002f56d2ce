"""The driver contract: entry, queries and oracle, checked at sf0.001."""

import os

import pytest

import __spark_entry__ as entry
from snaptally.plans.acceptance import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["tableName", "recordCount", "tableSize"]
    rows = df.collect()
    assert len(rows) > 0
    assert sum(r.recordCount for r in rows) == spark.read.parquet(f"{SF}/events.parquet").count()


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE_SQL) == set(entry.oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("part", "orders", "events", "documents", "pages", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    got_cols = df.columns
    got = df.collect()
    rel = con.sql(entry.oracle_sql()[name])
    exp_cols = rel.columns
    exp = rel.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)

    def canon(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple(repr(r[i]) for i in order) for r in rows)

    assert canon(got_cols, [tuple(r) for r in got]) == canon(exp_cols, exp)

    # no Python in the plan, and no cross join anywhere
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "PythonMapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)
