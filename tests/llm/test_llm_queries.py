"""The registered queries: whole results, and their checking SQL where there is some."""

import glob
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwatch.llm import queries as Q

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from check_queries import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS = {"op2_url_filter": "pages"}


def test_all_are_registered():
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
    assert set(Q.ORACLES) <= set(Q.QUERIES) and set(Q.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_checking_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    rows, problem, _ = compare(spark, con, SF, name)
    assert problem is None and rows > 0


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES) - {"op11_conversation_repair"}))
def test_one_row_per_document(spark, name):
    out = Q.QUERIES[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/{ROWS.get(name, 'documents')}.parquet")
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_native_plans_have_no_python(spark):
    for name in ("op1_sharding", "op3_mixing", "op5_paragraph_sketch", "op8_quality_rules"):
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
