"""Every registered query against its checking SQL on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwatch.checks import ORACLES, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_queries import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def test_every_query_has_checking_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, problem, _ = compare(spark, con, SF, name)
    assert problem is None and rows > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "date" and df.count() > 0


def test_entry_counts_to_the_last_day(spark, con):
    last = con.execute("select max(cast(ts as date)) from events").fetchone()[0]
    assert entry.entry(spark).agg({"date": "max"}).first()[0] == last
