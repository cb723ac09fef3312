"""Every registered query against its oracle, on whole tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_point
import vaultspark.queries as library
from tools.check_oracles import rows_of
from vaultspark.queries.common import TABLES

QUERIES = {name: fn for name, fn in entry_point.queries().items() if name in library.QUERIES}
ORACLES = library.ORACLES


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, db, name):
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == rows_of(columns, result.fetchall())
    assert got
    # No all-pairs joins, no per-row Python.
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin|PythonUDF|ArrowEval|InPandas", plan)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 36
