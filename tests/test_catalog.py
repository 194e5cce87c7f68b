"""Every registered query against its SQL on the smallest tables, and a metamorphic check."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from orgcurate import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, tables, name):
    df = catalog.QUERIES[name](spark, SMALL)
    cols = ", ".join(f'"{c}"' for c in sorted(df.columns))
    got = sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    want = sorted(repr(r) for r in tables.sql(f"select {cols} from ({catalog.SQL[name]})").fetchall())
    assert got == want


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_all_queries_are_callable():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_sample_is_stable(spark):
    a = catalog.QUERIES["sample_stable"](spark, SMALL).collect()
    b = catalog.QUERIES["sample_stable"](spark, SMALL).collect()
    assert a == b and len(a) == 500


def test_no_cartesian_product_in_name_search(spark):
    plan = catalog.QUERIES["in_release_name"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
