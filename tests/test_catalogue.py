"""Every named query against its SQL, and the shape of the plans."""

import re

import duckdb
import pytest
from conftest import SMALL, plan_of

import __spark_entry__ as entry_point
import check

from tapewright import catalogue

# The queries of the training-data folder have tests of their own.
QUERIES = {name: q for name, q in entry_point.queries().items() if name in catalogue.QUERIES}
SQL = {name: text for name, text in entry_point.oracle_sql().items() if name in catalogue.QUERIES}
# These write and read back their own files, so there is no lazy plan of the whole.
EAGER = re.compile(r"^stream_|_roundtrip$|_into_table$|^dual_sink$|^load_|^run_|^long_titles$|^reset_stored|^op\d+_|^pipeline$")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in check.TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    assert check.compare(spark, tables, name, QUERIES[name], SQL[name], SMALL).startswith("ok")


def test_entry(spark):
    assert entry_point.entry(spark).count() == 50


def test_no_nested_loops_and_few_python_steps(spark):
    for name, fn in QUERIES.items():
        if EAGER.search(name):
            continue
        plan = plan_of(fn(spark, SMALL))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
        assert ("InArrow" in plan) == name.endswith("_corr") or name == "price_correlation", name


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["company_drilldown"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(o_custkey,7\)", plan)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES["counts_by_form"](spark, SMALL))).group(1)
    assert read == "o_orderpriority:string"
