"""The registered queries: names, plans, and a few results against the SQL statements."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from compare import TABLES, normal
from tidemark.plans.catalog import QUERIES
from tidemark.plans.streamed import STREAMED

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_statement():
    assert QUERIES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - STREAMED.keys()))
def test_plans_have_no_pairwise_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(QUERIES["duplicate_lines"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


@pytest.mark.parametrize("name", ["conform_orders", "failed_rules", "scd2_sliced", "asof_sweep", "recon_order_revenue", "daily_sales", "envelope_decode"])
def test_results_equal_the_statement(spark, name):
    duck = duckdb.connect()
    for t in TABLES.split():
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, df.collect()) == normal(columns, cursor.fetchall())


def test_entry(spark):
    assert driver.entry(spark).columns == ["date_key", "category", "orders", "units", "revenue", "avg_order_value"]
