"""Every registered query equals its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import re

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "customer_bk" in df.columns


def test_every_query_has_an_oracle():
    own = {q for q in E.queries() if q != "pipeline" and not re.match(r"op\d+_", q)}
    missing = own - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", sorted(q for q in E.oracle_sql() if not re.match(r"op\d+_", q)))
def test_matches_duckdb(spark, sf, name):
    res = compare(spark, sf, [name], verbose=True)[name]
    assert res[0] == "MATCH", res


@pytest.mark.parametrize("name", ["fact_sales", "sales_summary", "fact_sales_asof", "upsert_orders",
                                  "inventory_snapshot", "fk_orphans", "customer_360_view"])
def test_matches_duckdb_without_broadcast(spark, sf, name):
    """The shuffle-join paths (what large dimensions get) give the same rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = compare(spark, sf, [name], verbose=True)[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert res[0] == "MATCH", res
