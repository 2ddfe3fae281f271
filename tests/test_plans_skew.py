"""Plan shape and skew: hot keys, the shuffle path of lookup joins, no
Python evaluation, filters and projections reaching the scan."""

import re

from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest
from strata.operators.joins import lookup_join
from strata.plans import gold, layers as L
from strata.plans.queries import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_uses_partial_group_limit_and_survives_hot_key(spark):
    # one key holds a third of the rows
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    out = dedupe_latest(df, ["k"], [F.col("v").desc()])
    assert "WindowGroupLimit" in _plan(out) and "Partial" in _plan(out)
    got = {r["k"]: r["v"] for r in out.collect()}
    assert len(got) == 20001 and got["hot"] == 29997


def test_customer_360_hash_aggregates_its_rows_and_survives_a_hot_customer(spark, sf):
    pos = L.silver_pos(spark, sf)
    hot = pos.withColumn("customer_id", F.when(F.col("quantity") % 3 == 0, "C-hot").otherwise(F.col("customer_id")))
    c = gold.build_customer_360(hot, L.AS_OF)
    p = _plan(c)
    assert "ObjectHashAggregate" not in p
    # rows are combined by (customer, method) before the first of two shuffles
    assert re.search(r"hashpartitioning\(customer_id#\d+, payment_method#\d+[^\n]*\n[^\n]*HashAggregate\(keys=\[customer_id", p)
    assert "BroadcastExchange" not in p.split("hashpartitioning(customer_id")[0]
    n_hot = hot.filter(F.col("customer_id") == "C-hot").count()
    assert c.filter(F.col("customer_bk") == "C-hot").first()["total_orders"] == n_hot


def test_preferred_method_ignores_nulls_and_breaks_ties_downwards(spark, sf):
    pos = L.silver_pos(spark, sf).limit(1)
    rows = [("a", "X"), ("a", "B"), ("a", None), ("a", None), ("b", None), ("c", "Z"), ("c", "Z"), ("c", "A")]
    made = spark.createDataFrame(rows, "customer_id string, payment_method string").withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in pos.schema if f.name not in ("customer_id", "payment_method")})
    got = {r["customer_bk"]: r["preferred_payment_method"] for r in gold.build_customer_360(made, L.AS_OF).collect()}
    assert got == {"a": "B", "b": None, "c": "Z"}


def test_calendar_of_stray_dates_has_no_long_array(spark):
    pos = spark.sql("select to_timestamp_ntz(d) sale_date from values ('0001-01-01'), ('9999-12-31'), (null) t(d)")
    days = gold.build_dim_date(pos)
    assert days.count() == 3652059 and days.select("full_date").distinct().count() == 3652059
    assert gold.build_dim_date(pos.limit(0)).count() == 0


def _without_broadcast(spark, build):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the dimension were large
    try:
        df = build()
        return _plan(df), sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookup_join_spreads_null_keys(spark, sf):
    pos = L.silver_pos(spark, sf)
    dim = L.dim_customer(spark, sf).filter("_is_current").select("customer_sk", "customer_bk")
    build = lambda: lookup_join(pos, dim, "customer_id", "customer_bk").select("transaction_id", "customer_sk")
    plan, rows = _without_broadcast(spark, build)
    assert "_salt" in plan and "SortMergeJoin" in plan
    assert rows == sorted(map(tuple, build().collect()), key=str)
    assert len(rows) == pos.count()  # NULL customers kept, not matched


def test_no_table_rows_go_to_one_partition(spark, sf):
    """Joins are not sized by a limit job, and no plan gathers rows."""
    for name in ("fact_sales", "sales_summary", "customer_360_ext", "customer_360_view", "upsert_orders", "fact_sales_asof"):
        p = _plan(QUERIES[name](spark, sf))
        assert "GlobalLimit" not in p, name
        # only partition sizes of the dense keys and partial aggregates (a row a task) are gathered
        assert all("_pid" in below or "functions=[partial_" in below for below in re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", p)), name


def test_no_python_evaluation_in_registered_queries(spark, sf):
    for name in ("clean_transactions", "customer_360", "fact_sales", "sessionise", "dq_silver",
                 "inventory_snapshot"):
        p = _plan(QUERIES[name](spark, sf))
        assert "PythonUDF" not in p and "EvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_pruning_and_pushdown(spark, sf):
    from strata.plans.queries import _orders_batch2

    p = _orders_batch2(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "o_orderpriority" not in p  # unused column pruned from ReadSchema


def test_point_in_time_join_spreads_null_keys(spark, sf):
    from strata.operators.joins import point_in_time_join
    from strata.plans.queries import _customer_history

    pos = L.silver_pos(spark, sf)
    hist = _customer_history(spark, sf).select("customer_sk", "customer_bk", "_valid_from", "_valid_to")
    build = lambda: point_in_time_join(pos, hist, "customer_id", "customer_bk", "sale_date").select("transaction_id", "customer_sk")
    plan, rows = _without_broadcast(spark, build)
    assert "_salt" in plan
    assert rows == sorted(map(tuple, build().collect()), key=str)
    assert len(rows) == pos.count()
