"""Retail feeds derived from the driver's star-schema tables.

The jobs in this library work on retail feeds (POS transactions, inventory
movements, customers, products, stores, clickstream). The test tables are
TPC-H-like, so each feed is a projection of them; dirt that real feeds carry
(bad numbers, bad dates, missing ids, mixed-case codes) is injected by key
arithmetic, so the same rule can be written in SQL for the DuckDB oracle.
Every rule touches every row: no row is dropped or sampled here.

All raw feeds are strings, as a CSV landing would produce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Payment method per (l_returnflag || l_linestatus); spacing and
# case are deliberate dirt, CHEQUE is deliberately outside the valid set.
PAYMENT_BY_FLAGS: list[tuple[str, str]] = [
    ("AF", " cash"),
    ("AO", "Card "),
    ("NF", "digital"),
    ("NO", "voucher"),
    ("RF", "CARD"),
    ("RO", "CHEQUE"),
]

# Dirt moduli on keys. Copies of one transaction differ in part
# and supplier, so some ids have a good and a rejected or dateless copy.
NULL_STORE_MOD = 101      # store_id NULL
BAD_QTY_MOD = 97          # quantity 'bad'
ZERO_QTY_MOD = 89         # quantity '0'
BAD_DATE_MOD = 83         # sale_date 'not-a-date'
ANON_CUSTOMER_MOD = 50    # customer_id NULL (anonymous sale)
BAD_MOVEMENT_MOD = 79     # movement_type 'XX'
REPEAT_CLICK_MOD = 23     # events delivered twice
ANON_CLICK_MOD = 29       # events without a customer
WAREHOUSES = 5            # warehouse_id = 'W' || (l_suppkey % 5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _payment(flags):
    expr = None
    for k, v in PAYMENT_BY_FLAGS:
        expr = F.when(flags == k, v) if expr is None else expr.when(flags == k, v)
    return expr


def _whole_str(c):
    return c.cast("bigint").cast("string")


def raw_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POS transaction feed: one row per lineitem, keyed 'T<order>-<line>'.

    lineitem repeats (l_orderkey, l_linenumber), so the feed has natural
    duplicate transaction ids."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    # orders grows with the data and has no proven size bound, so it is never
    # broadcast (an estimate-based auto-broadcast would also pin all per-row
    # work of this feed into the scan tasks of lineitem): sort-merge join.
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("merge")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    ok = F.col("l_orderkey")
    return j.select(
        F.concat(F.lit("T"), ok, F.lit("-"), F.col("l_linenumber")).alias("transaction_id"),
        F.when(ok % NULL_STORE_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("S"), F.col("l_suppkey"))).alias("store_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
        F.when(F.col("o_custkey") % ANON_CUSTOMER_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), F.col("o_custkey"))).alias("customer_id"),
        F.when((ok + F.col("l_partkey")) % BAD_QTY_MOD == 0, "bad").when((ok + F.col("l_partkey")) % ZERO_QTY_MOD == 0, "0")
        .otherwise(_whole_str(F.col("l_quantity"))).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("unit_price"),
        F.when((ok + F.col("l_suppkey")) % BAD_DATE_MOD == 0, "not-a-date")
        .otherwise(F.col("l_shipdate").cast("string")).alias("sale_date"),
        _payment(F.concat(F.col("l_returnflag"), F.col("l_linestatus"))).alias("payment_method"),
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory movement feed: returned lines come back in, the rest go out."""
    li = table(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey")
    return li.select(
        F.concat(F.lit("M"), ok, F.lit("-"), F.col("l_linenumber")).alias("movement_id"),
        F.concat(F.lit("W"), F.col("l_suppkey") % WAREHOUSES).alias("warehouse_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
        F.when((ok + F.col("l_partkey")) % BAD_MOVEMENT_MOD == 0, "XX")
        .when(F.col("l_returnflag") == "R", "in ")
        .otherwise("OUT").alias("movement_type"),
        _whole_str(F.col("l_quantity")).alias("quantity"),
        F.col("l_shipdate").cast("string").alias("movement_date"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer master feed with synthesised contact data (the PII to hash).

    signup_date is the customer's first order date (NULL without orders)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    first = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    # first orders are customer-sized: sort-merge join
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(
        first.hint("merge"), c.c_custkey == first.o_custkey, "left"
    )
    k = F.col("c_custkey")
    return j.select(
        F.concat(F.lit("C"), k).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("customer"), k, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), k).alias("phone"),
        F.concat(k, F.lit(" Market Street")).alias("address"),
        F.concat(F.col("n_name"), F.lit("/"), F.col("c_mktsegment")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("first_order").cast("string").alias("signup_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master: name, category (p_type), sub-category (p_brand), cost."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_cost"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store master: one store per supplier; country and region from geography."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(
        r, F.col("n_regionkey") == r.r_regionkey, "left"
    )
    return j.select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.lit(None).cast("string").alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events keyed by event id; the timestamp stays typed (NTZ). Some
    events are delivered twice, some have no customer."""
    e = table(spark, sf_dir, "events")
    again = F.when(F.col("event_id") % REPEAT_CLICK_MOD == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    e = e.withColumn("_copy", F.explode(again))
    return e.select(
        F.concat(F.lit("E"), F.col("event_id")).alias("event_id"),
        F.when(F.col("event_id") % ANON_CLICK_MOD != 0, F.concat(F.lit("C"), F.col("user_id"))).alias("customer_id"),
        F.concat(F.lit("/"), F.col("event_type")).alias("page_url"),
        F.col("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.lit(None).cast("string").alias("device_type"),
    )


def clickstream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream as a JSON-lines landing would carry it (timestamp as text)."""
    return clickstream(spark, sf_dir).select(
        "event_id",
        F.lit(None).cast("string").alias("session_id"),
        "customer_id",
        "page_url",
        "event_type",
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        "device_type",
    )
