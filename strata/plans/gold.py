"""Gold: star schema (dimensions with stable surrogate keys, facts), the
customer-360 aggregate and the reporting views.

Join rules: dimension lookups are left to Spark (``lookup_join``; NULL keys are
spread), unless a side is larger than it looks; aggregates are computed before joins to dimensions (pre-aggregate,
then enrich)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.calendar import calendar_columns, date_sk
from strata.functions.tiers import value_tier
from strata.operators.joins import lookup_join, point_in_time_join, point_in_time_sliced
from strata.operators.scd2 import scd2_initial, scd2_merge

CUSTOMER_ATTRS = ["name_hash", "email_hash", "city", "country", "signup_date"]
PRODUCT_ATTRS = ["product_name", "category", "sub_category", "unit_cost"]
STORE_ATTRS = ["store_name", "city", "country", "region"]


def _ts_lit(as_of) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


# ------------------------------------------------------------------ dims
def _dimension(source: DataFrame, bk: str, name: str, attrs: list[str], as_of, existing: DataFrame | None) -> DataFrame:
    """First load, or the snapshot merged into the dimension as it stands
    (history and surrogate keys stay)."""
    if existing is None:
        return scd2_initial(source, bk, f"{name}_sk", attrs, as_of, bk_out=f"{name}_bk")
    return scd2_merge(existing, source, f"{name}_bk", f"{name}_sk", attrs, as_of, source_bk=bk)


def build_dim_customer(silver_customers: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    return _dimension(silver_customers, "customer_id", "customer", CUSTOMER_ATTRS, as_of, existing)


def build_dim_product(silver_pos: DataFrame, products: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    """Every product sold, with master attributes where the master has them."""
    sold = silver_pos.select("product_id").distinct()
    attrs = products.select("product_id", *PRODUCT_ATTRS)
    src = lookup_join(sold, attrs, "product_id", "product_id").drop(attrs["product_id"])
    return _dimension(src, "product_id", "product", PRODUCT_ATTRS, as_of, existing)


def build_dim_store(stores: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    return _dimension(stores, "store_id", "store", STORE_ATTRS, as_of, existing)


def build_dim_date(silver_pos: DataFrame) -> DataFrame:
    """One row per day from the first to the last sale date. The days come
    from two scalars, a row a year first, so a stray date far away makes more
    rows but no longer array than a year."""
    span = silver_pos.agg(
        F.to_date(F.min("sale_date")).alias("lo"), F.to_date(F.max("sale_date")).alias("hi")
    ).filter(F.col("lo").isNotNull())
    years = span.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("y"))
    first, last = (F.make_date("y", F.lit(m), F.lit(d)) for m, d in ((1, 1), (12, 31)))
    days = years.select(
        F.explode(F.sequence(F.greatest("lo", first), F.least("hi", last), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])


# ------------------------------------------------------------------ facts
FACT_SALES_COLUMNS = [
    "transaction_id", "customer_sk", "product_sk", "store_sk", "date_sk", "quantity",
    "unit_price", "total_amount", "payment_method", "_processed_at",
]


def _current(dim: DataFrame, sk: str, bk: str) -> DataFrame:
    return dim.filter(F.col("_is_current")).select(sk, bk)


def build_fact_sales(
    silver_pos: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    as_of,
) -> DataFrame:
    sale = ["transaction_id"]
    f = lookup_join(silver_pos, _current(dim_customer, "customer_sk", "customer_bk"),
                    "customer_id", "customer_bk", spread_by=sale)
    f = lookup_join(f, _current(dim_product, "product_sk", "product_bk"), "product_id", "product_bk", spread_by=sale)
    f = lookup_join(f, _current(dim_store, "store_sk", "store_bk"), "store_id", "store_bk", spread_by=sale)
    return f.withColumn("date_sk", date_sk(F.col("sale_date"))).withColumn(
        "_processed_at", _ts_lit(as_of)
    ).select(*FACT_SALES_COLUMNS)


def build_fact_sales_asof(silver_pos: DataFrame, dim_customer_history: DataFrame, as_of, sliced: bool = False) -> DataFrame:
    """Facts keyed to the customer version valid at the sale time (SCD2
    point-in-time lookup); sales without a date or version get NULL.
    ``sliced`` is for customers with very many versions and sales."""
    d = dim_customer_history.select("customer_sk", "customer_bk", "_valid_from", "_valid_to")
    f = (point_in_time_sliced if sliced else point_in_time_join)(silver_pos, d, "customer_id", "customer_bk", "sale_date")
    return f.select(
        "transaction_id", "customer_id", "customer_sk", "sale_date",
        date_sk(F.col("sale_date")).alias("date_sk"), "total_amount",
    )


def build_inventory_snapshot(silver_inv: DataFrame, dim_product: DataFrame, as_of) -> DataFrame:
    """Daily movement per (warehouse, product): aggregate first, then look up
    the product key on the (much smaller) aggregate."""
    qty = F.col("quantity").cast("long")
    agg = (
        silver_inv.withColumn("date_sk", date_sk(F.col("movement_date")))
        .groupBy("warehouse_id", "product_id", "date_sk")
        .agg(
            F.coalesce(F.sum(F.when(F.col("movement_type") == "IN", qty)), F.lit(0)).alias("units_in"),
            F.coalesce(F.sum(F.when(F.col("movement_type") == "OUT", qty)), F.lit(0)).alias("units_out"),
        )
    )
    j = lookup_join(agg, _current(dim_product, "product_sk", "product_bk"), "product_id", "product_bk")
    return j.select(
        F.concat_ws("|", "warehouse_id", "product_id", F.coalesce(F.col("date_sk").cast("string"), F.lit("none")))
        .alias("snapshot_id"),
        "warehouse_id", "product_sk", "date_sk",
        F.col("units_in").cast("long").alias("units_in"),
        F.col("units_out").cast("long").alias("units_out"),
        (F.col("units_in") - F.col("units_out")).cast("long").alias("net_movement"),
        _ts_lit(as_of).alias("_processed_at"),
    )


# ------------------------------------------------------------ aggregates
def _most_frequent(value: str) -> Column:
    """Over rows counted per ``value`` in ``_k``: the value with the largest
    count, ties to the smallest value; NULLs do not count."""
    ranked = F.struct((-F.col("_k")).alias("neg"), F.col(value).alias("v"))
    return F.min(F.when(F.col(value).isNotNull(), ranked))["v"]


def build_customer_360(silver_pos: DataFrame, as_of) -> DataFrame:
    """Per customer: orders, spend, average order value, first/last purchase,
    preferred payment method and value tier.

    Rows are grouped by (customer, method) first, in a hash aggregation that
    combines map-side, so a customer with a huge share of rows costs a row a
    method and task; the second grouping sees a row a method. (The built-in
    ``mode`` sorts its raw input once a task holds many customers.) Ties of the
    preferred method go to the smallest, NULL methods do not count. Anonymous
    sales (NULL customer) are filtered before the shuffle."""
    per_method = (
        silver_pos.filter(F.col("customer_id").isNotNull())
        .groupBy(F.col("customer_id").alias("customer_bk"), "payment_method")
        .agg(
            F.count("transaction_id").alias("_orders"),
            F.sum("total_amount").alias("_sum"),
            F.count("total_amount").alias("_n"),
            F.min("sale_date").alias("_first"),
            F.max("sale_date").alias("_last"),
            F.count(F.lit(1)).alias("_k"),
        )
    )
    return customer_360_of(per_method, as_of)


def customer_360_of(per_method: DataFrame, as_of) -> DataFrame:
    """The 360 rows from a row a customer and method (``_orders``, ``_sum`` and
    ``_n`` of the amounts, ``_first``, ``_last``, ``_k`` rows)."""
    g = per_method.groupBy("customer_bk").agg(
        F.sum("_orders").alias("total_orders"),
        F.sum("_sum").alias("_sum"),
        F.sum("_n").alias("_n"),
        F.min("_first").alias("first_purchase_date"),
        F.max("_last").alias("last_purchase_date"),
        _most_frequent("payment_method").alias("preferred_payment_method"),
    )
    spend = F.col("_sum").cast("decimal(16,2)")
    return g.select(
        "customer_bk",
        F.col("total_orders").cast("long").alias("total_orders"),
        spend.alias("total_spend"),
        F.round(F.col("_sum") / F.col("_n"), 2).cast("decimal(12,2)").alias("avg_order_value"),
        "first_purchase_date",
        "last_purchase_date",
        "preferred_payment_method",
        value_tier(spend).alias("lifetime_value_tier"),
        _ts_lit(as_of).alias("_processed_at"),
    )


def preferred_payment(silver_pos: DataFrame) -> DataFrame:
    """Most frequent payment method per customer with its count; ties go to
    the smallest method. Two pre-aggregated groupings, no window: the second
    picks ``min(struct(-count, method))``."""
    per = (
        silver_pos.filter(F.col("customer_id").isNotNull() & F.col("payment_method").isNotNull())
        .groupBy("customer_id", "payment_method")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = per.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("payment_method").alias("m"))).alias("b")
    )
    return best.select(
        F.col("customer_id").alias("customer_bk"),
        F.col("b.m").alias("preferred_payment_method"),
        (-F.col("b.neg")).cast("long").alias("method_count"),
    )


def build_customer_360_ext(silver_pos: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Purchase frequency (days between first and last dated purchase per
    additional purchase) and preferred product category."""
    cats = dim_product.filter(F.col("_is_current")).select(F.col("product_bk").alias("product_id"), "category")
    s = silver_pos.filter(F.col("customer_id").isNotNull()).join(cats, "product_id", "left")
    per_category = s.groupBy(F.col("customer_id").alias("customer_bk"), "category").agg(
        F.count(F.lit(1)).alias("_k"),
        F.count("sale_date").alias("_dated"),
        F.min("sale_date").alias("_first"),
        F.max("sale_date").alias("_last"),
    )
    g = per_category.groupBy("customer_bk").agg(
        F.sum("_k").alias("total_orders"),
        F.sum("_dated").alias("dated"),
        F.datediff(F.to_date(F.max("_last")), F.to_date(F.min("_first"))).alias("span_days"),
        _most_frequent("category").alias("preferred_category"),
    )
    freq = F.when(
        F.col("dated") >= 2,
        F.round(F.col("span_days").cast("decimal(12,0)") / (F.col("dated") - 1), 2),
    ).cast("decimal(12,2)")
    return g.select(
        "customer_bk",
        F.col("total_orders").cast("long").alias("total_orders"),
        F.col("span_days").cast("int").alias("active_days"),
        freq.alias("purchase_frequency_days"),
        "preferred_category",
    )


# ----------------------------------------------------------------- views
def sales_summary(fact: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Daily revenue/units/transactions per (date, store, product), enriched
    with calendar, store and product attributes (current versions)."""
    daily = fact.groupBy("date_sk", "store_sk", "product_sk").agg(
        F.sum("total_amount").cast("decimal(18,2)").alias("daily_revenue"),
        F.sum("quantity").cast("long").alias("daily_units_sold"),
        F.count("transaction_id").cast("long").alias("transaction_count"),
    )
    dd = dim_date.select("date_sk", "full_date", "year", "month", "month_name")
    ds = dim_store.filter(F.col("_is_current")).select(
        "store_sk", F.col("store_bk").alias("store_id"), "store_name", "region"
    )
    dp = dim_product.filter(F.col("_is_current")).select("product_sk", "category", "sub_category")
    j = lookup_join(daily, dd, "date_sk", "date_sk").drop(dd["date_sk"])
    j = lookup_join(j, ds, "store_sk", "store_sk").drop(ds["store_sk"])
    j = lookup_join(j, dp, "product_sk", "product_sk").drop(dp["product_sk"])
    return j.select(
        "full_date", "year", "month", "month_name", "store_id", "store_name", "region",
        "category", "sub_category", "daily_revenue", "daily_units_sold", "transaction_count",
    )


def customer_360_view(dim_customer: DataFrame, c360: DataFrame) -> DataFrame:
    dc = dim_customer.filter(F.col("_is_current")).select("customer_bk", "city", "country", "signup_date")
    j = lookup_join(c360, dc, "customer_bk", "customer_bk", how="inner").drop(dc["customer_bk"])
    return j.select(
        "customer_bk", "total_orders", "total_spend", "avg_order_value", "first_purchase_date",
        "last_purchase_date", "preferred_payment_method", "lifetime_value_tier", "city",
        "country", "signup_date",
    )
