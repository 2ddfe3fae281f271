"""Registered queries: one per operator of the inventory, each
``(spark, sf_dir) -> DataFrame`` over the whole test tables. Queries that
exercise the snapshot store write into a fresh folder under the shared
``spark.checkpoint.dir`` and return what they read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import quality
from strata.operators.merge import merge_upsert
from strata.operators.scd2 import scd2_initial, scd2_merge
from strata.operators.sessions import sessions_summary
from strata.operators.zorder import hilbert_layout
from strata.plans import gold, layers as L, silver
from strata.session import scratch_path, written
from strata.sources import feeds, files
from strata.sources.incremental import high_water_mark, rows_after
from strata.sources.partitioned import KeyedTable
from strata.sources.snapshots import SnapshotTable

Query = Callable[[SparkSession, str], DataFrame]


def _no_meta(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in ("_source_file",) if c in df.columns])


# ---------------------------------------------------------------- bronze
def q_ingest_pos(spark, sf):
    """Land the POS feed as CSV files, ingest them back with the explicit
    all-string schema and stamp ingestion metadata."""
    land = scratch_path(spark, "landing_pos")
    files.write_csv_feed(feeds.raw_pos(spark, sf), land)
    raw = files.read_csv_feed(spark, land, files.raw_string_schema("bronze_pos_transactions"),
                              glob="*.csv")
    return _no_meta(files.stamp_ingestion(raw, L.AS_OF))


def q_ingest_inventory(spark, sf):
    land = scratch_path(spark, "landing_inventory")
    files.write_csv_feed(feeds.raw_inventory(spark, sf), land)
    raw = files.read_csv_feed(spark, land, files.raw_string_schema("bronze_inventory_movements"),
                              glob="*.csv")
    return _no_meta(files.stamp_ingestion(raw, L.AS_OF))


def q_ingest_customers(spark, sf):
    land = scratch_path(spark, "landing_customers")
    files.write_csv_feed(feeds.raw_customers(spark, sf), land)
    raw = files.read_csv_feed(spark, land, files.raw_string_schema("bronze_customers"), glob="*.csv")
    return _no_meta(files.stamp_ingestion(raw, L.AS_OF))


def q_ingest_clicks(spark, sf):
    land = scratch_path(spark, "landing_clicks")
    files.write_json_feed(feeds.clickstream_raw(spark, sf).drop("session_id"), land)
    raw = files.read_json_feed(
        spark, land, files.raw_string_schema("bronze_clickstream"), glob="*.json"
    )
    good, _bad = files.split_corrupt(raw)
    return _no_meta(files.stamp_ingestion(good, L.AS_OF))


# ---------------------------------------------------------------- silver
def q_clean_transactions(spark, sf):
    return L.silver_pos(spark, sf)


def q_clean_inventory(spark, sf):
    return L.silver_inventory(spark, sf)


def q_clean_customers(spark, sf):
    return L.silver_customers(spark, sf)


def q_dedupe_latest(spark, sf):
    return silver.pos_deduped(L.bronze_pos(spark, sf)).drop("_ingested_at", "_source_file")


def q_rejects_by_reason(spark, sf):
    return silver.pos_outcomes(L.bronze_pos(spark, sf))


def q_conform_schema(spark, sf):
    return schemas.schema_violations(L.silver_pos(spark, sf), "silver_pos_transactions")


def q_conform_drift(spark, sf):
    """The raw POS feed, with a column more and the silver layout's own ones
    missing, in that layout: what does not fit is kept beside it."""
    raw = feeds.raw_pos(spark, sf).withColumn("coupon", F.when(F.col("store_id").isNull(), F.lit("none")))
    out = schemas.conform_drift(raw, "silver_pos_transactions")
    rest = F.col(schemas.REST)
    return out.select("transaction_id", "quantity", "unit_price", "sale_date", "total_amount", F.size(rest).alias("n_rest"),
                      *[rest[c].alias(f"rest_{c}") for c in ("quantity", "sale_date", "coupon")])


def q_quarantine_rows(spark, sf):
    return silver.pos_quarantine(L.bronze_pos(spark, sf), L.AS_OF)


def q_quarantine_reasons(spark, sf):
    """Where every row of the four feeds went, with all reasons of those that
    silver does not take; the rows of a feed add up to those delivered."""
    meta = {"_ingested_at": F.lit(L.AS_OF).cast("timestamp_ntz"), "_source_file": F.lit("events")}
    feeds_of = {
        "pos_transactions": L.bronze_pos(spark, sf), "inventory_movements": L.bronze_inventory(spark, sf),
        "customers": L.bronze_customers(spark, sf), "clickstream": feeds.clickstream_raw(spark, sf).withColumns(meta),
    }
    out = None
    for feed, df in feeds_of.items():
        part = silver.judged(df, feed, L.AS_OF).groupBy(F.lit(feed).alias("feed"), F.array_join("reasons", ",").alias("reasons")).agg(
            F.count(F.lit(1)).alias("rows"), F.count("winner").alias("with_winner"))
        out = part if out is None else out.unionByName(part)
    return out


def q_conform_raw(spark, sf):
    """What casting the raw POS text to the silver layout would lose."""
    raw = feeds.raw_pos(spark, sf).withColumns({
        "total_amount": F.lit(None).cast("string"), "_processed_at": F.lit(L.AS_OF)})
    return schemas.schema_violations(raw, "silver_pos_transactions")


def q_sessionise(spark, sf):
    return silver.sessionise(feeds.clickstream(spark, sf), L.AS_OF)


def q_session_window_counts(spark, sf):
    ev = feeds.clickstream(spark, sf).dropDuplicates(["event_id"])
    return sessions_summary(ev, "customer_id", "event_timestamp", silver.SESSION_TIMEOUT_SECONDS)


# ------------------------------------------------------------------ gold
def q_customer_360(spark, sf):
    return gold.build_customer_360(L.silver_pos(spark, sf), L.AS_OF)


def q_customer_360_ext(spark, sf):
    pos = L.silver_pos_table(spark, sf)
    return gold.build_customer_360_ext(pos, L.dim_product(spark, sf, pos))


def q_preferred_payment(spark, sf):
    return gold.preferred_payment(L.silver_pos(spark, sf))


def q_dim_customer(spark, sf):
    return L.dim_customer(spark, sf)


def q_dim_product(spark, sf):
    return L.dim_product(spark, sf)


def q_dim_store(spark, sf):
    return L.dim_store(spark, sf)


def q_dim_date(spark, sf):
    return gold.build_dim_date(L.silver_pos(spark, sf))


def q_fact_sales(spark, sf):
    return L.fact_sales(spark, sf)


def _customer_history(spark, sf) -> DataFrame:
    # both snapshots derive from silver customers: materialise it once (as
    # the daily job writes it) rather than re-deriving it for every pass
    c = written(L.silver_customers(spark, sf), "silver-customers")
    v1 = scd2_initial(L.customers_day1(spark, sf, c), "customer_id", "customer_sk",
                      gold.CUSTOMER_ATTRS, L.HISTORY_START, bk_out="customer_bk")
    return scd2_merge(v1, L.customers_day2(spark, sf, c), "customer_bk", "customer_sk",
                      gold.CUSTOMER_ATTRS, L.CHANGE_AT, source_bk="customer_id")


def q_scd2_merge(spark, sf):
    return _customer_history(spark, sf)


def q_scd2_any_order(spark, sf):
    """The customer history of three full snapshots that come out of order, the
    newest first: day 2, day 1, and one between them that lacks some
    customers and has others elsewhere. (Surrogate keys depend on the order.)"""
    from strata.operators.scd2 import scd2_apply

    c = written(L.silver_customers(spark, sf), "silver-customers")
    day = {L.CHANGE_AT: L.customers_day2(spark, sf, c), L.HISTORY_START: L.customers_day1(spark, sf, c), L.BETWEEN: L.customers_between(spark, sf, c)}
    dim, done = None, []
    for at, snapshot in day.items():
        if dim is None:
            dim = scd2_initial(snapshot, "customer_id", "customer_sk", gold.CUSTOMER_ATTRS, at, bk_out="customer_bk")
        else:
            dim = scd2_apply(dim, snapshot, "customer_bk", "customer_sk", gold.CUSTOMER_ATTRS, at, done, source_bk="customer_id")
        dim, done = written(dim, "scd2-any-order"), [*done, at]
    return dim.drop("customer_sk")


def q_fact_sales_asof(spark, sf):
    return gold.build_fact_sales_asof(L.silver_pos(spark, sf), _customer_history(spark, sf), L.AS_OF)


def q_fact_sales_asof_sliced(spark, sf):
    """The same lookup by slices of time, for keys with many versions and sales."""
    return gold.build_fact_sales_asof(L.silver_pos(spark, sf), _customer_history(spark, sf), L.AS_OF, sliced=True)


def q_sales_summary(spark, sf):
    st = L.star(spark, sf)
    return gold.sales_summary(st["fact_sales"], gold.build_dim_date(st["pos"]), st["dim_store"],
                              st["dim_product"])


def q_customer_360_view(spark, sf):
    return gold.customer_360_view(L.dim_customer(spark, sf), q_customer_360(spark, sf))


def q_inventory_snapshot(spark, sf):
    return gold.build_inventory_snapshot(
        L.silver_inventory(spark, sf), L.dim_product(spark, sf, L.silver_pos_table(spark, sf)), L.AS_OF
    )


# --------------------------------------------------- snapshots and merge
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def _orders_day1(spark, sf):
    """Orders as first loaded: everything placed before DAY1_CUTOFF; orders
    of the last half year were still open then."""
    o = feeds.table(spark, sf, "orders").select(*ORDER_COLS)
    return o.filter(F.col("o_orderdate") < F.lit(L.DAY1_CUTOFF).cast("timestamp_ntz")).withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderdate") >= F.lit(L.DAY2_START).cast("timestamp_ntz"), F.lit("O"))
        .otherwise(F.col("o_orderstatus")),
    )


def _orders_batch2(spark, sf):
    """The next delivery: every order placed from DAY2_START on, final state."""
    o = feeds.table(spark, sf, "orders").select(*ORDER_COLS)
    return o.filter(F.col("o_orderdate") >= F.lit(L.DAY2_START).cast("timestamp_ntz"))


def _orders_table(spark, sf) -> SnapshotTable:
    t = SnapshotTable(spark, scratch_path(spark, "orders"))
    t.publish(_orders_day1(spark, sf), committed_at="2024-01-01T00:00:00", operation="CREATE")
    t.upsert(_orders_batch2(spark, sf), ["o_orderkey"], committed_at="2024-01-02T00:00:00")
    return t


def q_upsert_orders(spark, sf):
    return _orders_table(spark, sf).read()


def q_upsert_orders_partitioned(spark, sf):
    """The same two deliveries, upserted into an orders table partitioned by
    order month: the second batch rewrites only the months it touches."""
    from strata.sources.partitioned import upsert_partitions

    path = scratch_path(spark, "orders_by_month")
    month = F.date_format("o_orderdate", "yyyy-MM")
    for batch in (_orders_day1(spark, sf), _orders_batch2(spark, sf)):
        upsert_partitions(spark, batch.withColumn("o_month", month), path,
                          ["o_orderkey", "o_month"], ["o_month"])
    return spark.read.parquet(path).select(*ORDER_COLS)


def q_upsert_orders_bucketed(spark, sf):
    """The same two deliveries, merged into a table bucketed by order key: the
    merge shuffles the second delivery alone."""
    import uuid

    from strata.sources.bucketed import BucketedTable

    t = BucketedTable(spark, f"orders_{uuid.uuid4().hex[:8]}", scratch_path(spark, "orders_bucketed"), ["o_orderkey"], 8)
    t.create(_orders_day1(spark, sf))
    t.merge(_orders_batch2(spark, sf))
    return t.read()


def q_time_travel(spark, sf):
    """Version 1 read back by timestamp after version 2 was committed."""
    return _orders_table(spark, sf).read(timestamp="2024-01-01T12:00:00")


def q_vacuum_history(spark, sf):
    """Versions left after a vacuum: the orders table gets a merge and a
    compaction; vacuum with the 7-day guard, run 18 days after the merge,
    drops version 1 (replaced more than 7 days earlier) and keeps the rest.
    Returns (version, operation, rows) of every version still readable."""
    t = _orders_table(spark, sf)
    t.compact(committed_at="2024-01-20T00:00:00")
    t.vacuum(retention_hours=168, now="2024-01-20T00:00:00")
    out = None
    for c in t.commits():
        part = t.read(version=c["version"]).agg(
            F.lit(c["version"]).alias("version"), F.lit(c["operation"]).alias("operation"),
            F.count(F.lit(1)).alias("rows"),
        )
        out = part if out is None else out.unionByName(part)
    return out


#: Rows of a clustered file, which one task sorts in memory.
ROWS_PER_FILE = 1_000_000


def _layout_files(table: DataFrame) -> int:
    """The files of a clustered layout grow with the table (its rows are
    counted from Parquet footers), the work of a task does not."""
    return max(8, -(-table.count() // ROWS_PER_FILE))


def q_zorder_layout(spark, sf):
    """lineitem (whole rows) laid out by Z-order on ship date, supplier and
    return flag; rows unchanged."""
    t = SnapshotTable(spark, scratch_path(spark, "zorder"))
    t.publish(feeds.table(spark, sf, "lineitem"), committed_at="2024-01-01T00:00:00")
    t.zorder(["l_shipdate", "l_suppkey", "l_returnflag"], num_files=_layout_files(t.read()), committed_at="2024-01-02T00:00:00")
    return t.read()


def q_hilbert_layout(spark, sf):
    """lineitem (whole rows) laid out along a Hilbert curve over ship date,
    part and a text that names the supplier after a common prefix; rows unchanged."""
    t = feeds.table(spark, sf, "lineitem")
    named = t.withColumn("_supplier", F.format_string("supplier number %09d", "l_suppkey"))
    out = hilbert_layout(named, ["l_shipdate", "l_partkey", "_supplier"], num_files=_layout_files(t))
    return written(out, "hilbert").drop("_supplier")


def q_maintained_table(spark, sf):
    """orders (whole rows) merged in four batches into a keyed table by year,
    then compacted along a Hilbert curve; rows unchanged, fewer files."""
    orders = feeds.table(spark, sf, "orders")
    t = KeyedTable(spark, scratch_path(spark, "maintained"), ["o_orderkey"], F.coalesce(F.date_format("o_orderdate", "yyyy"), F.lit("undated")))
    for i in range(4):
        t.merge(orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(4)) == i).repartition(8))
    t.tidy(["o_orderdate", "o_custkey"], all_parts=True)
    return t.read()


def q_incremental_load(spark, sf):
    """Silver POS loaded in two runs over a bronze table that gets two
    deliveries (every raw row is in one): each run takes the rows that arrived
    after the last one and merges them. Equal to one run over all rows."""
    raw = written(L.bronze_pos(spark, sf), "raw-pos")  # read for each delivery
    bronze = scratch_path(spark, "bronze_pos_inc")
    t = SnapshotTable(spark, scratch_path(spark, "silver_pos_inc"))
    mark = None
    for number, part in enumerate(_pos_deliveries(raw), 1):
        part.withColumn("_delivery", F.lit(number)).write.mode("append").option("compression", "zstd").parquet(bronze)
        arrived = rows_after(spark.read.parquet(bronze), "_delivery", mark).drop("_delivery")
        t.upsert(silver.clean_transactions(arrived, L.AS_OF), ["transaction_id"], on_duplicate="keep",
                 committed_at=f"2024-01-0{number}T00:00:00", latest=silver.silver_pos_order())
        mark = high_water_mark(spark.read.parquet(bronze), "_delivery")
    return t.read()


def _pos_deliveries(raw):
    """All raw rows in two deliveries, the newer sales first, so the second one
    is late; rows whose date does not parse come second too."""
    new = F.coalesce(F.col("sale_date").try_cast("timestamp_ntz") >= F.lit(L.DAY1_CUTOFF).cast("timestamp_ntz"), F.lit(False))
    return raw.filter(new), raw.filter(~new)


def q_hourly_incremental(spark, sf):
    """The hourly job run twice over one POS landing folder that gets all raw
    rows in two deliveries; each run loads the files that are new."""
    from strata.plans.jobs import Lakehouse, hourly_incremental

    land, root = scratch_path(spark, "hourly_landing"), scratch_path(spark, "hourly_lake")
    raw = written(feeds.raw_pos(spark, sf), "raw-pos")  # read for each delivery
    for hour, part in enumerate(_pos_deliveries(raw), 1):
        files.write_csv_feed(part, f"{land}/h{hour}", compression="gzip")
        hourly_incremental(spark, land, root, L.AS_OF)
    return Lakehouse(root).table(spark, "silver", "pos_transactions").read()


def q_hourly_customer_360(spark, sf):
    """Customer 360 from two hourly deliveries, a correction and a removal. The
    first delivery gives a part of the sales to other customers and methods and
    holds sales that never were; the second brings the true rows of the former,
    then the latter are removed. Equal to one build over the true sales."""
    from strata.plans import jobs

    land, root = scratch_path(spark, "hourly_360_landing"), scratch_path(spark, "hourly_360_lake")
    raw = written(feeds.raw_pos(spark, sf), "raw-pos")  # read for each delivery and the removal
    wrong = F.crc32("transaction_id") % 7 == 0
    first = raw.withColumns({
        "customer_id": F.when(wrong, F.concat(F.lit("C"), F.crc32("transaction_id") % 50)).otherwise(F.col("customer_id")),
        "payment_method": F.when(wrong, F.lit("CASH")).otherwise(F.col("payment_method")),
    })
    never = raw.filter(F.crc32("transaction_id") % 13 == 0).withColumn("transaction_id", F.concat(F.lit("X"), "transaction_id"))
    for hour, (part, as_of) in enumerate(((first.unionByName(never), L.CHANGE_AT), (raw.filter(wrong), L.AS_OF)), 1):
        files.write_csv_feed(part, f"{land}/h{hour}", compression="gzip")
        jobs.hourly_incremental(spark, land, root, as_of, with_360=True)
    jobs.remove_sales(spark, root, never.select("transaction_id").distinct(), L.AS_OF, "never")
    out = jobs.customer_state(spark, root).table.read().drop("customer_bucket")
    # each row has the time of the run that last built it
    return out.withColumn("_processed_at", F.lit(L.AS_OF).cast("timestamp_ntz"))


def q_hourly_clicks(spark, sf):
    """The hourly click job run twice: the events of the second delivery lie
    between those of the first, so most sessions are cut anew. Equal to the
    sessions of one batch over all events."""
    from strata.plans.jobs import Lakehouse, hourly_clicks

    land, root = scratch_path(spark, "hourly_clicks_landing"), scratch_path(spark, "hourly_clicks_lake")
    raw = feeds.clickstream_raw(spark, sf).drop("session_id")
    second = F.crc32("event_id") % 2 == 1
    for hour, part in enumerate((raw.filter(~second), raw.filter(second)), 1):
        files.write_json_feed(part, f"{land}/h{hour}")
        hourly_clicks(spark, land, root, L.AS_OF, clicks_by="yyyy-MM")  # the test events lie far apart
    return Lakehouse(root, "yyyy-MM").table(spark, "silver", "clickstream").read()


# ------------------------------------------------------------ data quality
def q_dq_bronze(spark, sf):
    return quality.run_suite(L.bronze_pos(spark, sf), "bronze_pos_transactions")


def q_dq_silver(spark, sf):
    return quality.run_suite(L.silver_pos_table(spark, sf), "silver_pos_transactions")


def q_dq_gold(spark, sf):
    return quality.run_suite(written(L.fact_sales(spark, sf), "fact-sales"), "gold_fact_sales")


def q_dq_results(spark, sf):
    """The result table after the three suites of one run were stored."""
    path, st = scratch_path(spark, "dq_results"), L.star(spark, sf)
    for suite, df in (("bronze_pos_transactions", L.bronze_pos(spark, sf)), ("silver_pos_transactions", st["pos"]),
                      ("gold_fact_sales", written(st["fact_sales"], "fact-sales"))):
        quality.store_results(quality.run_suite(df, suite), path, L.AS_OF)
    return spark.read.parquet(path)


def q_pk_check(spark, sf):
    st = L.star(spark, sf)
    pos, dc = st["pos"], st["dim_customer"]
    inventory = written(L.silver_inventory(spark, sf), "silver-inventory")  # read twice
    parts = [
        quality.pk_check(inventory, "silver_inventory_movements", ["movement_id"]),
        quality.pk_check(L.silver_customers(spark, sf), "silver_customers", ["customer_id"]),
        quality.pk_check(silver.sessionise(feeds.clickstream(spark, sf), L.AS_OF), "silver_clickstream", ["event_id"]),
        quality.pk_check(st["fact_sales"], "gold_fact_sales", ["transaction_id"]),
        quality.pk_check(gold.build_inventory_snapshot(inventory, st["dim_product"], L.AS_OF),
                         "gold_fact_inventory_snapshot", ["snapshot_id"]),
        quality.pk_check(pos, "silver_pos_transactions", ["transaction_id"]),
        quality.pk_check(dc, "gold_dim_customer", ["customer_sk"]),
        quality.pk_check(dc, "gold_dim_customer_current_bk",
                         ["customer_bk"], current_col="_is_current"),
        quality.pk_check(st["dim_product"], "gold_dim_product", ["product_sk"]),
        quality.pk_check(st["dim_store"], "gold_dim_store", ["store_sk"]),
        quality.pk_check(gold.build_dim_date(pos), "gold_dim_date", ["date_sk"]),
        quality.pk_check(gold.build_customer_360(pos, L.AS_OF), "gold_agg_customer_360", ["customer_bk"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_check_constraints(spark, sf):
    """Every constraint of the registry (primary and conditional keys, NOT NULL,
    CHECK) on every table that has some, each table read once."""
    st = L.star(spark, sf)
    pos = st["pos"]
    inventory = written(L.silver_inventory(spark, sf), "silver-inventory")  # read twice
    tables = {
        "silver_pos_transactions": pos,
        "silver_inventory_movements": inventory,
        "silver_customers": L.silver_customers(spark, sf),
        "silver_clickstream": silver.sessionise(feeds.clickstream(spark, sf), L.AS_OF),
        "gold_dim_customer": st["dim_customer"],
        "gold_dim_product": st["dim_product"],
        "gold_dim_store": st["dim_store"],
        "gold_dim_date": gold.build_dim_date(pos),
        "gold_fact_sales": st["fact_sales"],
        "gold_fact_inventory_snapshot": gold.build_inventory_snapshot(inventory, st["dim_product"], L.AS_OF),
        "gold_agg_customer_360": gold.build_customer_360(pos, L.AS_OF),
    }
    assert set(tables) == set(schemas.PRIMARY_KEYS)
    out = None
    for name, df in tables.items():
        part = quality.check_constraints(df, name)
        out = part if out is None else out.unionByName(part)
    return out


def q_fk_orphans(spark, sf):
    st = L.star(spark, sf)
    fact = written(st["fact_sales"], "fact-sales")  # read for each key
    return (
        quality.fk_orphans(fact, "customer_sk", st["dim_customer"], "customer_sk")
        .unionByName(quality.fk_orphans(fact, "product_sk", st["dim_product"], "product_sk"))
        .unionByName(quality.fk_orphans(fact, "store_sk", st["dim_store"], "store_sk"))
        .unionByName(quality.fk_orphans(fact, "date_sk", gold.build_dim_date(st["pos"]), "date_sk"))
    )


def q_layer_counts(spark, sf):
    """Row counts per layer observed while silver is written (no extra
    counting jobs): bronze rows in, rows after dedupe, rows written."""
    from strata.plans.jobs import observed_clean_transactions

    path = scratch_path(spark, "silver_pos_obs")
    counts = observed_clean_transactions(L.bronze_pos(spark, sf), path, L.AS_OF)
    return spark.createDataFrame(
        [(k, int(v)) for k, v in counts.items()], "stage string, rows long"
    )


def q_daily_refresh(spark, sf):
    """The daily full refresh end to end: the four feeds landed as files,
    every layer written once as a snapshot, the DQ suites evaluated (reported,
    not gating: the silver suite fails on the test data on purpose). Returns
    the row count of every table written, observed on the writes themselves."""
    from strata.plans.jobs import daily_refresh

    land = {}
    for name, df, write in (
        ("pos", feeds.raw_pos(spark, sf), files.write_csv_feed),
        ("inventory", feeds.raw_inventory(spark, sf), files.write_csv_feed),
        ("customers", feeds.raw_customers(spark, sf), files.write_csv_feed),
        ("clicks", feeds.clickstream_raw(spark, sf).drop("session_id"), files.write_json_feed),
    ):
        land[name] = scratch_path(spark, f"daily_landing_{name}")
        write(df, land[name], compression="gzip")
    rep = daily_refresh(spark, land, scratch_path(spark, "daily_lake"), L.AS_OF,
                        products=feeds.products(spark, sf), stores=feeds.stores(spark, sf), gate=False, clicks_by="yyyy-MM")
    return spark.createDataFrame(
        [(k, int(v)) for k, v in rep["counts"].items()], "step string, rows long"
    )


def q_dq_gate(spark, sf):
    """The daily job with its gates on: the silver suite fails on the test data,
    so the run stops there. Returns for every table whether it was written."""
    from strata.plans import jobs

    land = {}
    for name, df in (("pos", feeds.raw_pos(spark, sf)), ("inventory", feeds.raw_inventory(spark, sf)), ("customers", feeds.raw_customers(spark, sf))):
        land[name] = scratch_path(spark, f"gate_landing_{name}")
        files.write_csv_feed(df, land[name], compression="gzip")
    root = scratch_path(spark, "gate_lake")
    try:
        jobs.daily_refresh(spark, land, root, L.AS_OF, products=feeds.products(spark, sf), stores=feeds.stores(spark, sf))
        stopped = None
    except quality.QualityGateError as e:
        stopped = str(e)
    lake = jobs.Lakehouse(root)
    return spark.createDataFrame(
        [(f"{layer}.{name}", lake.table(spark, layer, name).exists(), stopped is not None) for layer, names in jobs.TABLES.items() for name in names],
        "step string, written boolean, stopped boolean",
    )


def q_daily_two_days(spark, sf):
    """The daily job run on two days over one lake: the customers of day 1
    as first delivered, on day 2 the full snapshot. Returns the customer
    dimension: day 1's versions are history, keys are unchanged."""
    from strata.plans.jobs import daily_refresh

    c = feeds.raw_customers(spark, sf)
    k = F.substring(F.col("customer_id"), 2, 20).cast("long")
    day1 = c.filter(F.col("signup_date").try_cast("timestamp_ntz") < F.lit(L.CHANGE_AT).cast("timestamp_ntz")).withColumns({
        "city": F.when(k % 10 == 3, F.concat(F.lit("OLD/"), "city")).when(k % 25 != 0, F.col("city")),
        "email": F.when(k % 10 != 7, F.col("email")),
    })
    day2 = c.withColumn("city", F.when(k % 40 != 1, F.col("city")))
    land = {n: scratch_path(spark, f"two_days_{n}") for n in ("pos", "inventory")}
    files.write_csv_feed(feeds.raw_pos(spark, sf), land["pos"], compression="gzip")
    files.write_csv_feed(feeds.raw_inventory(spark, sf), land["inventory"], compression="gzip")
    root = scratch_path(spark, "two_days_lake")
    for as_of, customers in ((L.HISTORY_START, day1), (L.CHANGE_AT, day2)):
        land["customers"] = scratch_path(spark, "two_days_customers")
        files.write_csv_feed(customers, land["customers"])
        daily_refresh(spark, land, root, as_of, products=feeds.products(spark, sf), stores=feeds.stores(spark, sf), gate=False)
    return SnapshotTable(spark, f"{root}/gold/dim_customer").read()


# ------------------------------------------------------------- streaming
def q_stream_pos_upsert(spark, sf):
    from strata.streaming.streams import stream_pos_upsert

    return stream_pos_upsert(spark, sf)


def q_stream_dedupe(spark, sf):
    from strata.streaming.streams import stream_dedupe_clicks

    return stream_dedupe_clicks(spark, sf)


def q_stream_sessions(spark, sf):
    from strata.streaming.streams import stream_session_counts

    return stream_session_counts(spark, sf)


def q_late_events(spark, sf):
    from strata.streaming.streams import late_events

    return late_events(spark, sf)


def q_late_sessions(spark, sf):
    from strata.streaming.streams import late_sessions

    return late_sessions(spark, sf)


QUERIES: dict[str, Query] = {
    "ingest_pos": q_ingest_pos,
    "ingest_inventory": q_ingest_inventory,
    "ingest_customers": q_ingest_customers,
    "ingest_clicks": q_ingest_clicks,
    "clean_transactions": q_clean_transactions,
    "clean_inventory": q_clean_inventory,
    "clean_customers": q_clean_customers,
    "dedupe_latest": q_dedupe_latest,
    "rejects_by_reason": q_rejects_by_reason,
    "conform_schema": q_conform_schema,
    "conform_raw": q_conform_raw,
    "conform_drift": q_conform_drift,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_reasons": q_quarantine_reasons,
    "sessionise": q_sessionise,
    "session_window_counts": q_session_window_counts,
    "customer_360": q_customer_360,
    "customer_360_ext": q_customer_360_ext,
    "preferred_payment": q_preferred_payment,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "dim_store": q_dim_store,
    "dim_date": q_dim_date,
    "fact_sales": q_fact_sales,
    "fact_sales_asof": q_fact_sales_asof,
    "scd2_merge": q_scd2_merge,
    "fact_sales_asof_sliced": q_fact_sales_asof_sliced,
    "scd2_any_order": q_scd2_any_order,
    "sales_summary": q_sales_summary,
    "customer_360_view": q_customer_360_view,
    "inventory_snapshot": q_inventory_snapshot,
    "upsert_orders": q_upsert_orders,
    "upsert_orders_partitioned": q_upsert_orders_partitioned,
    "upsert_orders_bucketed": q_upsert_orders_bucketed,
    "time_travel": q_time_travel,
    "zorder_layout": q_zorder_layout,
    "hilbert_layout": q_hilbert_layout,
    "maintained_table": q_maintained_table,
    "vacuum_history": q_vacuum_history,
    "incremental_load": q_incremental_load,
    "hourly_incremental": q_hourly_incremental,
    "hourly_customer_360": q_hourly_customer_360,
    "hourly_clicks": q_hourly_clicks,
    "dq_bronze": q_dq_bronze,
    "dq_silver": q_dq_silver,
    "dq_gold": q_dq_gold,
    "dq_results": q_dq_results,
    "pk_check": q_pk_check,
    "check_constraints": q_check_constraints,
    "fk_orphans": q_fk_orphans,
    "layer_counts": q_layer_counts,
    "daily_refresh": q_daily_refresh,
    "daily_two_days": q_daily_two_days,
    "dq_gate": q_dq_gate,
    "stream_pos_upsert": q_stream_pos_upsert,
    "stream_dedupe": q_stream_dedupe,
    "stream_sessions": q_stream_sessions,
    "late_events": q_late_events,
    "late_sessions": q_late_sessions,
}
