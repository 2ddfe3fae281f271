"""Silver: deduplicated, typed, validated feeds.

One winner rule holds for batch, hourly job and stream: of the rows with one
business key an accepted row (its values parse and pass the range rules) beats
a rejected one, then the latest ingestion wins, then the latest *parsed* event
time (unparsable times last), then a total order over the typed row. So a copy
that does not parse never hides a good row, and a merge that applies the same
order between table and batch gives what one batch over all rows gives.
Rows with a NULL id are dropped first, so the NULL key stays out of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.casts import norm_upper, to_decimal, to_int, to_ts
from strata.functions.pii import hash_pii
from strata.operators.dedupe import dedupe_latest, total_order
from strata.operators.sessions import gap_sessions
from strata.schemas import REST

# Valid code sets.
VALID_PAYMENT_METHODS = ["CASH", "CARD", "DIGITAL", "VOUCHER"]
VALID_MOVEMENT_TYPES = ["IN", "OUT"]
SESSION_TIMEOUT_SECONDS = 1800

META = ["_ingested_at", "_source_file"]


def _ts_lit(as_of) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def _latest_first(df: DataFrame, event_time: Column, accepted: Column | None = None) -> list[Column]:
    order = [] if accepted is None else [F.coalesce(accepted, F.lit(False)).desc()]
    if "_ingested_at" in df.columns:
        order.append(F.col("_ingested_at").desc_nulls_last())
    return [*order, event_time.desc_nulls_last()]


# --------------------------------------------------------------------- POS
def pos_deduped(bronze: DataFrame) -> DataFrame:
    b = bronze.filter(F.col("transaction_id").isNotNull())
    return dedupe_latest(b, ["transaction_id"], _pos_order(b))


def _pos_order(b: DataFrame) -> list[Column]:
    order = _latest_first(b, to_ts("sale_date"), _pos_reject_reason(to_int("quantity"), to_decimal("unit_price", 12, 2)).isNull())
    typed = [F.col("store_id"), F.col("product_id"), F.col("customer_id"), to_int("quantity"),
             to_decimal("unit_price", 12, 2), norm_upper("payment_method")]
    return [*order, *[c.asc_nulls_last() for c in typed]]


def silver_pos_order() -> list[Column]:
    """The same winner between silver rows of one id (all accepted): the
    later run, then as within a batch."""
    rest = ["store_id", "product_id", "customer_id", "quantity", "unit_price", "payment_method"]
    return [F.col("_processed_at").desc_nulls_last(), F.col("sale_date").desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in rest]]


def _pos_reject_reason(quantity: Column, unit_price: Column) -> Column:
    """NULL = accepted."""
    return (
        F.when(F.col("store_id").isNull(), "null_store_id")
        .when(F.col("product_id").isNull(), "null_product_id")
        .when(quantity.isNull(), "bad_quantity")
        .when(quantity <= 0, "non_positive_quantity")
        .when(unit_price.isNull(), "bad_unit_price")
        .when(unit_price <= 0, "non_positive_unit_price")
    )


def _with_total(typed: DataFrame) -> DataFrame:
    total = (F.col("quantity").cast("decimal(12,2)") * F.col("unit_price")).try_cast("decimal(14,2)")
    return typed.withColumn("total_amount", total)


def pos_typed(deduped: DataFrame) -> DataFrame:
    """Casts and derived columns plus ``_reject_reason`` (NULL = accepted)."""
    q, p = to_int("quantity"), to_decimal("unit_price", 12, 2)
    t = deduped.withColumns(
        {
            "_raw_quantity": F.col("quantity"),
            "_raw_unit_price": F.col("unit_price"),
            "quantity": q,
            "unit_price": p,
            "sale_date": to_ts("sale_date"),
            "payment_method": norm_upper("payment_method"),
        }
    )
    return _with_total(t).withColumn("_reject_reason", _pos_reject_reason(F.col("quantity"), F.col("unit_price")))


SILVER_POS_COLUMNS = [
    "transaction_id", "store_id", "product_id", "customer_id", "quantity", "unit_price",
    "sale_date", "payment_method", "total_amount", "_processed_at",
]


def clean_transactions(bronze: DataFrame, as_of, strict: bool = False) -> DataFrame:
    """Bronze POS -> silver POS (``silver_pos_transactions`` columns).

    By default unknown payment methods and unparsable sale dates stay (the DQ
    suite reports them). ``strict`` also
    drops rows whose method is outside VALID_PAYMENT_METHODS or whose sale
    date is missing, as the registry's NOT NULL / the valid set demand."""
    t = _with_total(_pos_accepted(bronze))
    if strict:
        t = t.filter(F.col("payment_method").isin(*VALID_PAYMENT_METHODS) & F.col("sale_date").isNotNull())
    return t.withColumn("_processed_at", _ts_lit(as_of)).select(*SILVER_POS_COLUMNS)


def _pos_accepted(bronze: DataFrame) -> DataFrame:
    """The accepted winner of each id, typed. An accepted copy beats a rejected
    one and silver is made of typed values alone, so rows are typed and judged
    before the shuffle, which carries neither rejected rows nor raw text."""
    b = bronze.filter(F.col("transaction_id").isNotNull())
    t = b.select(
        "transaction_id", "store_id", "product_id", "customer_id", to_int("quantity").alias("quantity"),
        to_decimal("unit_price", 12, 2).alias("unit_price"), norm_upper("payment_method").alias("payment_method"),
        to_ts("sale_date").alias("sale_date"), *[c for c in META[:1] if c in b.columns],
    ).filter(_pos_reject_reason(F.col("quantity"), F.col("unit_price")).isNull())
    return dedupe_latest(t, ["transaction_id"], _latest_first(t, F.col("sale_date")))


def split_rejects(bronze: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(silver rows, quarantined rows with ``reject_reason`` and raw values)."""
    t = pos_typed(pos_deduped(bronze))
    good = t.filter(F.col("_reject_reason").isNull()).withColumn(
        "_processed_at", _ts_lit(as_of)
    ).select(*SILVER_POS_COLUMNS)
    bad = t.filter(F.col("_reject_reason").isNotNull()).select(
        "transaction_id", "store_id", "product_id",
        F.col("_raw_quantity").alias("quantity"), F.col("_raw_unit_price").alias("unit_price"),
        F.col("_reject_reason").alias("reject_reason"), _ts_lit(as_of).alias("_processed_at"),
    )
    return good, bad


def pos_quarantine(bronze: DataFrame, as_of) -> DataFrame:
    """The rows that are kept out of silver, as they were delivered (all raw
    columns and the ingestion metadata), with ``reject_reason``: rows without
    an id and ids whose best copy is rejected. (Copies that lose the dedupe
    are counted by ``pos_outcomes``; bronze keeps them.)"""
    reason = _pos_reject_reason(to_int("quantity"), to_decimal("unit_price", 12, 2))
    # an accepted copy beats all others: the whole rows shuffled are rejected ones
    ids = bronze.filter(F.col("transaction_id").isNotNull())
    accepted = ids.filter(reason.isNull()).select("transaction_id").distinct()
    rejected = ids.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())
    bad = pos_deduped(rejected.join(accepted, "transaction_id", "left_anti").select(*bronze.columns)).withColumn("reject_reason", reason)
    none = bronze.filter(F.col("transaction_id").isNull()).withColumn("reject_reason", F.lit("null_transaction_id"))
    return bad.unionByName(none).withColumn("_processed_at", _ts_lit(as_of))


def pos_outcomes(bronze: DataFrame) -> DataFrame:
    """Where every bronze row went: (outcome, rows). Outcomes: accepted, the
    reject reasons, duplicate (lost the dedupe), null_transaction_id. The rows
    add up to the bronze row count. Two passes over bronze (the dedupe and
    one grouping by id), each pre-aggregated map-side; no row-level data
    reaches the driver."""
    per = (
        pos_typed(pos_deduped(bronze))
        .groupBy(F.coalesce(F.col("_reject_reason"), F.lit("accepted")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # NULL ids and losers of the dedupe from one grouping of bronze by id
    # (the NULL group, however large, is pre-aggregated map-side).
    k = F.col("_k")
    by_id = bronze.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_k"))
    other = by_id.agg(
        F.coalesce(F.sum(F.when(F.col("transaction_id").isNull(), k)), F.lit(0)).alias("_null"),
        F.coalesce(F.sum(F.when(F.col("transaction_id").isNotNull(), k - 1)), F.lit(0)).alias("_dup"),
    ).select(F.inline(F.array(
        F.struct(F.lit("null_transaction_id").alias("outcome"), F.col("_null").alias("rows")),
        F.struct(F.lit("duplicate").alias("outcome"), F.col("_dup").alias("rows")),
    )))
    return per.unionByName(other).select(
        "outcome", F.col("rows").cast("long").alias("rows")
    )


# --------------------------------------------------------------- inventory
SILVER_INV_COLUMNS = [
    "movement_id", "warehouse_id", "product_id", "movement_type", "quantity",
    "movement_date", "_processed_at",
]


def clean_inventory(bronze: DataFrame, as_of) -> DataFrame:
    b = bronze.filter(F.col("movement_id").isNotNull())
    accepted = (
        F.col("product_id").isNotNull() & F.col("warehouse_id").isNotNull()
        & norm_upper("movement_type").isin(*VALID_MOVEMENT_TYPES) & (to_int("quantity") > 0)
    )
    # an accepted copy wins, so the others need no shuffle; nor do columns that silver lacks
    used = ["movement_id", "warehouse_id", "product_id", "movement_type", "quantity", "movement_date", "_ingested_at"]
    b = b.filter(accepted).select(*[c for c in b.columns if c in used])
    d = dedupe_latest(b, ["movement_id"], _latest_first(b, to_ts("movement_date")))
    return (
        d.withColumns(
            {
                "quantity": to_int("quantity"),
                "movement_date": to_ts("movement_date"),
                "movement_type": norm_upper("movement_type"),
            }
        )
        .withColumn("_processed_at", _ts_lit(as_of))
        .select(*SILVER_INV_COLUMNS)
    )


# --------------------------------------------------------------- customers
PII_COLUMNS = ["name", "email", "phone", "address"]
SILVER_CUST_COLUMNS = [
    "customer_id", "name_hash", "email_hash", "phone_hash", "address_hash", "city",
    "country", "signup_date", "_processed_at",
]


def clean_customers(bronze: DataFrame, as_of, salt: str | None = None, normalise: bool = False) -> DataFrame:
    b = bronze.filter(F.col("customer_id").isNotNull())
    d = dedupe_latest(b, ["customer_id"], _latest_first(b, to_ts("signup_date")))
    return (
        hash_pii(d, PII_COLUMNS, salt=salt, normalise=normalise)
        .withColumn("signup_date", to_ts("signup_date"))
        .withColumn("_processed_at", _ts_lit(as_of))
        .select(*SILVER_CUST_COLUMNS)
    )


# ------------------------------------------------------------- clickstream
SILVER_CLICK_COLUMNS = [
    "event_id", "customer_id", "page_url", "event_type", "event_timestamp", "device_type",
    "session_id", "session_start", "session_end", "session_duration_seconds", "_processed_at",
]


def parse_clicks(bronze: DataFrame) -> DataFrame:
    """Bronze clickstream (text timestamp) -> typed events. Fields that the feed
    does not know stay in bronze."""
    return bronze.withColumn("event_timestamp", to_ts("timestamp")).drop("timestamp", REST)


def sessionise(events: DataFrame, as_of, gap_seconds: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Event grain: dedupe on event id, then gap sessions per customer.

    ``session_id`` = customer id + session start (microsecond text). Events
    without a customer or a time stay, with NULL session columns."""
    e = events.filter(F.col("event_id").isNotNull())
    e = dedupe_latest(e, ["event_id"], _latest_first(e, F.col("event_timestamp")))
    e = e.drop(*[c for c in META + ["session_id"] if c in e.columns])
    s = gap_sessions(e, "customer_id", "event_timestamp", gap_seconds)
    return s.withColumn(
        "session_id",
        F.concat(F.col("customer_id"), F.lit("-"),
                 F.date_format("session_start", "yyyyMMddHHmmssSSSSSS")),
    ).withColumn("_processed_at", _ts_lit(as_of)).select(*SILVER_CLICK_COLUMNS)


# -------------------------------------------------------------- quarantine
def _feed_rules(feed: str) -> tuple[str, list[tuple[str, Column]]]:
    """(key, every rule of the feed as (reason, what breaks it))."""
    def null(c: str) -> tuple[str, Column]:
        return f"null_{c}", F.col(c).isNull()

    def positive(c: str, value: Column) -> list[tuple[str, Column]]:
        return [(f"bad_{c}", value.isNull()), (f"non_positive_{c}", F.coalesce(value <= 0, F.lit(False)))]

    if feed == "pos_transactions":
        return "transaction_id", [null("transaction_id"), null("store_id"), null("product_id"), *positive("quantity", to_int("quantity")), *positive("unit_price", to_decimal("unit_price", 12, 2))]
    if feed == "inventory_movements":
        kind = ~F.coalesce(norm_upper("movement_type").isin(*VALID_MOVEMENT_TYPES), F.lit(False))
        return "movement_id", [null("movement_id"), null("warehouse_id"), null("product_id"), ("bad_movement_type", kind), *positive("quantity", to_int("quantity"))]
    if feed == "customers":
        return "customer_id", [null("customer_id")]
    if feed == "clickstream":
        return "event_id", [null("event_id")]
    raise ValueError(f"no feed {feed!r}")


def _winner_order(rows: DataFrame, feed: str) -> list[Column]:
    """The copy of a key that silver takes is the first one."""
    if feed == "pos_transactions":
        return _pos_order(rows)
    if feed == "inventory_movements":
        good = F.col("product_id").isNotNull() & F.col("warehouse_id").isNotNull() & norm_upper("movement_type").isin(*VALID_MOVEMENT_TYPES) & (to_int("quantity") > 0)
        return _latest_first(rows, to_ts("movement_date"), good)
    time = {"customers": "signup_date", "clickstream": "timestamp"}[feed]
    return _latest_first(rows, to_ts(time))


#: Copies of a key that one task ranks; a key with more is dealt over all tasks.
HOT_COPIES = 100_000


def _hot_keys(rows: DataFrame, key: str) -> list[str]:
    """Keys with more than about ``HOT_COPIES`` copies, by a sketch of bounded
    size; what it says decides how rows are dealt, not what they become."""
    top = rows.filter(F.col(key).isNotNull()).select(F.expr(f"approx_top_k({key}, 1000, 10000)")).first()[0]
    return [x["item"] for x in top or [] if x["count"] > HOT_COPIES]


def judged(bronze: DataFrame, feed: str, as_of) -> DataFrame:
    """Every bronze row of a feed as delivered, with ``reasons``: all rules that
    it breaks (none: accepted), and ``duplicate`` if another copy of its key is
    taken, whose key is ``winner``. So each row is accepted or has its reasons.

    Rows are dealt by key once and ranked there. Rows without a key and those
    of hot keys are dealt over all tasks; the first of each task's copies of a
    hot key are then ranked against each other."""
    key, rules = _feed_rules(feed)
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for reason, bad in rules]))
    hot = _hot_keys(bronze, key)
    spread = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    tasks = int(bronze.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = bronze.withColumn("_deal", F.when(spread, F.pmod(F.monotonically_increasing_id(), F.lit(tasks))).otherwise(F.lit(-1)))

    def ranked(rows: DataFrame, rank: str) -> DataFrame:
        # dealt first, so the values that rows are ordered by are made where they are used
        by = Window.partitionBy(key, "_deal").orderBy(*total_order(bronze, [key], _winner_order(bronze, feed)))
        return rows.repartition(key, "_deal").withColumn(rank, F.row_number().over(by))

    rows = ranked(rows, "_rank")
    taken = F.col("_rank") == 1
    if hot:
        rows = ranked(rows.withColumn("_deal", F.when(F.col(key).isin(hot) & taken, F.lit(-1)).otherwise(F.col("_deal"))), "_last")
        taken = taken & (F.col("_last") == 1)
    lost = F.col(key).isNotNull() & ~taken
    return (
        rows.withColumn("reasons", F.concat(broken, F.when(lost, F.array(F.lit("duplicate"))).otherwise(F.array().cast("array<string>"))))
        .withColumn("winner", F.when(lost, F.col(key)))
        .withColumn("_processed_at", _ts_lit(as_of))
        .drop(*[c for c in ("_deal", "_rank", "_last") if c in rows.columns])
    )


def quarantine(bronze: DataFrame, feed: str, as_of) -> DataFrame:
    """The rows of ``judged`` that silver does not take."""
    return judged(bronze, feed, as_of).filter(F.size("reasons") > 0)
