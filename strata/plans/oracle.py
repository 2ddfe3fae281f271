"""ANSI SQL (DuckDB dialect) equivalents of the registered queries, for the
correctness gate. Each statement starts from the base tables (lineitem,
orders, customer, ...) and replays the whole chain as CTEs, written the
straightforward way (global windows, plain GROUP BY) so it checks the
scale-oriented Spark plans independently.

An increment or a stream must give what one batch over all rows gives, so
those queries share the batch's statement.
"""

from __future__ import annotations

from strata.plans import layers as L
from strata.sources.feeds import (
    ANON_CUSTOMER_MOD, BAD_DATE_MOD, BAD_MOVEMENT_MOD, BAD_QTY_MOD, NULL_STORE_MOD,
    ANON_CLICK_MOD, PAYMENT_BY_FLAGS, REPEAT_CLICK_MOD, WAREHOUSES, ZERO_QTY_MOD,
)

AS_OF = f"TIMESTAMP '{L.AS_OF}'"
S = "CAST({} AS VARCHAR)".format


def _payment_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAYMENT_BY_FLAGS)
    return f"CASE l.l_returnflag || l.l_linestatus {whens} END"


RAW_POS = f"""raw_pos AS (
  SELECT 'T' || {S('l.l_orderkey')} || '-' || {S('l.l_linenumber')} AS transaction_id,
    CASE WHEN l.l_orderkey % {NULL_STORE_MOD} = 0 THEN NULL ELSE 'S' || {S('l.l_suppkey')} END AS store_id,
    'P' || {S('l.l_partkey')} AS product_id,
    CASE WHEN o.o_custkey % {ANON_CUSTOMER_MOD} = 0 THEN NULL ELSE 'C' || {S('o.o_custkey')} END AS customer_id,
    CASE WHEN (l.l_orderkey + l.l_partkey) % {BAD_QTY_MOD} = 0 THEN 'bad' WHEN (l.l_orderkey + l.l_partkey) % {ZERO_QTY_MOD} = 0 THEN '0'
         ELSE {S('CAST(l.l_quantity AS BIGINT)')} END AS quantity,
    {S('CAST(l.l_extendedprice AS DECIMAL(12,2))')} AS unit_price,
    CASE WHEN (l.l_orderkey + l.l_suppkey) % {BAD_DATE_MOD} = 0 THEN 'not-a-date' ELSE {S('l.l_shipdate')} END AS sale_date,
    {_payment_case()} AS payment_method
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

POS_REST = ["store_id", "product_id", "customer_id", "quantity", "unit_price", "sale_date", "payment_method"]


def _order_rest(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


def silver_pos_ctes(src: str, p: str) -> str:
    """CTEs {p}_dedup, {p}_typed, {p}_silver over the raw POS relation ``src``."""
    return f"""{p}_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
      ORDER BY store_id IS NOT NULL AND product_id IS NOT NULL AND coalesce(TRY_CAST(quantity AS INTEGER) > 0, FALSE)
          AND coalesce(TRY_CAST(unit_price AS DECIMAL(12,2)) > 0, FALSE) DESC,
        TRY_CAST(sale_date AS TIMESTAMP) DESC NULLS LAST, store_id ASC NULLS LAST, product_id ASC NULLS LAST,
        customer_id ASC NULLS LAST, TRY_CAST(quantity AS INTEGER) ASC NULLS LAST,
        TRY_CAST(unit_price AS DECIMAL(12,2)) ASC NULLS LAST, upper(trim(payment_method)) ASC NULLS LAST,
        {_order_rest(POS_REST)}) AS rn
    FROM {src} WHERE transaction_id IS NOT NULL) WHERE rn = 1
),
{p}_typed AS (
  SELECT transaction_id, store_id, product_id, customer_id,
    TRY_CAST(quantity AS INTEGER) AS quantity,
    TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
    TRY_CAST(sale_date AS TIMESTAMP) AS sale_date,
    upper(trim(payment_method)) AS payment_method,
    TRY_CAST(CAST(TRY_CAST(quantity AS INTEGER) AS DECIMAL(12,2)) * TRY_CAST(unit_price AS DECIMAL(12,2))
             AS DECIMAL(14,2)) AS total_amount,
    CASE WHEN store_id IS NULL THEN 'null_store_id'
         WHEN product_id IS NULL THEN 'null_product_id'
         WHEN TRY_CAST(quantity AS INTEGER) IS NULL THEN 'bad_quantity'
         WHEN TRY_CAST(quantity AS INTEGER) <= 0 THEN 'non_positive_quantity'
         WHEN TRY_CAST(unit_price AS DECIMAL(12,2)) IS NULL THEN 'bad_unit_price'
         WHEN TRY_CAST(unit_price AS DECIMAL(12,2)) <= 0 THEN 'non_positive_unit_price'
    END AS reject_reason
  FROM {p}_dedup
),
{p}_silver AS (
  SELECT transaction_id, store_id, product_id, customer_id, quantity, unit_price, sale_date,
    payment_method, total_amount, {AS_OF} AS _processed_at
  FROM {p}_typed WHERE reject_reason IS NULL
)"""


POS = f"WITH {RAW_POS},\n{silver_pos_ctes('raw_pos', 'pos')}"

RAW_CUSTOMERS = f"""raw_customers AS (
  SELECT 'C' || {S('c.c_custkey')} AS customer_id, c.c_name AS name,
    'customer' || {S('c.c_custkey')} || '@example.com' AS email,
    '+1-555-' || {S('c.c_custkey')} AS phone,
    {S('c.c_custkey')} || ' Market Street' AS address,
    n.n_name || '/' || c.c_mktsegment AS city,
    n.n_name AS country,
    {S('f.first_order')} AS signup_date
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
    ON c.c_custkey = f.o_custkey
),
cust_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY TRY_CAST(signup_date AS TIMESTAMP) DESC NULLS LAST,
      {_order_rest(['name', 'email', 'phone', 'address', 'city', 'country', 'signup_date'])}) AS rn
    FROM raw_customers WHERE customer_id IS NOT NULL) WHERE rn = 1
),
silver_customers AS (
  SELECT customer_id, sha256(name) AS name_hash, sha256(email) AS email_hash,
    sha256(phone) AS phone_hash, sha256(address) AS address_hash, city, country,
    TRY_CAST(signup_date AS TIMESTAMP) AS signup_date, {AS_OF} AS _processed_at
  FROM cust_dedup
)"""

DIM_CUSTOMER = f"""dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id AS customer_bk,
    name_hash, email_hash, city, country, signup_date,
    {AS_OF} AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current
  FROM silver_customers
)"""

PRODUCTS = f"""products AS (
  SELECT 'P' || {S('p_partkey')} AS product_id, p_name AS product_name, p_type AS category,
    p_brand AS sub_category, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost
  FROM part
)"""


def dim_product_cte(silver: str) -> str:
    return f"""{PRODUCTS},
dim_product AS (
  SELECT row_number() OVER (ORDER BY s.product_id) AS product_sk, s.product_id AS product_bk,
    p.product_name, p.category, p.sub_category, p.unit_cost,
    {AS_OF} AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current
  FROM (SELECT DISTINCT product_id FROM {silver}) s LEFT JOIN products p ON s.product_id = p.product_id
)"""


DIM_STORE = f"""stores AS (
  SELECT 'S' || {S('s.s_suppkey')} AS store_id, s.s_name AS store_name, CAST(NULL AS VARCHAR) AS city,
    n.n_name AS country, r.r_name AS region
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_store AS (
  SELECT row_number() OVER (ORDER BY store_id) AS store_sk, store_id AS store_bk, store_name, city,
    country, region, {AS_OF} AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current
  FROM stores
)"""


def dim_date_cte(silver: str) -> str:
    return f"""days AS (
  SELECT CAST(unnest(generate_series(CAST(min(sale_date) AS DATE), CAST(max(sale_date) AS DATE),
                                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM {silver}
),
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk,
    CAST(d AS TIMESTAMP) AS full_date, CAST(year(d) AS INTEGER) AS year,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day,
    CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
  FROM days
)"""


def _date_sk(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


FACT = f"""fact_sales AS (
  SELECT f.transaction_id, dc.customer_sk, dp.product_sk, ds.store_sk, {_date_sk('f.sale_date')} AS date_sk,
    f.quantity, f.unit_price, f.total_amount, f.payment_method, {AS_OF} AS _processed_at
  FROM pos_silver f
  LEFT JOIN dim_customer dc ON f.customer_id = dc.customer_bk AND dc._is_current
  LEFT JOIN dim_product dp ON f.product_id = dp.product_bk AND dp._is_current
  LEFT JOIN dim_store ds ON f.store_id = ds.store_bk AND ds._is_current
)"""

GOLD = f"{POS},\n{RAW_CUSTOMERS},\n{DIM_CUSTOMER},\n{dim_product_cte('pos_silver')},\n{DIM_STORE},\n{FACT}"

C360 = f"""c360_base AS (
  SELECT customer_id AS customer_bk, count(transaction_id) AS total_orders,
    sum(total_amount) AS s, count(total_amount) AS n,
    sum(CAST(total_amount * 100 AS BIGINT)) AS cents,
    min(sale_date) AS first_purchase_date, max(sale_date) AS last_purchase_date
  FROM pos_silver WHERE customer_id IS NOT NULL GROUP BY customer_id
),
pay_counts AS (
  SELECT customer_id, payment_method, count(*) AS n FROM pos_silver
  WHERE customer_id IS NOT NULL AND payment_method IS NOT NULL GROUP BY customer_id, payment_method
),
pay_best AS (
  SELECT customer_id, payment_method, n FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, payment_method ASC) AS rn
    FROM pay_counts) WHERE rn = 1
),
c360 AS (
  SELECT b.customer_bk, CAST(b.total_orders AS BIGINT) AS total_orders,
    CAST(b.s AS DECIMAL(16,2)) AS total_spend,
    CAST(CAST((2 * b.cents + b.n) // NULLIF(2 * b.n, 0) AS DECIMAL(18,2)) * 0.01 AS DECIMAL(12,2)) AS avg_order_value,
    b.first_purchase_date, b.last_purchase_date, p.payment_method AS preferred_payment_method,
    CASE WHEN CAST(b.s AS DECIMAL(16,2)) >= 10000 THEN 'PLATINUM'
         WHEN CAST(b.s AS DECIMAL(16,2)) >= 5000 THEN 'GOLD'
         WHEN CAST(b.s AS DECIMAL(16,2)) >= 1000 THEN 'SILVER' ELSE 'BRONZE' END AS lifetime_value_tier,
    {AS_OF} AS _processed_at
  FROM c360_base b LEFT JOIN pay_best p ON b.customer_bk = p.customer_id
)"""

RAW_INV = f"""raw_inventory AS (
  SELECT 'M' || {S('l_orderkey')} || '-' || {S('l_linenumber')} AS movement_id,
    'W' || {S(f'l_suppkey % {WAREHOUSES}')} AS warehouse_id,
    'P' || {S('l_partkey')} AS product_id,
    CASE WHEN (l_orderkey + l_partkey) % {BAD_MOVEMENT_MOD} = 0 THEN 'XX' WHEN l_returnflag = 'R' THEN 'in ' ELSE 'OUT' END
      AS movement_type,
    {S('CAST(l_quantity AS BIGINT)')} AS quantity,
    {S('l_shipdate')} AS movement_date
  FROM lineitem
),
inv_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY movement_id
      ORDER BY product_id IS NOT NULL AND warehouse_id IS NOT NULL AND upper(trim(movement_type)) IN ('IN', 'OUT')
          AND coalesce(TRY_CAST(quantity AS INTEGER) > 0, FALSE) DESC,
        TRY_CAST(movement_date AS TIMESTAMP) DESC NULLS LAST,
      {_order_rest(['warehouse_id', 'product_id', 'movement_type', 'quantity', 'movement_date'])}) AS rn
    FROM raw_inventory WHERE movement_id IS NOT NULL) WHERE rn = 1
),
silver_inventory AS (
  SELECT movement_id, warehouse_id, product_id, upper(trim(movement_type)) AS movement_type,
    TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(movement_date AS TIMESTAMP) AS movement_date,
    {AS_OF} AS _processed_at
  FROM inv_dedup
  WHERE product_id IS NOT NULL AND warehouse_id IS NOT NULL
    AND upper(trim(movement_type)) IN ('IN', 'OUT') AND TRY_CAST(quantity AS INTEGER) > 0
)"""

EVENTS = f"""ev_raw AS (
  SELECT 'E' || CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN event_id % {ANON_CLICK_MOD} <> 0 THEN 'C' || CAST(user_id AS VARCHAR) END AS customer_id,
    '/' || event_type AS page_url, event_type, ts AS event_timestamp, CAST(NULL AS VARCHAR) AS device_type
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % {REPEAT_CLICK_MOD} = 0)
),
ev AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC NULLS LAST,
      customer_id ASC NULLS LAST, page_url ASC NULLS LAST, event_type ASC NULLS LAST) AS rn
    FROM ev_raw WHERE event_id IS NOT NULL) WHERE rn = 1
),
ev_gap AS (
  SELECT *, lag(event_timestamp) OVER (PARTITION BY customer_id ORDER BY event_timestamp) AS prev
  FROM ev WHERE customer_id IS NOT NULL AND event_timestamp IS NOT NULL
),
ev_start AS (
  SELECT *, max(CASE WHEN prev IS NULL OR date_diff('microsecond', prev, event_timestamp) > 1800000000
                     THEN event_timestamp END)
         OVER (PARTITION BY customer_id ORDER BY event_timestamp
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start
  FROM ev_gap
),
ev_sess AS (
  SELECT *, max(event_timestamp) OVER (PARTITION BY customer_id, session_start) AS session_end
  FROM ev_start
)"""


def _customers_day(n: int) -> str:
    k = "CAST(substring(customer_id, 2, 20) AS BIGINT)"
    if n == 1:
        return f"""cust_day1 AS (
  SELECT customer_id, name_hash,
    CASE WHEN {k} % 10 = 7 THEN NULL ELSE email_hash END AS email_hash,
    CASE WHEN {k} % 10 = 3 THEN 'OLD/' || city WHEN {k} % 25 = 0 THEN NULL ELSE city END AS city,
    country, signup_date
  FROM silver_customers WHERE signup_date < TIMESTAMP '{L.CHANGE_AT}'
)"""
    return f"""cust_day2 AS (
  SELECT customer_id, name_hash, email_hash,
    CASE WHEN {k} % 40 = 1 THEN NULL ELSE city END AS city, country, signup_date
  FROM silver_customers
)"""


ATTRS = ["name_hash", "email_hash", "city", "country", "signup_date"]
HISTORY = f"""{_customers_day(1)},
{_customers_day(2)},
hv1 AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id AS customer_bk,
    {', '.join(ATTRS)}, TIMESTAMP '{L.HISTORY_START}' AS _valid_from,
    CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current
  FROM cust_day1
),
hj AS (
  SELECT t.*, s.customer_id AS s_bk, {', '.join(f's.{a} AS s_{a}' for a in ATTRS)},
    (t.customer_bk IS NOT NULL AND s.customer_id IS NOT NULL
     AND NOT ({' AND '.join(f't.{a} IS NOT DISTINCT FROM s.{a}' for a in ATTRS)})) AS changed
  FROM hv1 t FULL OUTER JOIN cust_day2 s ON t.customer_bk = s.customer_id
),
customer_history AS (
  SELECT customer_sk, customer_bk, {', '.join(ATTRS)}, _valid_from,
    CASE WHEN changed THEN TIMESTAMP '{L.CHANGE_AT}' ELSE _valid_to END AS _valid_to,
    CASE WHEN changed THEN FALSE ELSE _is_current END AS _is_current
  FROM hj WHERE customer_bk IS NOT NULL
  UNION ALL
  SELECT (SELECT max(customer_sk) FROM hv1) + row_number() OVER (ORDER BY s_bk) AS customer_sk,
    s_bk AS customer_bk, {', '.join(f's_{a} AS {a}' for a in ATTRS)},
    TIMESTAMP '{L.CHANGE_AT}' AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current
  FROM hj WHERE s_bk IS NOT NULL AND (customer_bk IS NULL OR changed)
)"""

# the history of three snapshots, from all that they say, in the order of time
_SAID = f"SELECT customer_id AS bk, TIMESTAMP '{{at}}' AS moment, TRUE AS there, {', '.join(ATTRS)} FROM {{rel}}"
ANY_ORDER = f"""{_customers_day(1)},
{_customers_day(2)},
cust_between AS (
  SELECT customer_id, name_hash, email_hash,
    CASE WHEN k % 6 = 1 THEN 'MID/' || city WHEN k % 10 = 3 THEN regexp_replace(city, '^OLD/', '') ELSE city END AS city, country, signup_date
  FROM (SELECT *, CAST(substring(customer_id, 2, 20) AS BIGINT) AS k FROM cust_day1) WHERE k % 17 <> 0
),
said AS (
  {_SAID.format(at=L.HISTORY_START, rel="cust_day1")} UNION ALL
  {_SAID.format(at=L.BETWEEN, rel="cust_between")} UNION ALL
  {_SAID.format(at=L.CHANGE_AT, rel="cust_day2")}
),
every AS (
  SELECT b.bk, t.moment, coalesce(s.there, FALSE) AS there, {', '.join(f's.{a}' for a in ATTRS)}
  FROM (SELECT DISTINCT bk FROM said) b CROSS JOIN (SELECT DISTINCT moment FROM said) t LEFT JOIN said s ON s.bk = b.bk AND s.moment = t.moment
),
steps AS (
  SELECT *, lag(there) OVER w AS was, {', '.join(f'lag({a}) OVER w AS was_{a}' for a in ATTRS)} FROM every WINDOW w AS (PARTITION BY bk ORDER BY moment)
),
changes AS (
  SELECT *, lead(moment) OVER (PARTITION BY bk ORDER BY moment) AS until FROM steps
  WHERE there IS DISTINCT FROM was OR there AND ({' OR '.join(f'{a} IS DISTINCT FROM was_{a}' for a in ATTRS)})
)"""

ORDERS = f"""orders_day1 AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderdate >= TIMESTAMP '{L.DAY2_START}' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate
  FROM orders WHERE o_orderdate < TIMESTAMP '{L.DAY1_CUTOFF}'
),
orders_batch2 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
  FROM orders WHERE o_orderdate >= TIMESTAMP '{L.DAY2_START}'
)"""


def _suite_rows(suite: str, rel: str, rules: list[tuple]) -> str:
    """rules: (rule_id, expectation, column, kind, arg) -> UNION ALL of rows."""
    parts = []
    for rid, exp, col, kind, arg in rules:
        cn = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        head = f"SELECT '{suite}' AS suite, {rid} AS rule_id, '{exp}' AS expectation, {cn} AS column_name"
        if kind == "count":
            lo, hi = arg
            parts.append(f"{head}, count(*) AS element_count, "
                         f"CASE WHEN count(*) BETWEEN {lo} AND {hi} THEN 0 ELSE 1 END AS unexpected_count, "
                         f"count(*) BETWEEN {lo} AND {hi} AS success FROM {rel}")
        elif kind == "exists":
            parts.append(f"{head}, CAST(NULL AS BIGINT) AS element_count, 0 AS unexpected_count, TRUE AS success")
        elif kind == "notnull":
            ok = (f"(count(*) - count_if({col} IS NULL)) >= {arg} * count(*)" if arg
                  else f"count_if({col} IS NULL) = 0")
            parts.append(f"{head}, count(*) AS element_count, count_if({col} IS NULL) AS unexpected_count, "
                         f"{ok} AS success FROM {rel}")
        elif kind == "between":
            lo, hi = arg
            bad = f"count_if({col} IS NOT NULL AND ({col} < {lo} OR {col} > {hi}))"
            parts.append(f"{head}, count(*) AS element_count, {bad} AS unexpected_count, {bad} = 0 AS success FROM {rel}")
        elif kind == "inset":
            vals = ", ".join(f"'{v}'" for v in arg)
            bad = f"count_if({col} IS NOT NULL AND {col} NOT IN ({vals}))"
            parts.append(f"{head}, count(*) AS element_count, {bad} AS unexpected_count, {bad} = 0 AS success FROM {rel}")
        elif kind == "unique":
            parts.append(
                f"{head}, COALESCE(sum(k), 0) AS element_count, COALESCE(sum(CASE WHEN k > 1 THEN k END), 0) "
                f"AS unexpected_count, COALESCE(sum(CASE WHEN k > 1 THEN k END), 0) = 0 AS success "
                f"FROM (SELECT {col}, count(*) AS k FROM {rel} WHERE {col} IS NOT NULL GROUP BY {col})"
            )
    return "\nUNION ALL\n".join(
        f"SELECT suite, CAST(rule_id AS INTEGER) AS rule_id, expectation, column_name, "
        f"CAST(element_count AS BIGINT) AS element_count, CAST(unexpected_count AS BIGINT) AS unexpected_count, "
        f"success FROM ({p})" for p in parts
    )


def _pk(name: str, rel: str, key: str, where: str = "TRUE") -> str:
    return (f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows, "
            f"CAST(count_if({key} IS NULL) AS BIGINT) AS null_keys, "
            f"CAST((SELECT count(*) FROM (SELECT {key} FROM {rel} WHERE {where} AND {key} IS NOT NULL "
            f"GROUP BY {key} HAVING count(*) > 1)) AS BIGINT) AS duplicate_keys FROM {rel} WHERE {where}")


def _constraints(table: str, query: str, schemas) -> str:
    key = schemas.PRIMARY_KEYS[table][0]
    again = "(SELECT count(*) FROM (SELECT {k} FROM t WHERE {k} IS NOT NULL AND {c} GROUP BY {k} HAVING count(*) > 1))"
    rows = [("primary_key", key, f"count_if({key} IS NULL) + {again.format(k=key, c='TRUE')}")]
    rows += [("unique", n, again.format(k=k[0], c=c)) for n, k, c in schemas.CONDITIONAL_KEYS.get(table, [])]
    rows += [("not_null", f.name, f"count_if({f.name} IS NULL)") for f in schemas.SCHEMAS[table] if not f.nullable]
    rows += [("check", rule, f"count_if(NOT ({rule}))") for _, rule in schemas.CHECKS.get(table, [])]
    text = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{kind}' AS kind, '{name.replace(chr(39), chr(39) * 2)}' AS name, count(*) AS rows, CAST({v} AS BIGINT) AS violations FROM t"
        for kind, name, v in rows)
    return f"SELECT * FROM (WITH t AS MATERIALIZED (SELECT * FROM ({query})) {text})"


def _quarantine_reasons() -> str:
    """Each feed's copies ranked as its dedupe ranks them, and all rules that a copy breaks."""
    def positive(c: str, v: str) -> list[tuple[str, str]]:
        return [(f"bad_{c}", f"{v} IS NULL"), (f"non_positive_{c}", f"{v} <= 0")]

    quantity, price = "TRY_CAST(quantity AS INTEGER)", "TRY_CAST(unit_price AS DECIMAL(12,2))"
    pos_ok = f"store_id IS NOT NULL AND product_id IS NOT NULL AND coalesce({quantity} > 0, FALSE) AND coalesce({price} > 0, FALSE)"
    kind = "coalesce(upper(trim(movement_type)) IN ('IN', 'OUT'), FALSE)"
    inv_ok = f"product_id IS NOT NULL AND warehouse_id IS NOT NULL AND {kind} AND coalesce({quantity} > 0, FALSE)"
    null = lambda *cs: [(f"null_{c}", f"{c} IS NULL") for c in cs]
    feeds = [
        ("pos_transactions", "raw_pos", "transaction_id", f"{pos_ok} DESC, TRY_CAST(sale_date AS TIMESTAMP) DESC NULLS LAST, store_id ASC NULLS LAST, product_id ASC NULLS LAST, "
         f"customer_id ASC NULLS LAST, {quantity} ASC NULLS LAST, {price} ASC NULLS LAST, upper(trim(payment_method)) ASC NULLS LAST, {_order_rest(POS_REST)}",
         null("transaction_id", "store_id", "product_id") + positive("quantity", quantity) + positive("unit_price", price)),
        ("inventory_movements", "raw_inventory", "movement_id", f"{inv_ok} DESC, TRY_CAST(movement_date AS TIMESTAMP) DESC NULLS LAST, "
         + _order_rest(["warehouse_id", "product_id", "movement_type", "quantity", "movement_date"]),
         null("movement_id", "warehouse_id", "product_id") + [("bad_movement_type", f"NOT {kind}")] + positive("quantity", quantity)),
        ("customers", "raw_customers", "customer_id", "TRY_CAST(signup_date AS TIMESTAMP) DESC NULLS LAST, name", null("customer_id")),
        ("clickstream", "ev_raw", "event_id", "event_timestamp DESC NULLS LAST, customer_id ASC NULLS LAST", null("event_id")),
    ]
    parts = []
    for feed, rel, key, order, rules in feeds:
        reasons = ", ".join(f"CASE WHEN {bad} THEN '{r}' END" for r, bad in rules)
        parts.append(
            f"SELECT '{feed}' AS feed, concat_ws(',', {reasons}, CASE WHEN {key} IS NOT NULL AND rn > 1 THEN 'duplicate' END) AS reasons, {key} IS NOT NULL AND rn > 1 AS lost "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {rel})")
    return (f"WITH {RAW_POS},\n{RAW_INV},\n{RAW_CUSTOMERS},\n{EVENTS}\nSELECT feed, reasons, count(*) AS rows, count_if(lost) AS with_winner FROM ("
            + "\nUNION ALL\n".join(parts) + ") GROUP BY feed, reasons")


def _fk(fk: str, dim: str, pk: str) -> str:
    return (f"SELECT '{fk}' AS fk_name, CAST(count_if(f.{fk} IS NULL) AS BIGINT) AS null_refs, "
            f"CAST(count_if(f.{fk} IS NOT NULL AND f.{fk} NOT IN (SELECT {pk} FROM {dim} WHERE {pk} IS NOT NULL)) "
            f"AS BIGINT) AS orphan_refs FROM fact_sales f")


SILVER_COLS = [
    ("transaction_id", "string", False), ("store_id", "string", False), ("product_id", "string", False),
    ("customer_id", "string", True), ("quantity", "int", False), ("unit_price", "decimal(12,2)", False),
    ("sale_date", "timestamp_ntz", True), ("payment_method", "string", True),
    ("total_amount", "decimal(14,2)", True), ("_processed_at", "timestamp_ntz", False),
]


POS_QUARANTINE = f"""pos_quarantine AS (
  SELECT d.*, {AS_OF} AS _ingested_at, 'lineitem' AS _source_file, t.reject_reason, {AS_OF} AS _processed_at
  FROM pos_dedup d JOIN pos_typed t ON d.transaction_id = t.transaction_id WHERE t.reject_reason IS NOT NULL
  UNION ALL
  SELECT *, {AS_OF}, 'lineitem', 'null_transaction_id', {AS_OF} FROM raw_pos WHERE transaction_id IS NULL
)"""


def _duck_type(t: str) -> str:
    return {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}.get(t, t.upper())


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_pos"] = f"WITH {RAW_POS} SELECT *, {AS_OF} AS _ingested_at FROM raw_pos"
    q["ingest_inventory"] = (f"WITH {RAW_INV} SELECT movement_id, warehouse_id, product_id, movement_type, "
                             f"quantity, movement_date, {AS_OF} AS _ingested_at FROM raw_inventory")
    q["ingest_customers"] = (f"WITH {RAW_CUSTOMERS} SELECT customer_id, name, email, phone, address, city, "
                             f"country, signup_date, {AS_OF} AS _ingested_at FROM raw_customers")
    q["ingest_clicks"] = (
        f"WITH {EVENTS} SELECT event_id, CAST(NULL AS VARCHAR) AS session_id, customer_id, page_url, event_type, "
        "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, device_type, "
        f"{AS_OF} AS _ingested_at FROM ev_raw"
    )
    q["clean_transactions"] = f"{POS} SELECT * FROM pos_silver"
    q["dedupe_latest"] = f"{POS} SELECT * FROM pos_dedup"
    q["rejects_by_reason"] = f"""{POS}
SELECT COALESCE(reject_reason, 'accepted') AS outcome, CAST(count(*) AS BIGINT) AS rows FROM pos_typed GROUP BY 1
UNION ALL SELECT 'null_transaction_id', CAST(count_if(transaction_id IS NULL) AS BIGINT) FROM raw_pos
UNION ALL SELECT 'duplicate', CAST(COALESCE(sum(k - 1), 0) AS BIGINT) FROM
  (SELECT transaction_id, count(*) AS k FROM raw_pos WHERE transaction_id IS NOT NULL GROUP BY 1)"""
    q["conform_schema"] = f"{POS}\n" + "\nUNION ALL\n".join(
        f"SELECT 'silver_pos_transactions' AS table_name, '{c}' AS column_name, '{t}' AS data_type, "
        f"{'TRUE' if n else 'FALSE'} AS nullable, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"CAST(0 AS BIGINT) AS cast_failures FROM pos_silver"
        for c, t, n in SILVER_COLS
    )
    q["conform_raw"] = f"WITH {RAW_POS}, raw_all AS (SELECT *, NULL AS total_amount, '{L.AS_OF}' AS _processed_at FROM raw_pos)\n" + "\nUNION ALL\n".join(
        f"SELECT 'silver_pos_transactions' AS table_name, '{c}' AS column_name, '{t}' AS data_type, {'TRUE' if n else 'FALSE'} AS nullable, "
        f"CAST(count_if(TRY_CAST({c} AS {_duck_type(t)}) IS NULL) AS BIGINT) AS null_count, "
        f"CAST(count_if({c} IS NOT NULL AND TRY_CAST({c} AS {_duck_type(t)}) IS NULL) AS BIGINT) AS cast_failures FROM raw_all"
        for c, t, n in SILVER_COLS
    )
    q["quarantine_rows"] = f"{POS},\n{POS_QUARANTINE} SELECT * FROM pos_quarantine"
    q["clean_inventory"] = f"WITH {RAW_INV} SELECT * FROM silver_inventory"
    q["clean_customers"] = f"WITH {RAW_CUSTOMERS} SELECT * FROM silver_customers"
    q["sessionise"] = f"""WITH {EVENTS}
SELECT event_id, customer_id, page_url, event_type, event_timestamp, device_type,
  customer_id || '-' || strftime(session_start, '%Y%m%d%H%M%S%f') AS session_id,
  session_start, session_end,
  CAST(date_diff('microsecond', session_start, session_end) // 1000000 AS BIGINT) AS session_duration_seconds,
  {AS_OF} AS _processed_at
FROM ev_sess
UNION ALL
SELECT event_id, customer_id, page_url, event_type, event_timestamp, device_type,
  NULL, NULL, NULL, NULL, {AS_OF} FROM ev WHERE customer_id IS NULL OR event_timestamp IS NULL"""
    q["hourly_clicks"] = q["sessionise"]
    q["stream_dedupe"] = f"WITH {EVENTS} SELECT * FROM ev"
    q["stream_sessions"] = f"""WITH {EVENTS},
closed AS (
  SELECT customer_id, session_start AS window_start, max(event_timestamp) + INTERVAL 1800 SECOND AS window_end,
    CAST(count(*) AS BIGINT) AS events
  FROM ev_sess GROUP BY customer_id, session_start
)
SELECT * FROM closed WHERE window_end <= (SELECT max(event_timestamp) FROM ev) - INTERVAL 10 MINUTE"""
    q["session_window_counts"] = f"""WITH {EVENTS}
SELECT customer_id, session_start AS window_start,
  max(event_timestamp) + INTERVAL 1800 SECOND AS window_end, CAST(count(*) AS BIGINT) AS events
FROM ev_sess GROUP BY customer_id, session_start"""
    q["customer_360"] = f"{POS},\n{C360} SELECT * FROM c360"
    q["preferred_payment"] = f"""{POS},\n{C360}
SELECT customer_id AS customer_bk, payment_method AS preferred_payment_method, CAST(n AS BIGINT) AS method_count
FROM pay_best"""
    q["customer_360_ext"] = f"""{POS},\n{dim_product_cte('pos_silver')},
ext_rows AS (
  SELECT s.*, d.category FROM pos_silver s
  LEFT JOIN dim_product d ON s.product_id = d.product_bk AND d._is_current
  WHERE s.customer_id IS NOT NULL
),
cat_counts AS (
  SELECT customer_id, category, count(*) AS n FROM ext_rows WHERE category IS NOT NULL GROUP BY 1, 2
),
cat_best AS (
  SELECT customer_id, category FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, category ASC) AS rn
    FROM cat_counts) WHERE rn = 1
),
g AS (
  SELECT customer_id, count(*) AS total_orders, count(sale_date) AS dated,
    date_diff('day', CAST(min(sale_date) AS DATE), CAST(max(sale_date) AS DATE)) AS span_days
  FROM ext_rows GROUP BY customer_id
)
SELECT g.customer_id AS customer_bk, CAST(g.total_orders AS BIGINT) AS total_orders,
  CAST(g.span_days AS INTEGER) AS active_days,
  CASE WHEN g.dated >= 2 THEN CAST(CAST((2 * g.span_days * 100 + (g.dated - 1)) // (2 * (g.dated - 1))
       AS DECIMAL(18,2)) * 0.01 AS DECIMAL(12,2)) END AS purchase_frequency_days,
  c.category AS preferred_category
FROM g LEFT JOIN cat_best c ON g.customer_id = c.customer_id"""
    q["dim_customer"] = f"WITH {RAW_CUSTOMERS},\n{DIM_CUSTOMER} SELECT * FROM dim_customer"
    q["dim_product"] = f"{POS},\n{dim_product_cte('pos_silver')} SELECT * FROM dim_product"
    q["dim_store"] = f"WITH {DIM_STORE} SELECT * FROM dim_store"
    q["dim_date"] = f"{POS},\n{dim_date_cte('pos_silver')} SELECT * FROM dim_date"
    q["fact_sales"] = f"{GOLD} SELECT * FROM fact_sales"
    q["scd2_merge"] = f"WITH {RAW_CUSTOMERS},\n{HISTORY} SELECT * FROM customer_history"
    q["fact_sales_asof"] = f"""{POS},\n{RAW_CUSTOMERS},\n{HISTORY}
SELECT f.transaction_id, f.customer_id, h.customer_sk, f.sale_date, {_date_sk('f.sale_date')} AS date_sk,
  f.total_amount
FROM pos_silver f LEFT JOIN customer_history h
  ON f.customer_id = h.customer_bk AND f.sale_date >= h._valid_from
 AND (h._valid_to IS NULL OR f.sale_date < h._valid_to)"""
    q["sales_summary"] = f"""{GOLD},\n{dim_date_cte('pos_silver')},
daily AS (
  SELECT date_sk, store_sk, product_sk, CAST(sum(total_amount) AS DECIMAL(18,2)) AS daily_revenue,
    CAST(sum(quantity) AS BIGINT) AS daily_units_sold, CAST(count(transaction_id) AS BIGINT) AS transaction_count
  FROM fact_sales GROUP BY date_sk, store_sk, product_sk
)
SELECT dd.full_date, dd.year, dd.month, dd.month_name, ds.store_bk AS store_id, ds.store_name, ds.region,
  dp.category, dp.sub_category, x.daily_revenue, x.daily_units_sold, x.transaction_count
FROM daily x
LEFT JOIN dim_date dd ON x.date_sk = dd.date_sk
LEFT JOIN dim_store ds ON x.store_sk = ds.store_sk AND ds._is_current
LEFT JOIN dim_product dp ON x.product_sk = dp.product_sk AND dp._is_current"""
    q["customer_360_view"] = f"""{POS},\n{C360},\n{RAW_CUSTOMERS},\n{DIM_CUSTOMER}
SELECT c.customer_bk, c.total_orders, c.total_spend, c.avg_order_value, c.first_purchase_date,
  c.last_purchase_date, c.preferred_payment_method, c.lifetime_value_tier, d.city, d.country, d.signup_date
FROM dim_customer d INNER JOIN c360 c ON d.customer_bk = c.customer_bk WHERE d._is_current"""
    q["inventory_snapshot"] = f"""{POS},\n{RAW_INV},\n{dim_product_cte('pos_silver')},
inv AS (
  SELECT warehouse_id, product_id, {_date_sk('movement_date')} AS date_sk,
    COALESCE(sum(CASE WHEN movement_type = 'IN' THEN CAST(quantity AS BIGINT) END), 0) AS units_in,
    COALESCE(sum(CASE WHEN movement_type = 'OUT' THEN CAST(quantity AS BIGINT) END), 0) AS units_out
  FROM silver_inventory GROUP BY 1, 2, 3
)
SELECT concat_ws('|', i.warehouse_id, i.product_id, COALESCE(CAST(i.date_sk AS VARCHAR), 'none')) AS snapshot_id,
  i.warehouse_id, d.product_sk, i.date_sk, CAST(i.units_in AS BIGINT) AS units_in,
  CAST(i.units_out AS BIGINT) AS units_out, CAST(i.units_in - i.units_out AS BIGINT) AS net_movement,
  {AS_OF} AS _processed_at
FROM inv i LEFT JOIN dim_product d ON i.product_id = d.product_bk AND d._is_current"""
    merged_orders = """SELECT t.* FROM orders_day1 t
WHERE NOT EXISTS (SELECT 1 FROM orders_batch2 s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM orders_batch2"""
    q["upsert_orders"] = f"WITH {ORDERS} {merged_orders}"
    for same in ("upsert_orders_partitioned", "upsert_orders_bucketed"):
        q[same] = q["upsert_orders"]
    q["time_travel"] = f"WITH {ORDERS} SELECT * FROM orders_day1"
    q["vacuum_history"] = f"""WITH {ORDERS}, merged AS ({merged_orders})
SELECT 2 AS version, 'MERGE' AS operation, CAST(count(*) AS BIGINT) AS rows FROM merged
UNION ALL SELECT 3, 'OPTIMIZE', CAST(count(*) AS BIGINT) FROM merged"""
    q["zorder_layout"] = q["hilbert_layout"] = "SELECT * FROM lineitem"
    q["maintained_table"] = "SELECT * FROM orders"
    q["daily_two_days"] = q["scd2_merge"]
    q["fact_sales_asof_sliced"] = q["fact_sales_asof"]
    q["quarantine_reasons"] = _quarantine_reasons()
    misfit = lambda c, t: f"CASE WHEN TRY_CAST({c} AS {t}) IS NULL THEN {c} END"
    q["conform_drift"] = f"""WITH {RAW_POS}
SELECT transaction_id, TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price, TRY_CAST(sale_date AS TIMESTAMP) AS sale_date,
  CAST(NULL AS DECIMAL(14,2)) AS total_amount, CASE WHEN rest_quantity IS NULL THEN 0 ELSE 1 END + CASE WHEN rest_sale_date IS NULL THEN 0 ELSE 1 END + CASE WHEN rest_coupon IS NULL THEN 0 ELSE 1 END AS n_rest,
  rest_quantity, rest_sale_date, rest_coupon
FROM (SELECT *, {misfit('quantity', 'INTEGER')} AS rest_quantity, {misfit('sale_date', 'TIMESTAMP')} AS rest_sale_date, CASE WHEN store_id IS NULL THEN 'none' END AS rest_coupon FROM raw_pos)"""
    q["scd2_any_order"] = f"""WITH {RAW_CUSTOMERS},\n{ANY_ORDER}
SELECT bk AS customer_bk, {', '.join(ATTRS)}, moment AS _valid_from, until AS _valid_to, until IS NULL AS _is_current FROM changes WHERE there"""
    q["late_sessions"] = q["sessionise"]
    q["late_events"] = f"""WITH {EVENTS},
ends AS (SELECT min(ts) AS lo, (max(ts) - min(ts)) / 4 AS step FROM events),
-- the feed in four slices of time, every tenth event one slice late
came AS (
  SELECT event_id, event_timestamp, CASE WHEN event_timestamp < lo + step THEN 1 WHEN event_timestamp < lo + step * 2 THEN 2 WHEN event_timestamp < lo + step * 3 THEN 3 ELSE 4 END
    + CASE WHEN CAST(substring(event_id, 2) AS BIGINT) % 10 = 3 THEN 1 ELSE 0 END AS slice
  FROM ev_raw, ends
),
marks AS (SELECT slice, max(max(event_timestamp)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS mark FROM came GROUP BY slice)
SELECT DISTINCT event_id, coalesce(event_timestamp < mark, FALSE) AS late FROM came JOIN marks USING (slice)"""
    from strata import schemas

    held = {
        "silver_pos_transactions": "clean_transactions", "silver_inventory_movements": "clean_inventory", "silver_customers": "clean_customers",
        "silver_clickstream": "sessionise", "gold_dim_customer": "dim_customer", "gold_dim_product": "dim_product", "gold_dim_store": "dim_store",
        "gold_dim_date": "dim_date", "gold_fact_sales": "fact_sales", "gold_fact_inventory_snapshot": "inventory_snapshot", "gold_agg_customer_360": "customer_360",
    }
    q["check_constraints"] = "\nUNION ALL\n".join(_constraints(t, q[name], schemas) for t, name in held.items())
    q["hourly_customer_360"] = q["customer_360"]
    for same in ("incremental_load", "hourly_incremental", "stream_pos_upsert"):
        q[same] = q["clean_transactions"]
    q["dq_bronze"] = f"""{POS},
bronze AS (SELECT *, {AS_OF} AS _ingested_at FROM raw_pos)
""" + _suite_rows("bronze_pos_transactions", "bronze", [
        (0, "expect_table_row_count_to_be_between", None, "count", (1, 10000000)),
        (1, "expect_column_to_exist", "transaction_id", "exists", None),
        (2, "expect_column_to_exist", "_ingested_at", "exists", None),
        (3, "expect_column_to_exist", "_source_file", "exists", None),
        (4, "expect_column_values_to_not_be_null", "transaction_id", "notnull", "0.99"),
        (5, "expect_column_values_to_not_be_null", "_ingested_at", "notnull", None),
    ])
    q["dq_silver"] = f"{POS}\n" + _suite_rows("silver_pos_transactions", "pos_silver", [
        (0, "expect_table_row_count_to_be_between", None, "count", (1, 10000000)),
        (1, "expect_column_values_to_not_be_null", "transaction_id", "notnull", None),
        (2, "expect_column_values_to_be_unique", "transaction_id", "unique", None),
        (3, "expect_column_values_to_not_be_null", "store_id", "notnull", None),
        (4, "expect_column_values_to_not_be_null", "product_id", "notnull", None),
        (5, "expect_column_values_to_be_between", "quantity", "between", (1, 10000)),
        (6, "expect_column_values_to_be_between", "unit_price", "between", ("0.01", 100000)),
        (7, "expect_column_values_to_be_in_set", "payment_method", "inset", ["CASH", "CARD", "DIGITAL", "VOUCHER"]),
        (8, "expect_column_values_to_not_be_null", "_processed_at", "notnull", None),
    ])
    q["dq_gold"] = f"{GOLD}\n" + _suite_rows("gold_fact_sales", "fact_sales", [
        (0, "expect_table_row_count_to_be_between", None, "count", (1, 50000000)),
        (1, "expect_column_values_to_not_be_null", "transaction_id", "notnull", None),
        (2, "expect_column_values_to_be_unique", "transaction_id", "unique", None),
        (3, "expect_column_values_to_not_be_null", "quantity", "notnull", None),
        (4, "expect_column_values_to_not_be_null", "total_amount", "notnull", None),
        (5, "expect_column_values_to_be_between", "quantity", "between", (1, 10000)),
        (6, "expect_column_values_to_be_between", "total_amount", "between", ("0.01", 10000000)),
        (7, "expect_column_values_to_not_be_null", "_processed_at", "notnull", None),
    ])
    gates = {"bronze": "TRUE", "silver": "(SELECT b FROM ok)", "gold": "(SELECT b AND s FROM ok)"}
    from strata.plans.jobs import TABLES

    q["dq_gate"] = f"""WITH ok AS (SELECT (SELECT bool_and(success) FROM ({q['dq_bronze']})) AS b, (SELECT bool_and(success) FROM ({q['dq_silver']})) AS s, (SELECT bool_and(success) FROM ({q['dq_gold']})) AS g)
""" + " UNION ALL ".join(f"SELECT '{layer}.{name}' AS step, {gates[layer]} AS written, (SELECT NOT (b AND s AND g) FROM ok) AS stopped" for layer, names in TABLES.items() for name in names)
    q["dq_results"] = "\nUNION ALL\n".join(
        f"SELECT *, {AS_OF} AS run_at FROM ({q[suite]})" for suite in ("dq_bronze", "dq_silver", "dq_gold"))
    q["pk_check"] = f"""{GOLD},\n{dim_date_cte('pos_silver')},\n{C360},\n{RAW_INV},\n{EVENTS},
inv_keys AS (SELECT concat_ws('|', warehouse_id, product_id, COALESCE(CAST(date_sk AS VARCHAR), 'none')) AS snapshot_id FROM (
  SELECT warehouse_id, product_id, {_date_sk('movement_date')} AS date_sk FROM silver_inventory GROUP BY ALL))
""" + "\nUNION ALL\n".join([
        _pk("silver_inventory_movements", "silver_inventory", "movement_id"),
        _pk("silver_customers", "silver_customers", "customer_id"),
        _pk("silver_clickstream", "ev", "event_id"),
        _pk("gold_fact_sales", "fact_sales", "transaction_id"),
        _pk("gold_fact_inventory_snapshot", "inv_keys", "snapshot_id"),
        _pk("silver_pos_transactions", "pos_silver", "transaction_id"),
        _pk("gold_dim_customer", "dim_customer", "customer_sk"),
        _pk("gold_dim_customer_current_bk", "dim_customer", "customer_bk", "_is_current"),
        _pk("gold_dim_product", "dim_product", "product_sk"),
        _pk("gold_dim_store", "dim_store", "store_sk"),
        _pk("gold_dim_date", "dim_date", "date_sk"),
        _pk("gold_agg_customer_360", "c360", "customer_bk"),
    ])
    q["fk_orphans"] = f"""{GOLD},\n{dim_date_cte('pos_silver')}
""" + "\nUNION ALL\n".join([
        _fk("customer_sk", "dim_customer", "customer_sk"),
        _fk("product_sk", "dim_product", "product_sk"),
        _fk("store_sk", "dim_store", "store_sk"),
        _fk("date_sk", "dim_date", "date_sk"),
    ])
    q["layer_counts"] = f"""{POS}
SELECT 'bronze' AS stage, CAST(count(*) AS BIGINT) AS rows FROM raw_pos
UNION ALL SELECT 'deduped', CAST(count(*) AS BIGINT) FROM pos_dedup
UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM pos_silver"""
    # daily refresh: the row count of every table the job writes
    daily_steps = [
        ("bronze.pos_transactions", "raw_pos"),
        ("bronze.inventory_movements", "raw_inventory"),
        ("bronze.customers", "raw_customers"),
        ("bronze.clickstream", "ev_raw"),
        ("silver.pos_transactions", "pos_silver"),
        ("silver.inventory_movements", "silver_inventory"),
        ("silver.customers", "silver_customers"),
        ("silver.clickstream", "ev"),
        *[(f"quarantine.{t}", f"(SELECT unnest(range(CAST(rows AS BIGINT))) FROM ({_quarantine_reasons()}) WHERE feed = '{t}' AND reasons <> '')")
          for t in ("pos_transactions", "inventory_movements", "customers", "clickstream")],
        *[(f"quarantine.{t}_lines", "(SELECT 1 WHERE FALSE)")
          for t in ("pos_transactions", "inventory_movements", "customers", "clickstream")],
        ("gold.dim_customer", "dim_customer"),
        ("gold.dim_product", "dim_product"),
        ("gold.dim_store", "dim_store"),
        ("gold.dim_date", "dim_date"),
        ("gold.fact_sales", "fact_sales"),
        ("gold.agg_customer_360", "c360"),
        ("gold.fact_inventory_snapshot", "inv_snapshot"),
    ]
    q["daily_refresh"] = (
        f"{GOLD},\n{dim_date_cte('pos_silver')},\n{C360},\n{RAW_INV},\n{EVENTS},\n{POS_QUARANTINE},\n"
        "inv_snapshot AS (SELECT DISTINCT warehouse_id, product_id, "
        f"{_date_sk('movement_date')} AS date_sk FROM silver_inventory)\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{step}' AS step, CAST(count(*) AS BIGINT) AS rows FROM {rel}"
            for step, rel in daily_steps
        )
    )
    return q
