"""Table registry: one ``StructType`` per ``{layer}_{entity}`` table, plus
``conform`` (cast a DataFrame to its registered schema) and
``schema_violations`` (count NULLs in non-nullable columns in one pass).

Timestamps are ``TIMESTAMP_NTZ``: the feeds carry local wall-clock times with
no zone, and NTZ keeps results independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, L, B, TS = StringType(), IntegerType(), LongType(), BooleanType(), TimestampNTZType()


def D(p: int, s: int = 2) -> DecimalType:
    return DecimalType(p, s)


def _schema(*cols: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in cols])


_INGEST = (("_ingested_at", TS, True), ("_source_file", S, True))
_SCD = (("_valid_from", TS, False), ("_valid_to", TS, True), ("_is_current", B, False))

SCHEMAS: dict[str, StructType] = {
    # bronze: raw strings + ingestion metadata, all nullable
    "bronze_pos_transactions": _schema(
        *[(c, S, True) for c in ("transaction_id", "store_id", "product_id", "customer_id",
                                 "quantity", "unit_price", "sale_date", "payment_method")],
        *_INGEST,
    ),
    "bronze_inventory_movements": _schema(
        *[(c, S, True) for c in ("movement_id", "warehouse_id", "product_id", "movement_type",
                                 "quantity", "movement_date")],
        *_INGEST,
    ),
    "bronze_customers": _schema(
        *[(c, S, True) for c in ("customer_id", "name", "email", "phone", "address", "city",
                                 "country", "signup_date")],
        *_INGEST,
    ),
    "bronze_clickstream": _schema(
        *[(c, S, True) for c in ("event_id", "session_id", "customer_id", "page_url",
                                 "event_type", "timestamp", "device_type")],
        *_INGEST,
    ),
    # silver: typed, cleaned, PII hashed
    "silver_pos_transactions": _schema(
        ("transaction_id", S, False), ("store_id", S, False), ("product_id", S, False),
        ("customer_id", S, True), ("quantity", I, False), ("unit_price", D(12), False),
        ("sale_date", TS, True), ("payment_method", S, True), ("total_amount", D(14), True),
        ("_processed_at", TS, False),
    ),
    "silver_inventory_movements": _schema(
        ("movement_id", S, False), ("warehouse_id", S, False), ("product_id", S, False),
        ("movement_type", S, False), ("quantity", I, False), ("movement_date", TS, True),
        ("_processed_at", TS, False),
    ),
    "silver_customers": _schema(
        ("customer_id", S, False), ("name_hash", S, True), ("email_hash", S, True),
        ("phone_hash", S, True), ("address_hash", S, True), ("city", S, True),
        ("country", S, True), ("signup_date", TS, True), ("_processed_at", TS, False),
    ),
    "silver_clickstream": _schema(
        ("event_id", S, False), ("customer_id", S, True), ("page_url", S, True),
        ("event_type", S, True), ("event_timestamp", TS, False), ("device_type", S, True),
        ("session_id", S, False), ("session_start", TS, False), ("session_end", TS, False),
        ("session_duration_seconds", L, False), ("_processed_at", TS, False),
    ),
    # gold: star schema and aggregates
    "gold_dim_customer": _schema(
        ("customer_sk", L, False), ("customer_bk", S, False), ("name_hash", S, True),
        ("email_hash", S, True), ("city", S, True), ("country", S, True),
        ("signup_date", TS, True), *_SCD,
    ),
    "gold_dim_product": _schema(
        ("product_sk", L, False), ("product_bk", S, False), ("product_name", S, True),
        ("category", S, True), ("sub_category", S, True), ("unit_cost", D(12), True), *_SCD,
    ),
    "gold_dim_store": _schema(
        ("store_sk", L, False), ("store_bk", S, False), ("store_name", S, True),
        ("city", S, True), ("country", S, True), ("region", S, True), *_SCD,
    ),
    "gold_dim_date": _schema(
        ("date_sk", I, False), ("full_date", TS, False), ("year", I, False),
        ("quarter", I, False), ("month", I, False), ("month_name", S, False),
        ("day", I, False), ("day_of_week", I, False), ("day_name", S, False),
        ("is_weekend", B, False),
    ),
    "gold_fact_sales": _schema(
        ("transaction_id", S, False), ("customer_sk", L, True), ("product_sk", L, True),
        ("store_sk", L, True), ("date_sk", I, True), ("quantity", I, False),
        ("unit_price", D(12), False), ("total_amount", D(14), False),
        ("payment_method", S, True), ("_processed_at", TS, False),
    ),
    "gold_fact_inventory_snapshot": _schema(
        ("snapshot_id", S, False), ("warehouse_id", S, False), ("product_sk", L, True),
        ("date_sk", I, True), ("units_in", L, False), ("units_out", L, False),
        ("net_movement", L, False), ("_processed_at", TS, False),
    ),
    "gold_agg_customer_360": _schema(
        ("customer_bk", S, False), ("total_orders", L, False), ("total_spend", D(16), False),
        ("avg_order_value", D(12), True), ("first_purchase_date", TS, True),
        ("last_purchase_date", TS, True), ("preferred_payment_method", S, True),
        ("lifetime_value_tier", S, True), ("_processed_at", TS, False),
    ),
}

# Primary keys (the DDL's PRIMARY KEY constraints); dimensions with history are
# unique on (bk) only among current rows.
PRIMARY_KEYS: dict[str, list[str]] = {
    "silver_pos_transactions": ["transaction_id"],
    "silver_inventory_movements": ["movement_id"],
    "silver_customers": ["customer_id"],
    "silver_clickstream": ["event_id"],
    "gold_dim_customer": ["customer_sk"],
    "gold_dim_product": ["product_sk"],
    "gold_dim_store": ["store_sk"],
    "gold_dim_date": ["date_sk"],
    "gold_fact_sales": ["transaction_id"],
    "gold_fact_inventory_snapshot": ["snapshot_id"],
    "gold_agg_customer_360": ["customer_bk"],
}


# Keys that are unique under a condition: (name, columns, condition).
CONDITIONAL_KEYS: dict[str, list[tuple[str, list[str], str]]] = {
    t: [(f"{c}_current", [c], "_is_current")]
    for t, c in (("gold_dim_customer", "customer_bk"), ("gold_dim_product", "product_bk"), ("gold_dim_store", "store_bk"))
}

# CHECK rules (fixed values, as declared for the tables): column and what holds for its non-NULL values.
CHECKS: dict[str, list[tuple[str, str]]] = {
    "silver_pos_transactions": [("quantity", "quantity > 0"), ("unit_price", "unit_price > 0")],
    "silver_inventory_movements": [("movement_type", "movement_type IN ('IN', 'OUT')"), ("quantity", "quantity > 0")],
    "gold_dim_date": [
        ("quarter", "quarter BETWEEN 1 AND 4"), ("month", "month BETWEEN 1 AND 12"),
        ("day", "day BETWEEN 1 AND 31"), ("day_of_week", "day_of_week BETWEEN 1 AND 7"),
    ],
    "gold_fact_sales": [("quantity", "quantity > 0")],
}


def get_schema(table_name: str) -> StructType:
    """The registered layout of a table; ``KeyError`` if it has none."""
    try:
        return SCHEMAS[table_name]
    except KeyError:
        raise KeyError(f"no layout is registered for {table_name!r}") from None


def list_schemas() -> list[str]:
    return sorted(SCHEMAS.keys())


def conform(df: DataFrame, table_name: str, strict: bool = False) -> DataFrame:
    """Select the registry columns in registry order, ``try_cast`` each to its
    registered type. Missing columns raise; extra columns are dropped.
    ``strict`` additionally drops rows with NULL in a non-nullable column."""
    schema = get_schema(table_name)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for {table_name}: {missing}")
    out = df.select(
        [
            (F.col(f.name) if df.schema[f.name].dataType == f.dataType
             else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
    if strict:
        for f in schema:
            if not f.nullable:
                out = out.filter(F.col(f.name).isNotNull())
    return out


#: The column that keeps what a layout has no place for.
REST = "_rest"


def conform_drift(df: DataFrame, table_name: str) -> DataFrame:
    """``df`` in the registered layout, whatever its columns are, without loss:
    a column that is missing is NULL, and the map ``_rest`` (name -> text) holds
    the values of columns that the layout does not know and values that do not
    cast to their column's type (the column is NULL then). A ``_rest`` that the
    input has already is kept; its entries give way to those of this call."""
    schema = get_schema(table_name)
    known = {f.name for f in schema}

    def text(name: str):
        kind = df.schema[name].dataType
        plain = not isinstance(kind, (ArrayType, MapType, StructType))
        return (F.col(name).cast("string") if plain else F.to_json(F.col(name))) if name != REST else F.col(name)

    columns, rest = [], []
    for f in schema:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[f.name].dataType == f.dataType:
            columns.append(F.col(f.name))
        else:
            value = F.col(f.name).try_cast(f.dataType)
            columns.append(value.alias(f.name))
            rest.append((f.name, F.when(value.isNull(), text(f.name))))
    rest += [(c, text(c)) for c in df.columns if c not in known and c != REST]
    entries = F.filter(F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in rest]) if rest else F.array().cast("array<struct<key:string,value:string>>"), lambda e: e["value"].isNotNull())
    out = F.map_from_entries(entries)
    if REST in df.columns:
        new = F.array_compact(F.array(F.lit(""), *[F.when(v.isNotNull(), F.lit(n)) for n, v in rest]))
        old = F.coalesce(F.col(REST), F.create_map().cast("map<string,string>"))
        out = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(new, k)), out)
    # apart from the casts: inside a lambda a name would mean the column of that name being made
    return df.withColumn("_rest_made", out).select(*columns, F.col("_rest_made").alias(REST))


def schema_violations(df: DataFrame, table_name: str) -> DataFrame:
    """One row per registry column: (table_name, column_name, data_type,
    nullable, null_count, cast_failures), computed in a single aggregation.

    ``cast_failures`` counts values that are non-NULL before and NULL after the
    cast to the registry type."""
    schema = get_schema(table_name)
    aggs = []
    for i, f in enumerate(schema):
        src = F.col(f.name)
        casted = src if df.schema[f.name].dataType == f.dataType else src.try_cast(f.dataType)
        aggs.append(F.count_if(casted.isNull()).alias(f"n{i}"))
        aggs.append(F.count_if(src.isNotNull() & casted.isNull()).alias(f"c{i}"))
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(table_name).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.col(f"n{i}").alias("null_count"),
                F.col(f"c{i}").alias("cast_failures"),
            )
            for i, f in enumerate(schema)
        ]
    )
    return one.select(F.inline(rows))
