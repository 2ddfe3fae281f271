import pytest
from pyspark.sql.types import DecimalType, LongType, StringType

from strata import schemas


def test_registry_lists_fifteen_sorted():
    names = schemas.list_schemas()
    assert len(names) == 15 and names == sorted(names)


def test_unknown_table_raises():
    with pytest.raises(KeyError, match="no layout is registered"):
        schemas.get_schema("gold_nothing")


def test_types():
    s = schemas.get_schema("silver_pos_transactions")
    assert s["unit_price"].dataType == DecimalType(12, 2)
    assert s["total_amount"].dataType == DecimalType(14, 2)
    assert schemas.get_schema("gold_dim_customer")["customer_sk"].dataType == LongType()
    assert schemas.get_schema("gold_fact_sales")["store_sk"].dataType == LongType()


def test_bronze_all_strings_plus_metadata():
    for n in schemas.list_schemas():
        if n.startswith("bronze_"):
            s = schemas.get_schema(n)
            assert {"_ingested_at", "_source_file"} <= set(s.fieldNames())
            assert all(f.dataType == StringType() for f in s if not f.name.startswith("_"))


def test_no_clear_pii_after_bronze():
    pii = {"name", "email", "phone", "address"}
    for n in schemas.list_schemas():
        if not n.startswith("bronze_"):
            assert not pii & set(schemas.get_schema(n).fieldNames()), n


def test_dims_have_scd_columns_except_date():
    for n in schemas.list_schemas():
        if n.startswith("gold_dim_") and n != "gold_dim_date":
            assert {"_valid_from", "_valid_to", "_is_current"} <= set(schemas.get_schema(n).fieldNames())


def test_conform_and_violations(spark):
    df = spark.createDataFrame([("1", "x"), (None, "y"), ("bad", "z")], "store_sk string, extra string")
    with pytest.raises(ValueError, match="columns missing"):
        schemas.conform(df, "gold_dim_store")
    full = spark.createDataFrame(
        [("1", "S1"), ("bad", "S2"), (None, None)], "store_sk string, store_bk string"
    ).selectExpr("*", "NULL AS store_name", "NULL AS city", "NULL AS country", "NULL AS region",
                 "TIMESTAMP_NTZ'2025-01-01 00:00:00' AS _valid_from", "CAST(NULL AS TIMESTAMP_NTZ) AS _valid_to",
                 "TRUE AS _is_current")
    out = schemas.conform(full, "gold_dim_store")
    assert out.schema["store_sk"].dataType == LongType()
    v = {r["column_name"]: r for r in schemas.schema_violations(full, "gold_dim_store").collect()}
    assert v["store_sk"]["null_count"] == 2 and v["store_sk"]["cast_failures"] == 1
    assert schemas.conform(full, "gold_dim_store", strict=True).count() == 1
