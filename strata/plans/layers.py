"""The medallion layers over the driver's test tables, as lazily composed
DataFrames. Registered queries and the bench are built from these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import gold, silver
from strata.session import written
from strata.sources import feeds

# The processing clock of every layer (injected, not read from
# the wall clock, so reruns and the SQL oracle agree) and the scenario dates.
AS_OF = "2025-01-01 00:00:00"
HISTORY_START = "1900-01-01 00:00:00"   # valid_from of first dimension versions
BETWEEN = "1998-09-01 00:00:00"         # a snapshot between them, delivered last
CHANGE_AT = "1999-01-01 00:00:00"       # second customer snapshot takes effect
DAY1_CUTOFF = "1998-01-01 00:00:00"     # orders first loaded up to here ...
DAY2_START = "1997-07-01 00:00:00"      # ... the next batch re-delivers from here


def bronze_pos(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.raw_pos(spark, sf).withColumns(
        {"_ingested_at": F.lit(AS_OF).cast("timestamp_ntz"), "_source_file": F.lit("lineitem")}
    )


def bronze_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.raw_inventory(spark, sf).withColumns(
        {"_ingested_at": F.lit(AS_OF).cast("timestamp_ntz"), "_source_file": F.lit("lineitem")}
    )


def bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.raw_customers(spark, sf).withColumns(
        {"_ingested_at": F.lit(AS_OF).cast("timestamp_ntz"), "_source_file": F.lit("customer")}
    )


def silver_pos(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_transactions(bronze_pos(spark, sf), AS_OF)


def silver_pos_table(spark: SparkSession, sf: str) -> DataFrame:
    """Silver POS written once (Parquet in the shared folder), as the daily job writes it once: gold queries that read silver
    several times (facts, dims, calendar) then scan it instead of re-running
    dedupe and casts per use."""
    return written(silver_pos(spark, sf), "silver-pos")


def silver_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_inventory(bronze_inventory(spark, sf), AS_OF)


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_customers(bronze_customers(spark, sf), AS_OF)


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return gold.build_dim_customer(silver_customers(spark, sf), AS_OF)


def dim_product(spark: SparkSession, sf: str, pos: DataFrame | None = None) -> DataFrame:
    pos = pos if pos is not None else silver_pos(spark, sf)
    return gold.build_dim_product(pos, feeds.products(spark, sf), AS_OF)


def dim_store(spark: SparkSession, sf: str) -> DataFrame:
    return gold.build_dim_store(feeds.stores(spark, sf), AS_OF)


def star(spark: SparkSession, sf: str, pos: DataFrame | None = None) -> dict[str, DataFrame]:
    """Silver POS, the three dimensions and the sales fact, each built once.
    The dimensions are written as the daily job writes them: their file sizes
    tell Spark which lookups need no exchange of the sales."""
    pos = pos if pos is not None else silver_pos_table(spark, sf)
    dims = {"customer": dim_customer(spark, sf), "product": dim_product(spark, sf, pos), "store": dim_store(spark, sf)}
    dc, dp, ds = (written(d, f"dim-{n}") for n, d in dims.items())
    return {
        "pos": pos,
        "dim_customer": dc,
        "dim_product": dp,
        "dim_store": ds,
        "fact_sales": gold.build_fact_sales(pos, dc, dp, ds, AS_OF),
    }


def fact_sales(spark: SparkSession, sf: str, pos: DataFrame | None = None) -> DataFrame:
    return star(spark, sf, pos)["fact_sales"]


# ---- customer snapshots for the SCD2 scenario ---------------------------
def customers_day1(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    """The customer snapshot as first delivered: customers who had signed up
    before CHANGE_AT, with the attribute values they had then (dirt rules by
    key: some lived elsewhere, some had no email yet, some had a city that
    was later removed)."""
    c = silver if silver is not None else silver_customers(spark, sf)
    k = F.substring(F.col("customer_id"), 2, 20).cast("long")
    return c.filter(F.col("signup_date") < F.lit(CHANGE_AT).cast("timestamp_ntz")).withColumns(
        {
            "city": F.when(k % 10 == 3, F.concat(F.lit("OLD/"), F.col("city")))
            .when(k % 25 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("city")),
            "email_hash": F.when(k % 10 == 7, F.lit(None).cast("string")).otherwise(F.col("email_hash")),
        }
    )


def customers_day2(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    """The full current snapshot; a few customers lose their city."""
    c = silver if silver is not None else silver_customers(spark, sf)
    k = F.substring(F.col("customer_id"), 2, 20).cast("long")
    return c.withColumn(
        "city", F.when(k % 40 == 1, F.lit(None).cast("string")).otherwise(F.col("city"))
    )


def customers_between(spark: SparkSession, sf: str, silver: DataFrame | None = None) -> DataFrame:
    """A snapshot between the two: day 1 without some customers, of whom others
    lived somewhere else and others already where day 2 has them."""
    c = silver if silver is not None else silver_customers(spark, sf)
    k = F.substring(F.col("customer_id"), 2, 20).cast("long")
    day1 = customers_day1(spark, sf, c).filter(k % 17 != 0)
    return day1.withColumn("city", F.when(k % 6 == 1, F.concat(F.lit("MID/"), F.col("city"))).when(k % 10 == 3, F.regexp_replace("city", "^OLD/", "")).otherwise(F.col("city")))
