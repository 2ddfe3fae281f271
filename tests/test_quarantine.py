"""Every row of a feed is accepted or has all its reasons; repaired rows load."""

from pyspark.sql import functions as F

from strata.plans import jobs, silver
from strata.sources import files

AS_OF = "2025-01-01 00:00:00"
POS = "transaction_id string, store_id string, product_id string, customer_id string, quantity string, unit_price string, sale_date string, payment_method string"


def stamped(df):
    return df.withColumns({"_ingested_at": F.lit(AS_OF).cast("timestamp_ntz"), "_source_file": F.lit("f")})


def test_all_reasons_and_the_winner_of_duplicates(spark):
    rows = [
        ("ok", "s", "p", None, "1", "1.00", "2024-05-01", "CARD"), ("ok", None, "p", None, "x", "1.00", "2024-06-01", "CARD"), ("ok", "s", "p", None, "1", "1.00", "2024-05-01", "CARD"),
        ("bad", None, None, None, "0", "free", None, None), (None, "s", "p", None, "1", "1.00", None, None), (None, "s", "p", None, "1", "1.00", None, None),
    ]
    out = silver.judged(stamped(spark.createDataFrame(rows, POS)), "pos_transactions", AS_OF).collect()
    got = sorted((r["transaction_id"] or "", ",".join(r["reasons"]), r["winner"] or "") for r in out)
    assert got == sorted([
        ("ok", "", ""), ("ok", "null_store_id,bad_quantity,duplicate", "ok"), ("ok", "duplicate", "ok"),
        ("bad", "null_store_id,null_product_id,non_positive_quantity,bad_unit_price", ""), ("", "null_transaction_id", ""), ("", "null_transaction_id", ""),
    ])


def test_accepted_rows_are_those_of_silver(spark, sf):
    from strata.plans import layers as L

    bronze = L.bronze_inventory(spark, sf)
    out = silver.judged(bronze, "inventory_movements", AS_OF)
    assert out.count() == bronze.count()
    want = silver.clean_inventory(bronze, AS_OF).select("movement_id")
    got = out.filter(F.size("reasons") == 0).select("movement_id")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_other_feeds_and_empty_ones(spark):
    clicks = stamped(spark.createDataFrame([("e", "1"), ("e", "2"), (None, "3")], "event_id string, timestamp string"))
    got = sorted(",".join(r["reasons"]) for r in silver.judged(clicks, "clickstream", AS_OF).collect())
    assert got == ["", "duplicate", "null_event_id"]
    assert silver.quarantine(clicks.limit(0), "clickstream", AS_OF).count() == 0


def test_repaired_rows_load_and_what_is_still_wrong_stays(spark, tmp_path):
    land, root = str(tmp_path / "pos"), str(tmp_path / "lake")
    rows = [("a", "s", "p", "c", "1", "2.00", "2024-05-01", "CARD"), ("b", "s", "p", "c", "-1", "2.00", "2024-05-01", "CARD"), ("d", "s", None, "c", "1", "2.00", "2024-05-01", "CARD")]
    files.write_csv_feed(spark.createDataFrame(rows, POS), land)
    jobs.hourly_incremental(spark, land, root, AS_OF, with_360=True)
    refused = spark.read.parquet(f"{root}/quarantine/pos_transactions_log")
    repaired = refused.withColumn("quantity", F.abs(F.col("quantity").cast("int")).cast("string"))
    left = jobs.replay_sales(spark, root, repaired, "2025-01-02 00:00:00", "r1").collect()
    assert [(r["transaction_id"], r["reasons"]) for r in left] == [("d", ["null_product_id"])]
    assert sorted(r["transaction_id"] for r in jobs.Lakehouse(root).table(spark, "silver", "pos_transactions").read().collect()) == ["a", "b"]
    assert [(r["customer_bk"], r["total_orders"]) for r in jobs.customer_state(spark, root).table.read().collect()] == [("c", 2)]
