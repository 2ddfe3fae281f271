"""Silver cleaning: which copy of a transaction wins, casts, rejects, and the
way of a landed file to silver."""

import itertools

from pyspark.sql import functions as F

from strata import schemas
from strata.plans import layers as L
from strata.plans import silver
from strata.sources import files
from strata.sources.snapshots import SnapshotTable

AS_OF = "2025-01-01 00:00:00"
#: A row that is accepted as it stands; cases change single fields of it.
GOOD = {
    "transaction_id": "A-7", "store_id": "north", "product_id": "tea", "customer_id": "mia", "quantity": "4",
    "unit_price": "2.25", "sale_date": "2023-05-06 07:08:09", "payment_method": " Voucher", "_ingested_at": None,
    "_source_file": "drop-1",
}


def bronze(spark, *rows):
    kinds = {f.name: f.dataType.simpleString() for f in schemas.get_schema("bronze_pos_transactions")}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in GOOD)
    df = spark.createDataFrame([tuple({**GOOD, **r}.values()) for r in rows], schema.replace("_ingested_at timestamp_ntz", "_ingested_at string"))
    return df.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz"))


def winner(spark, *rows):
    """The same for every order of the rows."""
    found = set()
    for order in itertools.permutations(rows):
        found.add(tuple(map(tuple, silver.clean_transactions(bronze(spark, *order), AS_OF).collect())))
    assert len(found) == 1
    got = found.pop()
    return dict(zip(silver.SILVER_POS_COLUMNS, got[0])) if got else None


def test_typed_row(spark):
    out = silver.clean_transactions(bronze(spark, {}), AS_OF)
    assert out.columns == silver.SILVER_POS_COLUMNS
    r = out.first()
    assert (str(r["total_amount"]), r["payment_method"], r["quantity"]) == ("9.00", "VOUCHER", 4)
    assert str(r["sale_date"]) == "2023-05-06 07:08:09" and str(r["_processed_at"]) == AS_OF


def test_a_copy_without_a_readable_date_never_wins(spark):
    for text in ("not-a-date", "zzz", "9/1/2024", None, ""):
        got = winner(spark, {"store_id": "good"}, {"store_id": "bad", "sale_date": text})
        assert got["store_id"] == "good" and got["sale_date"] is not None


def test_a_rejected_copy_never_hides_an_accepted_one(spark):
    later = "2024-12-31 00:00:00"
    for change in ({"quantity": "many"}, {"quantity": "0"}, {"unit_price": "-1"}, {"unit_price": "?"}, {"store_id": None}, {"product_id": None}):
        got = winner(spark, {}, {**change, "sale_date": later}, {**change, "sale_date": later, "_ingested_at": later})
        assert got is not None and str(got["sale_date"]) == GOOD["sale_date"]


def test_later_ingestion_beats_later_sale(spark):
    got = winner(spark, {"customer_id": "old", "sale_date": "2024-01-01", "_ingested_at": "2024-02-01"},
                 {"customer_id": "new", "sale_date": "2023-01-01", "_ingested_at": "2024-02-02"})
    assert got["customer_id"] == "new"


def test_later_sale_and_then_the_typed_values_decide(spark):
    assert winner(spark, {"quantity": "9", "sale_date": "2023-01-02"}, {"quantity": "10", "sale_date": "2023-01-01"})["quantity"] == 9
    assert winner(spark, {"quantity": "9"}, {"quantity": "10"})["quantity"] == 9  # as numbers, not as text


def test_rows_without_an_id_and_empty_input(spark):
    assert winner(spark, {"transaction_id": None}) is None
    assert silver.clean_transactions(bronze(spark), AS_OF).count() == 0


def test_inventory_uses_the_same_rule(spark):
    cols = "movement_id string, warehouse_id string, product_id string, movement_type string, quantity string, movement_date string"
    rows = [("m", "w", "p", "in", "5", "2024-01-01"), ("m", "w", "p", "in", "6", "someday"), ("m", "w", "p", "lost", "7", "2024-03-01")]
    got = silver.clean_inventory(spark.createDataFrame(rows, cols), AS_OF).collect()
    assert [r["quantity"] for r in got] == [5]


def test_dirty_casts(spark):
    vals = ["abc", "5.7", "", "1e3", "3000000000", " 5 ", "99999999999.99", "bad-date"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    from strata.functions.casts import to_decimal, to_int, to_ts

    got = {r["v"]: (r["i"], r["d"], r["t"]) for r in
           df.select("v", to_int("v").alias("i"), to_decimal("v").alias("d"), to_ts("v").alias("t")).collect()}
    assert got["abc"] == (None, None, None)
    assert got["5.7"][0] is None and str(got["5.7"][1]) == "5.70"
    assert got[""][0] is None
    assert got["3000000000"][0] is None
    assert got[" 5 "][0] == 5
    assert got["99999999999.99"][1] is None  # overflows decimal(12,2)
    assert got["bad-date"][2] is None


def test_rejects_routed(spark):
    rows = [{"transaction_id": "ok"}, {"transaction_id": "s", "store_id": None}, {"transaction_id": "q", "quantity": "x"},
            {"transaction_id": "z", "quantity": "0"}, {"transaction_id": "p", "unit_price": "-2"}]
    good, bad = silver.split_rejects(bronze(spark, *rows), AS_OF)
    assert [r["transaction_id"] for r in good.collect()] == ["ok"]
    assert {r["transaction_id"]: r["reject_reason"] for r in bad.collect()} == {
        "s": "null_store_id", "q": "bad_quantity", "z": "non_positive_quantity", "p": "non_positive_unit_price"}


def test_strict_mode_drops_invalid_methods_and_dates(spark):
    rows = [{"transaction_id": "a"}, {"transaction_id": "b", "sale_date": "?"}, {"transaction_id": "c", "payment_method": "shells"}]
    assert silver.clean_transactions(bronze(spark, *rows), AS_OF).count() == 3
    assert [r["transaction_id"] for r in silver.clean_transactions(bronze(spark, *rows), AS_OF, strict=True).collect()] == ["a"]


def test_landed_files_reach_silver_once(spark, sf, tmp_path):
    """The whole POS feed as files, cleaned and merged twice."""
    from strata.sources import feeds

    land = str(tmp_path / "land")
    files.write_csv_feed(feeds.raw_pos(spark, sf), land, files=3)
    raw = files.stamp_ingestion(files.read_csv_feed(spark, land, files.raw_string_schema("bronze_pos_transactions")), AS_OF)
    assert raw.select("_source_file").distinct().count() == 3
    t = SnapshotTable(spark, str(tmp_path / "silver"))
    for _ in range(2):
        t.upsert(silver.clean_transactions(raw, AS_OF), ["transaction_id"])
    want = L.silver_pos(spark, sf)
    assert t.read().exceptAll(want).count() == 0 and t.read().count() == want.count()


def test_json_corrupt_lines_quarantined(spark, tmp_path):
    p = tmp_path / "clicks"
    p.mkdir()
    (p / "a.json").write_text('{"event_id":"E1","customer_id":"C1","timestamp":"2024-01-01 00:00:00"}\nbad\n')
    raw = files.read_json_feed(spark, str(p), files.raw_string_schema("bronze_clickstream"))
    good, bad = files.split_corrupt(raw)
    assert good.count() == 1 and [r["_corrupt_record"] for r in bad.collect()] == ["bad"]
    assert "_corrupt_record" not in good.columns


def test_reject_report_reads_bronze_twice(spark, sf):
    # the dedupe pass and one grouping by id (NULL ids and losers together)
    out = silver.pos_outcomes(L.bronze_pos(spark, sf))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 2
    rows = dict(map(tuple, out.collect()))
    assert sum(rows.values()) == L.bronze_pos(spark, sf).count()
