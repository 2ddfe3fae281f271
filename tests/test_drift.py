"""Feeds whose layout drifts: nothing is lost."""

from strata import schemas
from strata.plans import jobs

AS_OF = "2025-01-01 00:00:00"


def test_added_missing_and_retyped_columns(spark):
    df = spark.createDataFrame([("t", "s", "p", "x5", "2.50", (1, "n"), {"old": "kept", "quantity": "older"}), ("u", "s", "p", "7", None, None, None)],
                               "transaction_id string, store_id string, product_id string, quantity string, unit_price string, extra struct<a:int,b:string>, _rest map<string,string>")
    out = schemas.conform_drift(df, "silver_pos_transactions")
    assert out.columns == [*schemas.get_schema("silver_pos_transactions").names, "_rest"]
    assert [f.dataType for f in out.schema][:-1] == [f.dataType for f in schemas.get_schema("silver_pos_transactions")]
    t, u = out.orderBy("transaction_id").collect()
    assert (t["quantity"], str(t["unit_price"]), t["sale_date"]) == (None, "2.50", None)
    assert t["_rest"] == {"quantity": "x5", "extra": '{"a":1,"b":"n"}', "old": "kept"}
    assert (u["quantity"], u["_rest"]) == (7, {})
    same = spark.createDataFrame([], schemas.get_schema("silver_customers"))
    assert schemas.conform_drift(same, "silver_customers").count() == 0


def test_json_lines_keep_unknown_and_retyped_fields_in_bronze(spark, tmp_path):
    land, root = tmp_path / "clicks", str(tmp_path / "lake")
    land.mkdir()
    (land / "a.json").write_text(
        '{"event_id": "e1", "customer_id": "c", "timestamp": "2024-05-01 10:00:00", "referrer": {"host": "h", "n": 1}}\n'
        '{"event_id": "e2", "customer_id": 7, "timestamp": 1714557600, "event_type": ["view"], "flag": true}\n'
        '\nnot json\n{"event_id": "e3", "customer_id": "c", "timestamp": "2024-05-01 10:05:00", "device_type": null}\n'
    )
    assert jobs.hourly_clicks(spark, str(land), root, AS_OF)["rows"] == 3
    bronze = {r["event_id"]: r for r in spark.read.parquet(f"{root}/bronze/clickstream_log").collect()}
    assert bronze["e1"]["_rest"] == {"referrer": '{"host":"h","n":1}'} and bronze["e3"]["_rest"] == {}
    assert (bronze["e2"]["customer_id"], bronze["e2"]["timestamp"], bronze["e2"]["event_type"], bronze["e2"]["_rest"]) == ("7", "1714557600", '["view"]', {"flag": "true"})
    bad = spark.read.parquet(f"{root}/quarantine/clickstream_lines_log").collect()
    assert [r["_corrupt_record"] for r in bad] == ["not json"]
    silver = {r["event_id"]: r for r in jobs.Lakehouse(root).table(spark, "silver", "clickstream").read().collect()}
    assert silver["e1"]["session_id"] == silver["e3"]["session_id"] is not None and silver["e2"]["session_id"] is None


def test_the_jobs_layers_have_the_registered_layout(spark, sf, tmp_path):
    from strata.plans import layers as L
    from strata.sources import feeds, files

    land = {}
    for name, df in (("pos", feeds.raw_pos(spark, sf)), ("inventory", feeds.raw_inventory(spark, sf)), ("customers", feeds.raw_customers(spark, sf))):
        land[name] = str(tmp_path / name)
        files.write_csv_feed(df, land[name])
    root = str(tmp_path / "lake")
    jobs.daily_refresh(spark, land, root, L.AS_OF, products=feeds.products(spark, sf), stores=feeds.stores(spark, sf), gate=False)
    lake = jobs.Lakehouse(root)
    for layer, names in jobs.TABLES.items():
        for name in names:
            got = lake.table(spark, layer, name).read()
            want = schemas.get_schema(f"{layer}_{name}")
            kept = [c for c in got.columns if c != schemas.REST]
            assert kept == want.names and [got.schema[c].dataType for c in kept] == [f.dataType for f in want], (layer, name)
