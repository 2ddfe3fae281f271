"""What the large runs of the round found: how often rows are shuffled, and how work grows with the table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.plans import layers as L
from strata.plans import queries, silver
from strata.sources import feeds
from strata.sources.partitioned import KeyedTable

POS = "transaction_id string, store_id string, product_id string, customer_id string, quantity string, unit_price string, sale_date string, payment_method string"


def _bronze(spark, *rows):
    meta = {"_ingested_at": F.lit(L.AS_OF).cast("timestamp_ntz"), "_source_file": F.lit("f")}
    return spark.createDataFrame(list(rows), POS).withColumns(meta)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df):
    return [line for line in _plan(df).splitlines() if "Exchange hashpartitioning" in line]


COPIES = [
    ("a", "S1", "P1", "C1", "2", "1.00", "2024-01-01 00:00:00", "cash"),
    ("a", "S1", "P1", "C1", "bad", "9.00", "2024-05-01 00:00:00", "cash"),  # newer, but rejected
    ("b", "S1", "P1", None, "0", "1.00", "2024-01-01 00:00:00", "card"),
    ("b", "S1", "P1", None, "x", "1.00", "2024-02-01 00:00:00", "card"),
    ("c", "S1", "P1", "C2", "3", "1.50", "nope", "card"),
    ("c", "S2", "P1", "C2", "3", "1.50", None, "card"),
    (None, "S1", "P1", "C2", "3", "1.50", None, "card"),
]


def test_silver_shuffles_accepted_typed_rows_only(spark):
    out = silver.clean_transactions(_bronze(spark, *COPIES), L.AS_OF)
    assert sorted((r["transaction_id"], r["store_id"], r["quantity"]) for r in out.collect()) == [("a", "S1", 2), ("c", "S1", 3)]
    plan = _plan(out)
    below = plan[plan.index("Exchange hashpartitioning(transaction_id"):]
    assert "Filter" in below and "_source_file" not in below.split("Exchange", 2)[1].split("Project [")[0]
    assert "_w0" not in plan  # no order column beside the row's own


def test_the_quarantine_holds_the_best_rejected_copy_of_ids_without_an_accepted_one(spark):
    out = silver.pos_quarantine(_bronze(spark, *COPIES), L.AS_OF)
    got = {(r["transaction_id"], r["quantity"], r["reject_reason"]) for r in out.collect()}
    assert got == {("b", "x", "bad_quantity"), (None, "3", "null_transaction_id")}
    assert out.columns[: len(COPIES[0])] == [c.split()[0] for c in POS.split(", ")]


def test_small_dimensions_cost_the_sales_no_exchange(spark, sf):
    fact = L.star(spark, sf)["fact_sales"]
    assert not _exchanges(fact) and _plan(fact).count("BroadcastHashJoin") == 3


def test_a_dimension_that_only_looks_small_is_not_broadcast(spark):
    """Packed files tell a tenth of what the rows take on the driver."""
    from strata.operators.joins import lookup_join
    from strata.session import written

    ids = spark.range(400_000)
    dim = written(ids.select(F.col("id").alias("sk"), F.concat(F.lit("P"), "id").alias("bk")), "dim")
    assert dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10 << 20
    fact = written(spark.range(1000).select(F.concat(F.lit("P"), F.col("id") * 401).alias("bk_of")), "fact")
    out = lookup_join(fact, dim, "bk_of", "bk")
    assert "BroadcastHashJoin" not in _plan(out) and out.filter(F.col("sk") != F.substring("bk_of", 2, 9).cast("long")).count() == 0
    assert (out.count(), out.filter("sk is null").count()) == (1000, 2)
    few = lookup_join(fact, written(dim.limit(1000), "dim"), "bk_of", "bk")
    assert "BroadcastHashJoin" in _plan(few)


def test_files_of_a_layout_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 100)
    assert queries._layout_files(spark.range(2_501)) == 26 and queries._layout_files(spark.range(5)) == 8


def _keyed(spark, path):
    return KeyedTable(spark, str(path), ["id"], F.coalesce(F.date_format("d", "yyyy-MM"), F.lit("none")), 2)


def _rows(spark, *rows):
    return spark.createDataFrame([(k, dt.datetime(2024, m, 1), v) for k, m, v in rows], "id string, d timestamp_ntz, v int")


def test_an_index_is_rewritten_only_where_keys_moved(spark, tmp_path, monkeypatch):
    t = _keyed(spark, tmp_path)
    t.merge(_rows(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 1)))
    calls = []
    replace = t.index.replace
    monkeypatch.setattr(t.index, "replace", lambda parts, rows: (calls.append(parts), replace(parts, rows)))
    t.merge(_rows(spark, ("a", 1, 2), ("b", 2, 2)))
    assert calls == []  # corrected rows stay in their months
    t.merge(_rows(spark, ("a", 4, 3), ("d", 4, 3)))
    assert len(calls) == 1
    assert sorted((r["id"], r["v"]) for r in t.read().collect()) == [("a", 3), ("b", 2), ("c", 1), ("d", 3)]
    assert sorted((r["id"], r["table_part"]) for r in t.index.read().collect()) == [("a", "2024-04"), ("b", "2024-02"), ("c", "2024-03"), ("d", "2024-04")]


def test_the_rows_before_are_given_before_anything_changes(spark, tmp_path):
    t = _keyed(spark, tmp_path)
    t.merge(_rows(spark, ("a", 1, 1), ("b", 2, 1)))
    seen = []
    t.merge(_rows(spark, ("a", 2, 2)), before=lambda old: seen.append((old.collect(), t.read().count(), t.read().filter("v = 2").count())))
    assert [(r["id"], r["v"]) for r in seen[0][0]] == [("a", 1)] and seen[0][1:] == (2, 0)


def test_late_slices_are_landed_by_all_tasks(spark, sf, monkeypatch):
    import inspect

    from strata.streaming import streams

    assert "coalesce(1)" not in inspect.getsource(streams._late_arrivals)


def test_a_compressed_landing_holds_the_same_rows(spark, sf, tmp_path):
    from strata.sources import files

    raw = feeds.raw_customers(spark, sf)
    files.write_csv_feed(raw, str(tmp_path / "land"), compression="gzip")
    back = files.read_csv_feed(spark, str(tmp_path / "land"), raw.schema)
    assert back.exceptAll(raw).count() == 0 and back.count() == raw.count()


def test_a_feed_is_judged_in_one_exchange_and_hot_ids_over_all_tasks(spark, monkeypatch):
    rows = [*COPIES, *[("hot", "S1", "P1", None, str(i % 7 - 1), "1.00", f"2024-01-{1 + i % 9:02d} 00:00:00", "card") for i in range(60)]]
    bronze = _bronze(spark, *rows, *[(None, "S1", "P1", None, "1", "1.00", None, "card")] * 20)
    reasons = lambda df: sorted((str(r["transaction_id"]), str(r["quantity"]), str(r["sale_date"]), ",".join(r["reasons"]), str(r["winner"])) for r in df.collect())
    plain = silver.judged(bronze, "pos_transactions", L.AS_OF)
    # one exchange of the rows, without the values that they are ordered by
    assert len(_exchanges(plain)) == 1 and "Join" not in _plan(plain)
    assert "_w0" not in _plan(plain).split("Exchange hashpartitioning", 1)[1]
    # "hot": of the accepted copies of the last day the one with the smallest values is taken
    taken = [r for r in reasons(plain) if r[0] == "hot" and not r[3]]
    assert taken == [("hot", "1", "2024-01-09 00:00:00", "", "None")]
    assert sum("duplicate" in r[3] for r in reasons(plain) if r[0] == "hot") == 59
    assert [r[3] for r in reasons(plain) if r[0] == "None"] == ["null_transaction_id"] * 21
    monkeypatch.setattr(silver, "HOT_COPIES", 10)
    dealt = silver.judged(bronze.repartition(5), "pos_transactions", L.AS_OF)
    assert silver._hot_keys(bronze, "transaction_id") == ["hot"] and len(_exchanges(dealt)) == 2
    assert reasons(dealt) == reasons(plain)


def test_a_daily_run_leaves_its_tables_only(spark, tmp_path, monkeypatch):
    """Scratch tables go with the step that made them; lines that do not parse
    are still found, and files without any are parsed once."""
    import os

    from strata import session
    from strata.plans import jobs

    feed = {
        "pos": "transaction_id,store_id,product_id,customer_id,quantity,unit_price,sale_date,payment_method\na,S1,P1,C1,2,1.00,2024-01-02 00:00:00,cash\nshort,S1\na,S1,P1,C1,2,1.00,2024-01-01 00:00:00,cash\n",
        "inventory": "movement_id,warehouse_id,product_id,movement_type,quantity,movement_date\nM1,W1,P1,IN,3,2024-01-02 00:00:00\nM2,W1,P1,IN,3,2024-01-02 00:00:00,more\n",
        "customers": "customer_id,name,email,phone,address,city,country,signup_date\nC1,n,e,p,a,c,k,2024-01-01 00:00:00\n",
    }
    for name, text in feed.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "d.csv").write_text(text)
    clicks = '{"event_id": "E1", "customer_id": "C1", "timestamp": "2024-01-01 10:00:00.000000"}\nnothing\n'
    (tmp_path / "clicks").mkdir()
    (tmp_path / "clicks" / "d.json").write_text(clicks)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    made, setting = [], spark.conf.get(session._SHUFFLES, None)
    path = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda *a: made.append(path(*a)) or made[-1])
    root = str(tmp_path / "lake")
    for day in ("2024-02-01 00:00:00", "2024-02-02 00:00:00"):
        rep = jobs.daily_refresh(spark, {n: str(tmp_path / n) for n in (*feed, "clicks")}, root, day, gate=False)
        assert made and os.listdir(tmp_path / "shared" / "strata") == [] and spark.conf.get(session._SHUFFLES, None) == setting
        c = rep["counts"]
        assert [c[f"quarantine.{n}_lines"] for n in ("pos_transactions", "inventory_movements", "customers", "clickstream")] == [1, 1, 0, 1]
        assert (c["bronze.pos_transactions"], c["quarantine.pos_transactions"], c["silver.pos_transactions"], c["gold.fact_sales"]) == (2, 1, 1, 1)
        assert (c["bronze.inventory_movements"], c["silver.clickstream"], c["silver.customers"]) == (1, 1, 1)
    lake = jobs.Lakehouse(root)
    lines = {n: [r["_corrupt_record"] for r in lake.table(spark, "quarantine", f"{n}_lines").read().collect()] for n in ("pos_transactions", "customers")}
    assert lines == {"pos_transactions": ["short,S1"], "customers": []}
