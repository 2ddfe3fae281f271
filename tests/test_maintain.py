"""Upkeep of a lake: compaction of merged tables, old versions."""

from pyspark.sql import functions as F

from strata.plans import jobs, layers as L


def test_small_files_are_joined_and_old_versions_go(spark, sf, tmp_path):
    root = str(tmp_path)
    lh = jobs.Lakehouse(root)
    assert jobs.maintain_lake(spark, root, "2024-03-01T00:00:00") == []  # nothing there yet
    sales = L.silver_pos(spark, sf)
    t = lh.table(spark, "silver", "pos_transactions")
    t.merge(sales)
    # one month in many small files, as streams of small appends leave it
    month = t.data.files().orderBy("table_part").first()["table_part"]
    t.data.read([month]).repartition(7).write.partitionBy("table_part").parquet(root + "/more")
    folder = tmp_path / "silver" / "pos_transactions" / "data" / f"table_part={month}"
    for x in list(folder.iterdir()):
        x.unlink()
    for x in (tmp_path / "more" / f"table_part={month}").glob("part-*"):
        x.rename(folder / x.name)
    want = sorted(map(str, t.read().select("transaction_id", "total_amount", "sale_date").collect()))
    dim = lh.table(spark, "gold", "dim_store")
    for day in ("2024-01-01", "2024-01-02", "2024-02-28"):
        dim.publish(spark.range(3).withColumn("day", F.lit(day)), committed_at=f"{day}T00:00:00")
    done = jobs.maintain_lake(spark, root, "2024-03-01T00:00:00")
    assert done == [{"table": "silver/pos_transactions", "part": month, "files": 7}, {"table": "gold/dim_store", "versions": [1]}]
    assert sorted(map(str, t.read().select("transaction_id", "total_amount", "sale_date").collect())) == want
    assert dim.read().select("day").distinct().collect()[0][0] == "2024-02-28"
    assert jobs.maintain_lake(spark, root, "2024-03-01T00:00:00") == []
