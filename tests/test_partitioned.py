from pyspark.sql import functions as F

from strata.sources.partitioned import upsert_partitions


def test_upsert_touches_only_batch_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    day1 = spark.createDataFrame(
        [("a", "2024-01-01", 1), ("b", "2024-01-01", 1), ("c", "2024-01-02", 1)], "id string, d string, v int")
    upsert_partitions(spark, day1, path, ["id", "d"], ["d"])
    import os
    before = {f: os.path.getmtime(os.path.join(path, "d=2024-01-01", f))
              for f in os.listdir(os.path.join(path, "d=2024-01-01"))}
    batch = spark.createDataFrame([("c", "2024-01-02", 9), ("e", "2024-01-03", 5)], "id string, d string, v int")
    upsert_partitions(spark, batch, path, ["id", "d"], ["d"])
    out = sorted((r["id"], str(r["d"]), r["v"]) for r in spark.read.parquet(path).collect())
    assert out == [("a", "2024-01-01", 1), ("b", "2024-01-01", 1), ("c", "2024-01-02", 9), ("e", "2024-01-03", 5)]
    after = {f: os.path.getmtime(os.path.join(path, "d=2024-01-01", f))
             for f in os.listdir(os.path.join(path, "d=2024-01-01"))}
    assert before == after  # untouched partition not rewritten


def test_partition_pruned_read_plan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 10).alias("p"))
    upsert_partitions(spark, df, path, ["id", "p"], ["p"])
    batch = spark.createDataFrame([("5", 5)], "id string, p long")
    t = spark.read.parquet(path).join(F.broadcast(batch.select("p").distinct()), ["p"], "left_semi")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "PartitionFilters: [isnotnull(p" in plan
    upsert_partitions(spark, batch.withColumn("id", F.lit("new")), path, ["id", "p"], ["p"])
    assert spark.read.parquet(path).count() == 1001


def test_zero_padded_partition_values_stay_text(spark, tmp_path):
    from strata.sources.partitioned import upsert_partitions

    path = str(tmp_path / "t")
    for v in (1, 9):
        upsert_partitions(spark, spark.createDataFrame([("a", "01", v), ("b", "1", v)], "k string, m string, v int"), path, ["k", "m"], ["m"])
    got = spark.read.schema("k string, v int, m string").parquet(path).select("k", "m", "v").collect()
    assert sorted(map(tuple, got)) == [("a", "01", 9), ("b", "1", 9)]
