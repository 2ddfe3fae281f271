import pytest
from pyspark.sql import functions as F

from strata.sources.snapshots import SnapshotTable


def test_time_travel_and_guards(spark, tmp_table):
    t = SnapshotTable(spark, tmp_table)
    t.publish(spark.range(3), committed_at="2024-01-01T00:00:00")
    t.publish(spark.range(5), committed_at="2024-01-02T00:00:00")
    assert t.read().count() == 5
    assert t.read(version=1).count() == 3
    assert t.read(timestamp="2024-01-01T12:00:00").count() == 3
    with pytest.raises(ValueError, match="exclude each other"):
        t.read(version=1, timestamp="2024-01-01")
    with pytest.raises(ValueError):
        t.read(timestamp="2023-01-01")
    with pytest.raises(ValueError, match="168"):
        t.vacuum(retention_hours=24)


def test_vacuum_keeps_current(spark, tmp_table):
    t = SnapshotTable(spark, tmp_table)
    for d in ("2024-01-01", "2024-01-02", "2024-03-01"):
        t.publish(spark.range(2), committed_at=d + "T00:00:00")
    deleted = t.vacuum(now="2024-03-05T00:00:00")
    assert deleted == [1]  # v1 replaced on 01-02 (> 7 days ago); v2 replaced 4 days ago
    assert [c["version"] for c in t.commits()] == [2, 3]
    assert t.read().count() == 2


def test_uncommitted_version_invisible(spark, tmp_table):
    t = SnapshotTable(spark, tmp_table)
    t.publish(spark.range(2))
    spark.range(9).write.parquet(f"{tmp_table}/v=00000002")  # crashed writer, no commit
    assert t.read().count() == 2
    assert t.publish(spark.range(4)) == 2 and t.read().count() == 4


def test_compact_and_zorder(spark, tmp_table, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey")
    t = SnapshotTable(spark, tmp_table)
    t.publish(li.repartition(16))
    t.compact(target_file_bytes=1 << 30)
    assert t.read().inputFiles().__len__() == 1
    t.zorder(["l_partkey", "l_suppkey"], num_files=8)
    z = t.read()
    assert sorted(map(tuple, z.collect())) == sorted(map(tuple, li.collect()))
    spans = (z.withColumn("f", F.input_file_name()).groupBy("f")
             .agg((F.max("l_partkey") - F.min("l_partkey")).alias("s")).collect())
    full = li.agg(F.max("l_partkey") - F.min("l_partkey")).first()[0]
    assert len(spans) > 1 and sum(r["s"] for r in spans) / len(spans) < 0.75 * full


def test_commit_info_written_with_the_version(spark, tmp_table):
    t = SnapshotTable(spark, tmp_table)
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    t.upsert(df, ["id"], committed_at="2024-01-01T00:00:00", info={"batch_id": 7})
    t.upsert(df, ["id"], committed_at="2024-01-02T00:00:00", info={"batch_id": 8})
    assert [(c["version"], c["batch_id"], c["operation"]) for c in t.commits()] == [
        (1, 7, "CREATE"), (2, 8, "MERGE")]
