"""Merges into a partitioned table with a key index."""

import os

import pytest
from pyspark.sql import functions as F

from strata.sources.partitioned import KeyedTable

KIND = "id string, d string, v int"


def table(spark, path, buckets=4):
    return KeyedTable(spark, str(path), ["id"], F.coalesce(F.col("d"), F.lit("none")), buckets)


def rows(t):
    return sorted(tuple(r) for r in t.read().select("id", "d", "v").collect())


def data_files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def frame(spark, *values):
    return spark.createDataFrame(list(values), KIND)


def test_a_moved_key_has_one_row_and_other_partitions_keep_their_files(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame(spark, ("a", "2024-01", 1), ("b", "2024-01", 1), ("c", "2024-02", 1), ("e", "2024-05", 1), ("z", "2023-01", 1)))
    before = data_files(tmp_path / "data")
    old, new = t.merge(frame(spark, ("a", "2024-02", 2), ("f", "2024-06", 2), ("z", "2024-06", 2)))
    assert rows(t) == [("a", "2024-02", 2), ("b", "2024-01", 1), ("c", "2024-02", 1), ("e", "2024-05", 1), ("f", "2024-06", 2), ("z", "2024-06", 2)]
    assert sorted(map(tuple, old.collect())) == [("a", "2024-01", 1), ("z", "2023-01", 1)]
    assert sorted(map(tuple, new.collect())) == [("a", "2024-02", 2), ("f", "2024-06", 2), ("z", "2024-06", 2)]
    after = data_files(tmp_path / "data")
    kept = {f for f in before if "2024-05" in f}
    assert kept and all(after[f] == before[f] for f in kept)
    assert not any("2023-01" in f for f in after)  # a partition that lost its last row
    assert t.index.read().count() == 6


def test_latest_keeps_the_newer_row_wherever_it_lies(spark, tmp_path):
    t, order = table(spark, tmp_path), [F.col("v").desc()]
    t.merge(frame(spark, ("a", "1", 5), ("b", "1", 1)), order)
    t.merge(frame(spark, ("a", "2", 3), ("b", "2", 3)), order)
    assert rows(t) == [("a", "1", 5), ("b", "2", 3)]


def test_deletes_remove_rows_and_index_entries(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame(spark, ("a", "1", 1), ("b", "1", 1), ("c", "2", 1)))
    old, new = t.merge(frame(spark, ("b", "3", 2)), deletes=frame(spark, ("c", None, 0), ("x", None, 0)))
    assert rows(t) == [("a", "1", 1), ("b", "3", 2)] and t.index.read().count() == 2
    assert {r["id"] for r in old.collect()} == {"b", "c"} and [r["id"] for r in new.collect()] == ["b"]


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("stop", ["data", "index"])
def test_a_stopped_merge_is_repeated(spark, tmp_path, monkeypatch, stop, first):
    t = table(spark, tmp_path)
    start = [] if first else [("a", "1", 1), ("b", "1", 1), ("k", "4", 1)]
    if start:
        t.merge(frame(spark, *start))
    batch = frame(spark, ("a", "2", 2), ("c", "3", 2), ("k", "2", 2))

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(getattr(t, stop), "replace", fail)
        with pytest.raises(RuntimeError):
            t.merge(batch)
    t = table(spark, tmp_path)
    t.merge(batch)
    t.merge(batch)
    want = {r[0]: r for r in start} | {r[0]: tuple(r) for r in batch.collect()}
    assert rows(t) == sorted(want.values())


def test_only_named_partitions_are_read(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame(spark, *[(f"k{i}", f"{i % 7}", i) for i in range(50)]))
    plan = t.data.read(["3", "5"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [table_part" in plan and "IN (3,5)" in plan
    found = t.lookup(frame(spark, ("k3", None, 0), ("k40", None, 0), ("none", None, 0)).select("id"))
    assert sorted(tuple(r) for r in found.collect()) == [("k3", "3", 3), ("k40", "5", 40)]


def test_null_keys_are_refused_and_an_empty_batch_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame(spark, ("a", "01", 1), ("b", None, 1)))
    t.merge(frame(spark, ("a", "01", 1)).filter("v > 5"))
    assert rows(t) == [("a", "01", 1), ("b", None, 1)]
    with pytest.raises(ValueError, match="NULL"):
        t.merge(frame(spark, (None, "1", 1)))


def test_a_table_that_begins_empty(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame(spark, ("a", "1", 1)).filter("v > 5"))
    assert t.exists() and rows(t) == []
    t.merge(frame(spark, ("a", "1", 1)))
    assert rows(t) == [("a", "1", 1)]
    t.merge(frame(spark, ("a", "1", 1)).filter("v > 5"), deletes=frame(spark, ("a", None, 0)))
    assert rows(t) == []


def scattered(spark, path):
    """Three partitions, one with an odd name; the first has many small files."""
    t = table(spark, path)
    t.merge(spark.range(300).select(F.format_string("k%03d", "id").alias("id"), F.when(F.col("id") < 200, "2024-01").when(F.col("id") < 250, "a b+c:d/e").otherwise("x").alias("d"), F.col("id").cast("int").alias("v")))
    # files as small batches leave them
    t.data.read(["2024-01"]).repartition(9).write.mode("append").partitionBy("table_part").parquet(str(path / "more"))
    for name in os.listdir(path / "data" / "table_part=2024-01"):
        os.remove(path / "data" / "table_part=2024-01" / name)
    for name in os.listdir(path / "more" / "table_part=2024-01"):
        os.rename(path / "more" / "table_part=2024-01" / name, path / "data" / "table_part=2024-01" / name)
    return t


@pytest.mark.parametrize("cluster_by", [None, ["v", "id"]])
def test_tidy_compacts_where_files_are_many_and_keeps_rows(spark, tmp_path, cluster_by):
    t = scattered(spark, tmp_path)
    want, before = rows(t), data_files(tmp_path / "data")
    assert {r["table_part"]: r["files"] for r in t.data.files().collect()} == {"2024-01": 9, "a b+c:d/e": 1, "x": 1}
    done = t.tidy(cluster_by)
    assert [(r["table_part"], r["files"], r["need"]) for r in done] == [("2024-01", 9, 1)]
    after = data_files(tmp_path / "data")
    assert rows(t) == want and len(after) == 3
    assert {f for f in before if "2024-01" not in f} == {f for f in after if "2024-01" not in f}
    assert t.tidy(cluster_by) == [] and not (tmp_path / "tidied").exists()
    assert len(t.tidy(cluster_by, all_parts=True)) == 3 and rows(t) == want
    t.merge(frame(spark, ("k000", "x", 7)))  # the index still finds the old place
    assert rows(t) == sorted([r for r in want if r[0] != "k000"] + [("k000", "x", 7)])


def test_a_stopped_tidy_is_finished_by_the_next_writer(spark, tmp_path, monkeypatch):
    t = scattered(spark, tmp_path)
    want, finish = rows(t), KeyedTable._finish_tidy
    calls = []

    def stop(self):
        calls.append(1)
        if len(calls) == 2:  # after the files were written aside
            raise RuntimeError("lost")
        finish(self)

    monkeypatch.setattr(KeyedTable, "_finish_tidy", stop)
    with pytest.raises(RuntimeError, match="lost"):
        t.tidy()
    # worse: the old files of the partition are gone already
    for name in os.listdir(tmp_path / "data" / "table_part=2024-01"):
        os.remove(tmp_path / "data" / "table_part=2024-01" / name)
    t.merge(frame(spark, ("new", "x", 1)))
    assert rows(t) == sorted([*want, ("new", "x", 1)]) and not (tmp_path / "tidied").exists()
    # files aside without the mark of a whole write are not taken
    t.data.read(["x"]).limit(1).write.partitionBy("table_part").parquet(str(tmp_path / "tidied"))
    os.remove(tmp_path / "tidied" / "_SUCCESS")
    t.merge(frame(spark, ("new", "x", 2)))
    assert rows(t) == sorted([*want, ("new", "x", 2)])
