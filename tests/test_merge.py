"""Keyed merge: what matches, which row stays, NULL keys and repeated keys."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import merge_upsert
from strata.sources.snapshots import SnapshotTable, upsert_to_table

COLS = "city string, degrees int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_a_dictionary(spark, tmp_table):
    """Random deliveries into one table; a dictionary does the same."""
    r = random.Random(4)
    want = {}
    for _ in range(4):
        batch = {f"c{r.randint(0, 12)}": r.choice([None, r.randint(-20, 40)]) for _ in range(r.randint(1, 9))}
        upsert_to_table(frame(spark, *batch.items()), tmp_table, ["city"])
        want.update(batch)
        assert rows(SnapshotTable(spark, tmp_table).read()) == sorted(want.items(), key=repr)
    assert SnapshotTable(spark, tmp_table).latest_version() == 4


def test_a_delivery_twice_changes_nothing(spark, tmp_table):
    batch = frame(spark, ("oslo", -3), ("rome", 21))
    for _ in range(2):
        upsert_to_table(batch, tmp_table, ["city"])
    assert rows(SnapshotTable(spark, tmp_table).read()) == [("oslo", -3), ("rome", 21)]


def test_keys_are_checked(spark, tmp_table):
    with pytest.raises(ValueError, match="one key column"):
        upsert_to_table(frame(spark, ("oslo", 1)), tmp_table, [])
    with pytest.raises(ValueError, match="country"):
        upsert_to_table(frame(spark, ("oslo", 1)), tmp_table, ["city", "country"])


def test_null_keys_match_only_if_asked(spark):
    t, s = frame(spark, (None, 7), ("oslo", 1), ("rome", 2)), frame(spark, (None, 8), ("oslo", None))
    assert rows(merge_upsert(t, s, ["city"])) == sorted([("oslo", None), ("rome", 2), (None, 7), (None, 8)], key=repr)
    assert rows(merge_upsert(t, s, ["city"], null_safe=True)) == sorted([("oslo", None), ("rome", 2), (None, 8)], key=repr)


def test_repeated_keys_of_a_delivery(spark):
    t, s = frame(spark, ("oslo", 0)), frame(spark, ("oslo", 5), ("oslo", 3))
    assert rows(merge_upsert(t, s, ["city"])) == [("oslo", 3)]  # the total order decides
    assert rows(merge_upsert(t, s, ["city"], order=[F.col("degrees").desc()])) == [("oslo", 5)]
    with pytest.raises(ValueError, match="several rows"):
        merge_upsert(t, s, ["city"], on_duplicate="error")


def test_latest_lets_the_better_row_stay(spark):
    """A late delivery does not overwrite; NULL keys are only added."""
    t, s = frame(spark, ("oslo", 9), ("rome", 1), (None, 1)), frame(spark, ("oslo", 4), ("rome", 6), ("bern", 2), (None, 2))
    got = merge_upsert(t, s, ["city"], latest=[F.col("degrees").desc_nulls_last()])
    assert rows(got) == sorted([("oslo", 9), ("rome", 6), ("bern", 2), (None, 1), (None, 2)], key=repr)


def test_no_side_is_measured_or_gathered(spark):
    """No job runs while the plan is built, and no rows go to one partition."""
    t, s = spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).alias("v")), spark.range(5_000).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    plan = merge_upsert(t, s, ["k"], on_duplicate="keep")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "GlobalLimit" not in plan
