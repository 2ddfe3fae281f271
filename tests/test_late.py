"""Late rows as data: nothing is lost, and sessions end as if none were late."""

import datetime as dt

from pyspark.sql import functions as F

from strata.plans import silver
from strata.streaming.late import LateSplit, apply_late, click_stream

KIND = "event_id string, customer_id string, page_url string, event_type string, event_timestamp timestamp_ntz, device_type string"
T0 = dt.datetime(2024, 5, 1, 10, 0, 0)
AS_OF = "2025-01-01 00:00:00"


def event(e, customer, minutes):
    return e, customer, "/", "view", None if minutes is None else T0 + dt.timedelta(minutes=minutes), None


def test_split_is_by_the_batches_before_and_repeats_alike(spark, tmp_path):
    s = LateSplit(spark, str(tmp_path / "late"))
    batches = [[event("a", "x", 0), event("b", "x", 100)], [event("c", "x", 89), event("d", "x", 90), event("n", "x", None), event("e", "x", 300)], [event("f", "x", 289)]]
    got = []
    for _ in range(2):
        for n, b in enumerate(batches):
            on_time, late = s.split(spark.createDataFrame(b, KIND), n)
            got.append(([r[0] for r in on_time.orderBy("event_id").collect()], [r[0] for r in late.collect()]))
    assert got[:3] == got[3:] == [(["a", "b"], []), (["d", "e", "n"], ["c"]), ([], ["f"])]
    assert sorted(r["event_id"] for r in s.late().collect()) == ["c", "f"]


def test_late_rows_join_closed_sessions(spark, tmp_path):
    land, root = str(tmp_path / "land"), str(tmp_path / "lake")
    arrivals = [[event("a1", "ann", 0), event("a2", "ann", 55), event("z", "bob", 300)], [event("a3", "ann", 28), event("z2", "bob", 310)]]
    everything = []
    for rows in arrivals:
        df = spark.createDataFrame(rows, KIND)
        df.write.mode("append").parquet(land)
        everything += rows
        sessions, split = click_stream(spark, spark.readStream.schema(df.schema).parquet(land), root, AS_OF)
    before = {r["event_id"]: r["session_id"] for r in sessions.read().collect()}
    assert set(before) == {"a1", "a2", "z", "z2"} and before["a1"] != before["a2"]
    assert [r["event_id"] for r in split.late().collect()] == ["a3"]
    for _ in range(2):  # applying again finds nothing to do
        apply_late(sessions, split, AS_OF)
    whole = spark.createDataFrame(everything, KIND).withColumn("_ingested_at", F.lit(AS_OF).cast("timestamp_ntz"))
    want = silver.sessionise(whole, AS_OF)
    assert sorted(map(tuple, sessions.read().select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
