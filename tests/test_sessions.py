"""Gap sessions: boundary rule, equality with the one-window definition and
with session_window, and a hot user spread over buckets."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.sessions import gap_sessions, sessions_summary


def _events(spark, rows):
    return spark.createDataFrame(rows, "u string, ts timestamp_ntz")


def brute(df, gap_us=1800 * 10**6):
    w = Window.partitionBy("u").orderBy("ts")
    s = df.withColumn("prev", F.lag("ts").over(w)).withColumn(
        "st", F.when(F.col("prev").isNull() | (F.timestamp_diff("MICROSECOND", "prev", "ts") > gap_us), F.col("ts")))
    return s.withColumn("session_start", F.max("st").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def test_gap_boundary(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [("a", t0), ("a", t0 + dt.timedelta(minutes=29, seconds=59)),
            ("a", t0 + dt.timedelta(minutes=59, seconds=59)),  # exactly 30:00 later: same session
            ("a", t0 + dt.timedelta(minutes=89, seconds=59, microseconds=1))]  # 30:00.000001: new
    out = gap_sessions(_events(spark, rows), "u", "ts").orderBy("ts").collect()
    assert [r["session_start"] for r in out] == [t0, t0, t0, rows[3][1]]
    assert out[0]["session_duration_seconds"] == 3599 and out[0]["session_events"] == 3


def test_equals_brute_force_and_session_window(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("user_id").cast("string").alias("u"), "ts")
    mine = gap_sessions(ev, "u", "ts").select("u", "ts", "session_start")
    ref = brute(ev).select("u", "ts", "session_start")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, ref.collect()))
    s1 = sessions_summary(ev, "u", "ts")
    s2 = (ev.groupBy("u", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("events"))
          .select("u", "w.start", "w.end", "events"))
    assert sorted(map(tuple, s1.collect())) == sorted(map(tuple, s2.collect()))


def test_hot_user_in_one_hour(spark):
    """A third of all events: one user, one hour. Only pieces are windowed."""
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(milliseconds=i)) for i in range(3000)] + [(f"u{i}", base) for i in range(6000)]
    out = gap_sessions(_events(spark, rows), "u", "ts")
    assert out.count() == 9000
    hot = out.filter("u = 'hot'").select("session_events", "session_start", "session_end").distinct().collect()
    assert [tuple(r) for r in hot] == [(3000, base, base + dt.timedelta(milliseconds=2999))]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" in plan or "BroadcastHashJoin" in plan


def test_one_long_session_over_many_slots(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("long", base + dt.timedelta(minutes=7 * i)) for i in range(3000)]
    hot = gap_sessions(_events(spark, rows), "u", "ts").select("session_events", "session_end").distinct().collect()
    assert [(r[0], r[1]) for r in hot] == [(3000, base + dt.timedelta(minutes=7 * 2999))]


def test_events_without_user_or_time_stay(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(None, base), (None, None), ("a", None), ("a", base), ("a", base)]
    out = gap_sessions(_events(spark, rows), "u", "ts")
    assert out.columns == ["u", "ts", "session_start", "session_end", "session_events", "session_duration_seconds"]
    got = sorted(((r["u"], r["ts"], r["session_events"]) for r in out.collect()), key=repr)
    assert got == sorted([(None, base, None), (None, None, None), ("a", None, None), ("a", base, 2), ("a", base, 2)], key=repr)


def test_every_click_reaches_silver(spark, sf):
    from strata.plans import layers as L
    from strata.plans import silver
    from strata.sources import feeds

    ev = feeds.clickstream(spark, sf)
    out = silver.sessionise(ev, L.AS_OF)
    assert ev.filter("customer_id IS NULL").count() > 0 and ev.count() > ev.select("event_id").distinct().count()
    assert out.count() == ev.select("event_id").distinct().count()
    assert out.filter("customer_id IS NULL AND session_id IS NOT NULL").count() == 0
