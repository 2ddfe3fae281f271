"""Streaming: stream == batch for the keyed POS upsert; late rows (T4)."""

import datetime as dt

from strata.plans import layers as L
from strata.plans.queries import QUERIES
from strata.session import scratch_path


def test_stream_pos_equals_batch(spark, sf):
    s = QUERIES["stream_pos_upsert"](spark, sf)
    b = L.silver_pos(spark, sf)
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0  # whole rows, not only the ids


def test_stream_sessions_subset_of_batch(spark, sf):
    s = QUERIES["stream_sessions"](spark, sf)
    b = QUERIES["session_window_counts"](spark, sf)
    assert s.subtract(b).count() == 0  # emitted sessions are closed batch sessions
    assert 0 < b.count() - s.count() <= s.select("customer_id").distinct().count()


def test_late_row_dropped_by_watermark(spark, tmp_path):
    from pyspark.sql import functions as F

    land = str(tmp_path / "land")
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    schema = "event_id string, event_timestamp timestamp_ntz"
    out, ck = scratch_path(spark, "late_out"), scratch_path(spark, "late_ck")
    batches = [[("e1", t0), ("e2", t0 + dt.timedelta(hours=1))],
               [("e3", t0 - dt.timedelta(hours=2)), ("e2", t0 + dt.timedelta(hours=1))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(land)
        st = (spark.readStream.schema(schema).parquet(land)
              .withColumn("_et", F.col("event_timestamp").cast("timestamp"))
              .withWatermark("_et", "10 minutes").dropDuplicatesWithinWatermark(["event_id"]).drop("_et"))
        q = (st.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted(r["event_id"] for r in spark.read.schema(schema).parquet(out).collect())
    assert got == ["e1", "e2"]  # e3 is late, the replayed e2 is a duplicate
