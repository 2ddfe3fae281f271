"""Structured Streaming jobs.

* T1 ``stream_pos_upsert``: raw POS CSV files -> clean -> keyed merge into a
  partitioned table per micro-batch (``foreachBatch``), which rewrites the
  partitions that the batch touches. ``foreachBatch`` is at-least-once; a
  replayed batch applies the same merge again, which changes nothing. The
  merge keeps the winner of ``silver_pos_order``, so the table equals one
  batch run over all files, in whatever order they arrive.
* T2 ``stream_dedupe_clicks``: ``dropDuplicatesWithinWatermark`` on the event
  id (state is bounded by the watermark).
* T3 ``stream_session_counts``: ``session_window`` per customer with a
  watermark, append mode (a session is emitted once it is closed).
* T4 late rows: rows older than the watermark are dropped by the stateful
  operators (T2, T3); the keyed merge (T1) keeps them, and ``late`` splits them
  off as data and applies them to closed sessions.

All run with ``Trigger.AvailableNow``: process what is there, then stop.
The checkpoint location lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import layers as L
from strata.plans.jobs import Lakehouse, hourly_incremental
from strata.session import scratch_path
from strata.sources import feeds, files
from strata.sources.partitioned import KeyedTable

WATERMARK = "10 minutes"


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def pos_upsert_stream(spark: SparkSession, landing: str, root: str, as_of=L.AS_OF, files_per_trigger: int = 1000) -> KeyedTable:
    """The hourly job's stream, a few files a micro-batch."""
    hourly_incremental(spark, landing, root, as_of, files_per_trigger)
    return Lakehouse(root).table(spark, "silver", "pos_transactions")


def stream_pos_upsert(spark: SparkSession, sf: str) -> DataFrame:
    land = scratch_path(spark, "stream_pos_landing")
    files.write_csv_feed(feeds.raw_pos(spark, sf), land, compression="gzip")
    landed = len(spark.read.text(land, recursiveFileLookup=True).inputFiles())  # a listing
    half = max(1, -(-landed // 2))  # two micro-batches, however many files there are
    return pos_upsert_stream(spark, land, scratch_path(spark, "stream_pos_lake"), files_per_trigger=half).read()


SLICES = 4


def _click_slices(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The click feed cut into SLICES consecutive time ranges (arrival order)."""
    ev = feeds.clickstream(spark, sf)
    lo, hi = ev.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    if lo is None:
        return [ev]
    step = (hi - lo) / SLICES
    bounds = [lo + step * i for i in range(1, SLICES)]
    out, prev = [], None
    for b in bounds + [None]:
        cond = F.lit(True)
        if prev is not None:
            cond = cond & (F.col("event_timestamp") >= F.lit(prev))
        if b is not None:
            cond = cond & (F.col("event_timestamp") < F.lit(b))
        out.append(ev.filter(cond))
        prev = b
    return out


def _run_in_arrivals(spark: SparkSession, sf: str, build, name: str, mode: str = "append") -> DataFrame:
    """Land the click feed slice by slice; after each landing run the stream
    once with ``Trigger.AvailableNow`` on the same checkpoint (as an hourly
    schedule would), so state and watermark carry across runs."""
    land = scratch_path(spark, f"{name}_landing")
    out, ck = scratch_path(spark, f"{name}_out"), scratch_path(spark, f"{name}_ckpt")
    slices = _click_slices(spark, sf)
    schema = slices[0].schema
    result_schema = None
    for sl in slices:
        sl.write.mode("append").parquet(land)
        stream = build(spark.readStream.schema(schema).parquet(land))
        result_schema = stream.schema
        q = (
            stream.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", ck)
            .outputMode(mode)
            .trigger(availableNow=True)
            .start()
        )
        _run(q)
    return spark.read.schema(result_schema).parquet(out)


def _event_time(ev: DataFrame) -> DataFrame:
    # Watermarks need TIMESTAMP (with zone); feeds are NTZ wall clock.
    return ev.withColumn("_et", F.col("event_timestamp").cast("timestamp"))


def stream_dedupe_clicks(spark: SparkSession, sf: str) -> DataFrame:
    def build(ev):
        return (
            _event_time(ev).withWatermark("_et", WATERMARK)
            .dropDuplicatesWithinWatermark(["event_id"]).drop("_et")
        )

    return _run_in_arrivals(spark, sf, build, "stream_dedupe")


def stream_session_counts(spark: SparkSession, sf: str) -> DataFrame:
    def build(ev):
        # events delivered twice count once; those without a customer have no session
        return (
            _event_time(ev).withWatermark("_et", WATERMARK)
            .dropDuplicatesWithinWatermark(["event_id"])
            .filter(F.col("customer_id").isNotNull())
            .groupBy(F.col("customer_id"), F.session_window("_et", "30 minutes").alias("w"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select("customer_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "events")
        )

    return _run_in_arrivals(spark, sf, build, "stream_sessions")


def _late_arrivals(spark: SparkSession, sf: str, name: str):
    """The click feed landed in slices, every tenth event one slice late; the
    late-row stream run after each. Returns its session table and split."""
    from strata.streaming.late import click_stream

    land, root = scratch_path(spark, f"{name}_landing"), scratch_path(spark, f"{name}_lake")
    slices = _click_slices(spark, sf)
    tenth = F.substring("event_id", 2, 20).cast("long") % 10 == 3
    none = slices[0].limit(0)
    for sl, before in zip([*slices, none], [none, *slices]):
        sl.filter(~tenth).unionByName(before.filter(tenth)).write.mode("append").parquet(land)
        out = click_stream(spark, spark.readStream.schema(sl.schema).parquet(land), root, L.AS_OF, by="yyyy-MM")
    return out


def late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every delivered event and whether it came behind the watermark."""
    sessions, split = _late_arrivals(spark, sf, "late_events")
    late = split.late().select("event_id").distinct().withColumn("late", F.lit(True))
    on_time = sessions.read().select("event_id").distinct().withColumn("late", F.lit(False))
    return late.unionByName(on_time)


def late_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """The sessions after the late events were applied: as if none had been late."""
    from strata.streaming.late import apply_late

    sessions, split = _late_arrivals(spark, sf, "late_sessions")
    apply_late(sessions, split, L.AS_OF)
    return sessions.read()
