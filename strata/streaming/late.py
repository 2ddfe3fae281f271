"""Late rows as data.

Stateful stream operators drop what is older than the watermark. Here a stream
splits each micro-batch by the watermark instead: rows on time go on into the
session table, late rows to a table of their own, and nothing is lost.
``apply_late`` brings the late rows into sessions that are closed by then; the
session table opens again only the sessions that they reach.

The watermark of a micro-batch is, as in Spark, the largest event time of the
batches before it less the delay. Each batch stores its largest time under its
id, a row a batch, so a repeated batch is split the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.clicks import SessionTable
from strata.session import written
from strata.sources.partitioned import path_exists


class LateSplit:
    def __init__(self, spark: SparkSession, path: str, time: str = "event_timestamp", delay: str = "10 minutes"):
        self.spark, self.path, self.time, self.delay = spark, path.rstrip("/"), time, delay

    def _watermark(self, batch_id: int):
        if not path_exists(self.spark, f"{self.path}/times"):
            return None
        before = self.spark.read.parquet(f"{self.path}/times").filter(F.col("batch") < batch_id)
        return before.agg(F.max("most") - F.expr(f"INTERVAL {self.delay}")).first()[0]  # a row a batch

    def split(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """(rows on time, late rows). Rows without a time are on time."""
        mark = self._watermark(batch_id)
        rows = written(batch.withColumn("late", F.lit(False) if mark is None else F.coalesce(F.col(self.time) < F.lit(mark), F.lit(False))), "late-split")
        on_time, late = rows.filter("not late").drop("late"), rows.filter("late").drop("late")
        late.write.mode("overwrite").parquet(f"{self.path}/late/batch={batch_id}")
        rows.agg(F.max(self.time).alias("most")).write.mode("overwrite").parquet(f"{self.path}/times/batch={batch_id}")
        return on_time, late

    def late(self) -> DataFrame:
        """All late rows, with the batch that brought them."""
        return self.spark.read.parquet(f"{self.path}/late")


def click_stream(spark: SparkSession, stream: DataFrame, root: str, as_of, by: str = "yyyy-MM-dd") -> tuple[SessionTable, LateSplit]:
    """Typed click events into the session table under ``root``, the late ones
    beside it; whatever landed since the last run."""
    from strata.plans.jobs import _available_now

    base = root.rstrip("/")
    sessions, split = SessionTable(spark, f"{base}/sessions", by=by), LateSplit(spark, f"{base}/late")

    def load(batch: DataFrame, batch_id: int) -> None:
        on_time, _ = split.split(batch, batch_id)
        sessions.load(on_time.withColumn("_ingested_at", F.lit(as_of).cast("timestamp_ntz")), as_of, f"stream-{batch_id}")

    _available_now(stream, load, f"{base}/checkpoint")
    return sessions, split


def apply_late(sessions: SessionTable, split: LateSplit, as_of) -> None:
    """Late rows that were not applied yet go into the sessions, batch by batch."""
    spark = sessions.spark
    done = f"{split.path}/applied"
    applied = {r["batch"] for r in spark.read.parquet(done).collect()} if path_exists(spark, done) else set()  # a row a batch
    todo = [r["batch"] for r in split.late().select("batch").distinct().orderBy("batch").collect() if r["batch"] not in applied]
    for batch in todo:
        rows = split.late().filter(F.col("batch") == batch).drop("batch")
        sessions.load(rows.withColumn("_ingested_at", F.lit(as_of).cast("timestamp_ntz")), as_of, f"late-{batch}")
        spark.createDataFrame([(batch,)], "batch int").coalesce(1).write.mode("append").parquet(done)
