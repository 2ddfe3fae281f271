"""Dense, stable surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY bk)`` with no PARTITION BY moves every row to
one task. Instead: range-partition the keys, sort inside each partition,
materialise once (so every later pass sees the same partition contents),
count rows per partition (one row per partition), turn the counts into
offsets, and add the in-partition position. The result equals the global
``row_number`` ordered by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import shared_dir


def with_dense_keys(
    df: DataFrame,
    key: str,
    sk: str,
    offset: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``sk`` = ``offset`` + 1-based rank of ``key`` (keys must be unique
    and non-NULL). Existing dimension rows keep their keys: callers pass only
    new business keys and ``offset = max(existing sk)``."""
    spark = df.sparkSession
    shared_dir(spark)  # checkpoint() below needs the shared folder
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges adjacent ones, so partition order is still key order, and the
    # checkpoint below fixes which rows each partition holds.
    by_range = (
        df.repartitionByRange(num_partitions, F.col(key)) if num_partitions
        else df.repartitionByRange(F.col(key))
    )
    ranged = (
        by_range
        .sortWithinPartitions(F.col(key))
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    # monotonically_increasing_id = (partition index << 33) + row index.
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the un-partitioned window is bounded by n rows.
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_off"),
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(sk, (F.lit(offset) + F.col("_off") + local + 1).cast("long"))
        .drop("_pid", "_mid", "_off")
    )


def max_key(df: DataFrame, sk: str) -> int:
    """Largest existing surrogate key (0 for an empty table); one scalar."""
    v = df.agg(F.max(sk)).first()[0]
    return int(v) if v is not None else 0
