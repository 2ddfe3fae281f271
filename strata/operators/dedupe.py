"""Deterministic "keep the latest row per key"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def total_order(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> list[Column]:
    """``order`` followed by every other column ascending NULLS LAST.

    Two rows that still tie are identical outside the key, so whichever one
    wins, the output is the same: the result never depends on partitioning or
    task timing."""
    order = list(order or [])
    # a map has no order, its sorted entries have one
    maps = {f.name for f in df.schema if isinstance(f.dataType, MapType)}
    rest = [(F.array_sort(F.map_entries(c)) if c in maps else F.col(c)).asc_nulls_last() for c in df.columns if c not in keys]
    return order + rest


def dedupe_latest(
    df: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order`` + a total tie-break.

    Planned as ``row_number() = 1``; Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key ships at most one row
    per map task instead of all of its rows."""
    if not keys:
        raise ValueError("dedupe keys must contain at least one column")
    ordering = total_order(df, keys, order)
    if not ordering:  # every column is a key: duplicates are identical rows
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
