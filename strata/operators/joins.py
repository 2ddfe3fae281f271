"""Lookup joins with hot-NULL handling, and the SCD2 point-in-time lookup.

Spark broadcasts a side whose size it knows (file sizes, or the measured
shuffle under adaptive execution) to be under
``spark.sql.autoBroadcastJoinThreshold``, and splits hot keys of a sort-merge
join at run time. File sizes are those of packed files, so a side that looks
small is counted before it may go through the driver (``bounded``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded(side: DataFrame, rows: int | None = None) -> DataFrame:
    """``side`` of a join, to be merged and not broadcast if its rows are more
    than the broadcast threshold in memory. Packed files of running numbers and
    repeated texts are a tenth of that and less (measured: 1.2 million rows of a
    dimension in 5 MB, 150 MB as a hash table on the driver). ``rows`` if they are known;
    else only a side that looks small is counted, so little is read."""
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if limit <= 0 or side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > limit:
        return side
    rows = side.count() if rows is None else rows
    return side.hint("merge") if rows * (8 + side._jdf.schema().defaultSize()) > limit else side


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left", spread_by: list[str] | None = None) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key`` without a hot partition.

    NULL fact keys cannot match but would all hash to one reducer, so they
    are spread over as many distinct non-matching keys as there are shuffle
    partitions, chosen by a hash of the row so a retried task routes rows the
    same way. ``spread_by``: columns that tell rows apart; a hash of the whole
    row would keep every column in the exchanges of the lookups before."""
    if how not in ("left", "left_outer"):
        return fact.join(dim, fact[fact_key] == dim[dim_key], how)
    f2, d2, salted = _spread_null_keys(fact, dim, fact_key, spread_by)
    return f2.join(d2, (f2[fact_key] == d2[dim_key]) & salted, "left").drop("_salt", "_dsalt")


def _spread_null_keys(fact: DataFrame, dim: DataFrame, fact_key: str, spread_by: list[str] | None = None):
    """Join on (key, salt): dimension rows carry salt 0, fact rows with a key
    too; NULL-key fact rows get salt 1..shuffle partitions from a hash of the
    row, so they spread over all reducers (and never match)."""
    null_salt = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(
        F.col(fact_key).isNull(),
        F.pmod(F.xxhash64(*[F.col(c) for c in spread_by or fact.columns]), F.lit(null_salt)) + 1,
    ).otherwise(F.lit(0))
    f2 = fact.withColumn("_salt", salt.cast("int"))
    d2 = bounded(dim.withColumn("_dsalt", F.lit(0)))
    return f2, d2, f2["_salt"] == d2["_dsalt"]


def point_in_time_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_ts: str,
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
) -> DataFrame:
    """SCD2 as-of lookup: the dimension version whose ``[valid_from,
    valid_to)`` holds the fact time. An equi-join on the business key with a
    range residual, so the work per key is bounded by that key's history.
    NULL fact keys (sales without a customer, possibly a large share) are
    spread as in ``lookup_join``."""
    f, d, salted = _spread_null_keys(fact, dim, fact_key)
    cond: Column = (
        (f[fact_key] == d[dim_key])
        & salted
        & (f[fact_ts] >= d[valid_from])
        & (d[valid_to].isNull() | (f[fact_ts] < d[valid_to]))
    )
    return f.join(d, cond, "left").drop("_salt", "_dsalt")


def point_in_time_sliced(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_ts: str,
    slice_by: str = "month",
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
) -> DataFrame:
    """``point_in_time_join`` for keys with very many versions and facts: work
    per key is not facts x versions but one merge by time, cut into slices.

    1. Versions and facts are dealt to slices of time; of each (key, slice) the
       last version is kept in an aggregate, a row a slice.
    2. A window over a key's slices (not its versions) carries the version in
       force at the start of each slice that has facts.
    3. Within a (key, slice), carried version, versions and facts are one
       sequence in time, and each fact takes the last version before it.

    A hot key is as many tasks' work as it has slices. Versions of a key must
    not overlap; facts without a key or a time get none and are not shuffled."""
    payload = [c for c in dim.columns if c not in (dim_key,)]
    some = F.col(fact_key).isNotNull() & F.col(fact_ts).isNotNull()
    at = lambda c: F.date_trunc(slice_by, F.col(c).cast("timestamp_ntz"))
    f = fact.filter(some).select(F.struct(*fact.columns).alias("_fact"), F.col(fact_key).alias("_k"), F.col(fact_ts).alias("_t"), at(fact_ts).alias("_slice"))
    v = dim.filter(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_k"), F.col(valid_from).alias("_t"), F.struct(*payload).alias("_v"), at(valid_from).alias("_slice"))
    ends = v.groupBy("_k", "_slice").agg(F.max_by("_v", "_t").alias("_last"))
    marks = f.groupBy("_k", "_slice").agg(F.lit(True).alias("_mark"))
    by_slice = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    grid = ends.join(marks, ["_k", "_slice"], "full_outer").withColumn("_v", F.last("_last", ignorenulls=True).over(by_slice))
    carried = grid.filter("_mark and _v is not null").select("_k", "_slice", "_v", F.lit(0).alias("_rank"), F.lit(None).cast(f.schema["_t"].dataType).alias("_t"))
    kind = f.schema["_fact"].dataType
    versions = v.join(marks.select("_k", "_slice"), ["_k", "_slice"], "left_semi").select("_k", "_slice", "_v", F.lit(1).alias("_rank"), "_t")
    rows = carried.unionByName(versions).withColumn("_fact", F.lit(None).cast(kind))
    rows = rows.unionByName(f.select("_k", "_slice", F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), F.lit(2).alias("_rank"), "_t", "_fact"))
    # carried first (no time), then by time; a version that begins with a fact comes before it
    by_time = Window.partitionBy("_k", "_slice").orderBy(F.col("_t").asc_nulls_first(), "_rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_v", F.last("_v", ignorenulls=True).over(by_time)).filter("_rank = 2")
    held = F.col(f"_v.{valid_to}").isNull() | (F.col("_t") < F.col(f"_v.{valid_to}"))
    found = rows.select("_fact.*", F.col("_k").alias(dim_key), *[F.when(held, F.col(f"_v.{c}")).alias(c) for c in payload])
    found = found.withColumn(dim_key, F.when(F.col(valid_from).isNotNull(), F.col(dim_key)))
    none = fact.filter(~some).select(*fact.columns, F.lit(None).cast(dim.schema[dim_key].dataType).alias(dim_key), *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in payload])
    return found.unionByName(none)
