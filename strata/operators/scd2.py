"""Slowly changing dimension, type 2.

One full outer join of the current dimension rows with the incoming snapshot
on the business key classifies each key:

* only in the dimension  -> unchanged (no delete semantics)
* only in the source     -> new key: insert version 1
* both, attributes equal -> unchanged (NULL-safe comparison, so a re-run with
  the same snapshot creates nothing: idempotent)
* both, attributes differ -> expire the current row (``_valid_to = as_of``,
  ``_is_current = false``) and insert a new current version

New versions get new surrogate keys (``max(sk)`` + dense rank by business
key) so facts keep pointing at the version that was current when they
happened. Expired history rows pass through untouched.

``scd2_apply`` takes full snapshots in any order and with deletions: a
back-dated one is put into the middle of the histories that it changes.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest
from strata.session import written
from strata.operators.keys import max_key, with_dense_keys

VALID_FROM, VALID_TO, IS_CURRENT = "_valid_from", "_valid_to", "_is_current"


def _ts(as_of) -> F.Column:
    if isinstance(as_of, (_dt.datetime, str)):
        return F.lit(as_of).cast("timestamp_ntz")
    return as_of


def scd2_initial(
    source: DataFrame, bk: str, sk: str, attrs: list[str], as_of, bk_out: str | None = None
) -> DataFrame:
    """First load: every key becomes version 1 with a dense surrogate key."""
    bk_out = bk_out or bk
    src = dedupe_latest(source.select(bk, *attrs), [bk]).filter(F.col(bk).isNotNull())
    keyed = with_dense_keys(src.withColumnRenamed(bk, bk_out), bk_out, sk)
    return keyed.select(
        sk, bk_out, *attrs,
        _ts(as_of).alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
    )


def scd2_merge(
    dim: DataFrame,
    source: DataFrame,
    bk: str,
    sk: str,
    attrs: list[str],
    as_of,
    source_bk: str | None = None,
) -> DataFrame:
    """Apply one snapshot of ``source`` to the type-2 dimension ``dim``.

    A snapshot older than the dimension's latest version is refused: it would
    close a version before it began."""
    source_bk = source_bk or bk
    cols = [sk, bk, *attrs, VALID_FROM, VALID_TO, IS_CURRENT]
    ts = _ts(as_of)
    if dim.agg((F.max(VALID_FROM) > ts).alias("late")).first()["late"]:
        raise ValueError(f"the dimension has versions that begin after {as_of}")
    hist = dim.filter(~F.col(IS_CURRENT)).select(*cols)
    cur = dim.filter(F.col(IS_CURRENT)).select(*cols)
    src = dedupe_latest(
        source.select(F.col(source_bk).alias(bk), *attrs).filter(F.col(bk).isNotNull()), [bk]
    )
    t = cur.select([F.col(c).alias(f"t_{c}") for c in cols])
    s = src.select([F.col(c).alias(f"s_{c}") for c in [bk, *attrs]])
    j = t.join(s, t[f"t_{bk}"] == s[f"s_{bk}"], "full_outer")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"t_{a}").eqNullSafe(F.col(f"s_{a}")) for a in attrs],
        F.lit(True),
    )
    has_t, has_s = F.col(f"t_{bk}").isNotNull(), F.col(f"s_{bk}").isNotNull()
    changed = has_t & has_s & ~same
    old_row = F.struct(
        *[F.col(f"t_{c}").alias(c) for c in [sk, bk, *attrs, VALID_FROM]],
        F.when(changed, ts).otherwise(F.col(f"t_{VALID_TO}")).alias(VALID_TO),
        F.when(changed, F.lit(False)).otherwise(F.col(f"t_{IS_CURRENT}")).alias(IS_CURRENT),
        F.lit(False).alias("_new"),
    )
    new_row = F.struct(
        F.lit(None).cast("long").alias(sk),
        *[F.col(f"s_{c}").alias(c) for c in [bk, *attrs]],
        ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        F.lit(True).alias("_new"),
    )
    rows = F.array(
        F.when(has_t, old_row),
        F.when(has_s & (~has_t | changed), new_row),
    )
    # Materialise once: both the key assignment and the untouched rows read it.
    out = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")
    out = written(out, "scd2-rows")
    base = max_key(dim, sk)
    inserts = with_dense_keys(
        out.filter(F.col("_new")).drop(sk, "_new"), bk, sk, offset=base
    ).select(*cols)
    kept = out.filter(~F.col("_new")).select(*cols)
    return hist.unionByName(kept).unionByName(inserts)


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    bk: str,
    sk: str,
    attrs: list[str],
    as_of,
    snapshots: list,
    source_bk: str | None = None,
) -> DataFrame:
    """Applies the full snapshot ``source``, as it was at ``as_of``, whatever
    the order: the versions are those of all snapshots in the order of time.
    ``snapshots`` are the times of the ones applied before (one value a run).

    A version says what all snapshots within it said. So a snapshot that says
    something else holds up to the next one only, and what the version said
    goes on from there. A key that the snapshot lacks is deleted from then to
    the next snapshot. Only histories that change are cut anew, each with a row
    a version: into the points in time at which its state is known, of which
    equal neighbours join. A version that goes on to begin where it did, or
    that joins an earlier part, keeps its surrogate key; other new parts get
    new ones."""
    source_bk = source_bk or bk
    cols = [sk, bk, *attrs, VALID_FROM, VALID_TO, IS_CURRENT]
    as_time = lambda x: _dt.datetime.fromisoformat(x) if isinstance(x, str) else x
    later = sorted(as_time(s) for s in snapshots if as_time(s) > as_time(as_of))
    ts, nxt = _ts(as_of), _ts(later[0]) if later else None
    state = lambda of="": F.struct(*[F.col(of + a).alias(a) for a in attrs])
    src = dedupe_latest(source.select(F.col(source_bk).alias(bk), *attrs).filter(F.col(bk).isNotNull()), [bk])
    src = src.select(bk, state().alias("said"))

    def at(time):
        return (F.col(VALID_FROM) <= time) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > time))

    held = dim.filter(at(ts)).select(bk, state().alias("held"))
    changed = held.join(src, bk, "full_outer").filter(~F.col("held").eqNullSafe(F.col("said"))).select(bk, "said")
    changed = written(changed, "scd2-changed")
    own = written(dim.join(changed.select(bk), bk, "left_semi").select(*cols), "scd2-histories")

    def point(df, time, what, key, rank):
        return df.select(bk, time.alias("t"), what.alias("state"), key.cast("long").alias(sk), F.lit(rank).alias("rank"))

    none, gone = F.lit(None), F.lit(None).cast(changed.schema["said"].dataType)
    points = [
        point(changed, ts, F.col("said"), none, 3),
        point(own, F.col(VALID_FROM), state(), F.col(sk), 2),
        point(own.filter(F.col(VALID_TO).isNotNull()), F.col(VALID_TO), gone, none, 0),
    ]
    if nxt is not None:  # what the next snapshot said
        points += [point(own.filter(at(nxt)), nxt, state(), none, 1), point(changed, nxt, gone, none, 0)]
    known = points[0]
    for p in points[1:]:
        known = known.unionByName(p)
    # the best source of each time; a version that begins there lends its key
    known = known.groupBy(bk, "t").agg(F.max_by("state", "rank").alias("state"), F.max(sk).alias(sk))
    by_key = Window.partitionBy(bk).orderBy("t")
    known = known.withColumn("first", ~F.col("state").eqNullSafe(F.lag("state").over(by_key)))
    known = known.withColumn("run", F.sum(F.col("first").cast("int")).over(by_key))
    key = F.min_by(sk, F.when(F.col(sk).isNotNull(), F.col("t")))
    runs = known.groupBy(bk, "run").agg(F.min("t").alias(VALID_FROM), F.min_by("state", "t").alias("state"), key.alias(sk))
    runs = runs.withColumn(VALID_TO, F.lead(VALID_FROM).over(Window.partitionBy(bk).orderBy("run"))).filter("state is not null")
    runs = written(runs.select(sk, bk, "state.*", VALID_FROM, VALID_TO, F.col(VALID_TO).isNull().alias(IS_CURRENT)), "scd2-runs")
    new = runs.filter(F.col(sk).isNull()).drop(sk).withColumn("_at", F.struct(bk, VALID_FROM))
    new = with_dense_keys(new, "_at", sk, offset=max_key(dim, sk))
    rest = dim.join(changed.select(bk), bk, "left_anti")
    return rest.select(*cols).unionByName(runs.filter(F.col(sk).isNotNull()).select(*cols)).unionByName(new.select(*cols))
