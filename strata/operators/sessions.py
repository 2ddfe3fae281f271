"""Gap-based sessions (a new session starts after more than ``gap`` of
inactivity), computed so that one very active user is not one task.

Time is cut into slots of the length of the gap. Two events of a user in one
slot are less than a gap apart, so a slot never splits:

1. events are pre-aggregated into pieces, one per (user, slot), map-side; a
   user's pieces are bounded by the time span, not by its number of events;
2. a window over a user's pieces in time order finds the pieces that open a
   session (more than the gap after the previous piece's end), a second one
   gives each session's end and size;
3. each event joins its piece on (user, slot). Both sides are tables in the
   shared folder, so the adaptive skew join splits a hot (user, slot).

No window runs over event rows. The result equals the single-window
definition; ``gap`` is compared in microseconds, and a gap of exactly ``gap``
continues the session (the same rule as ``session_window``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import written

SESSION_COLUMNS = {"session_start": "timestamp_ntz", "session_end": "timestamp_ntz", "session_events": "long",
                   "session_duration_seconds": "long"}


def _us_between(a, b):
    return F.timestamp_diff("MICROSECOND", a, b)


def _slot(ts: str, gap_us: int) -> Column:
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    return F.floor(micros / gap_us)


def _pieces(ev: DataFrame, user: str, ts: str, gap_us: int) -> DataFrame:
    """(user, slot) pieces with their session's start, end and size."""
    piece = ev.groupBy(user, "_slot").agg(
        F.min(ts).alias("_begin"), F.max(ts).alias("_end"), F.count(F.lit(1)).alias("_n")
    )
    by_user = Window.partitionBy(user).orderBy("_begin")
    prev_end = F.lag("_end").over(by_user)
    opens = F.when(prev_end.isNull() | (_us_between(prev_end, F.col("_begin")) > gap_us), F.col("_begin"))
    piece = piece.withColumn(
        "session_start",
        F.last(opens, ignorenulls=True).over(by_user.rowsBetween(Window.unboundedPreceding, 0)),
    )
    per_s = Window.partitionBy(user, "session_start")
    return piece.select(
        user, "_slot", "session_start",
        F.max("_end").over(per_s).alias("session_end"),
        F.sum("_n").over(per_s).cast("long").alias("session_events"),
    )


def gap_sessions(df: DataFrame, user: str, ts: str, gap_seconds: int = 1800) -> DataFrame:
    """Add ``session_start``, ``session_end``, ``session_events`` and
    ``session_duration_seconds`` to every row; they are NULL where ``user`` or
    ``ts`` is (such rows belong to no session and need no shuffle)."""
    gap_us = gap_seconds * 1_000_000
    ev = written(df.withColumn("_slot", F.when(F.col(user).isNotNull(), _slot(ts, gap_us))), "session-events")
    own = ev.filter(F.col("_slot").isNotNull())
    piece = written(_pieces(own, user, ts, gap_us), "session-pieces")
    joined = own.join(piece, [user, "_slot"]).withColumn(
        "session_duration_seconds",
        F.floor(_us_between(F.col("session_start"), F.col("session_end")) / 1_000_000).cast("long"),
    )
    columns = [*df.columns, *SESSION_COLUMNS]
    types = {**SESSION_COLUMNS, "session_start": df.schema[ts].dataType, "session_end": df.schema[ts].dataType}
    none = ev.filter(F.col("_slot").isNull()).withColumns({c: F.lit(None).cast(t) for c, t in types.items()})
    return joined.select(*columns).unionByName(none.select(*columns))


def sessions_summary(df: DataFrame, user: str, ts: str, gap_seconds: int = 1800) -> DataFrame:
    """One row per session, shaped like ``session_window`` output: window
    start = first event, window end = last event + gap, event count. From the
    pieces alone; rows without a user or a time have no session."""
    gap_us = gap_seconds * 1_000_000
    ev = df.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()).withColumn("_slot", _slot(ts, gap_us))
    return (
        _pieces(ev, user, ts, gap_us)
        .groupBy(user, "session_start")
        .agg(F.max("session_end").alias("_last"), F.max("session_events").alias("events"))
        .select(
            F.col(user), F.col("session_start").alias("window_start"),
            (F.col("_last") + F.expr(f"INTERVAL {gap_seconds} SECONDS")).alias("window_end"), "events",
        )
    )


def _days(lo: str, hi: str, by: str) -> Column:
    """The days (or months, as ``by`` formats them) from ``lo`` to ``hi``, one a row."""
    days = F.sequence(F.to_date(lo), F.to_date(hi), F.expr("interval 1 day"))
    return F.explode(F.array_distinct(F.transform(days, lambda d: F.date_format(d, by)))).alias("day")


def session_days(sessions: DataFrame, user: str, by: str = "yyyy-MM-dd") -> DataFrame:
    """A row for each day that a session covers: what touching sessions are looked up by."""
    return sessions.select(user, "session_start", "session_end", _days("session_start", "session_end", by))


def reach_of(events: DataFrame, user: str, ts: str, gap_seconds: int = 1800, by: str = "yyyy-MM-dd") -> DataFrame:
    """(user, lo, hi, day): the time that new events reach, the gap included,
    a row for each day in it. Events of a slot reach as one, so a user has a
    bounded number of rows a day."""
    gap = F.expr(f"INTERVAL {gap_seconds} SECONDS")
    ev = events.filter(F.col(user).isNotNull() & F.col(ts).isNotNull()).withColumn("_slot", _slot(ts, gap_seconds * 1_000_000))
    piece = ev.groupBy(user, "_slot").agg((F.min(ts) - gap).alias("lo"), (F.max(ts) + gap).alias("hi"))
    return piece.select(user, "lo", "hi", _days("lo", "hi", by))


def touched_sessions(stored: DataFrame, reach: DataFrame, user: str) -> DataFrame:
    """The sessions of ``stored`` (as by ``session_days``) that new events may
    join. One round is enough: stored sessions are more than the gap apart, so
    whatever a session grown by new events meets is met by a new event itself."""
    r = reach.select(F.col(user).alias("_u"), "lo", "hi", F.col("day").alias("_d"))
    meets = (F.col(user) == F.col("_u")) & (F.col("day") == F.col("_d")) & (F.col("session_start") <= F.col("hi")) & (F.col("session_end") >= F.col("lo"))
    return stored.join(r, meets, "left_semi").select(user, "session_start", "session_end").distinct()
