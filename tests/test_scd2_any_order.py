"""Snapshots in any order give one history."""

import datetime as dt
import itertools
import random

import pytest

from strata.operators.scd2 import scd2_apply, scd2_initial
from strata.session import written

DAY = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]


def plain(snapshots):
    """{(key, attribute, from, to)} by walking over the snapshots in time."""
    out, times = set(), sorted(snapshots)
    for k in {k for s in snapshots.values() for k in s}:
        begun = now = None
        for t in times:
            said = snapshots[t].get(k)
            if said != now:
                if now is not None:
                    out.add((k, now[0], begun, t))
                begun, now = t, said
        if now is not None:
            out.add((k, now[0], begun, None))
    return out


def built(spark, snapshots, order):
    dim, done = None, []
    for t in order:
        df = spark.createDataFrame([(k, v[0]) for k, v in snapshots[t].items()], "bk string, city string")
        dim = scd2_initial(df, "bk", "sk", ["city"], t) if dim is None else scd2_apply(dim, df, "bk", "sk", ["city"], t, done)
        dim, done = written(dim, "any-order"), [*done, t]
    return dim.collect()


def histories(rows):
    assert len({r["sk"] for r in rows}) == len(rows) and all(r["sk"] for r in rows)
    assert all(r["_is_current"] == (r["_valid_to"] is None) for r in rows)
    return {(r["bk"], r["city"], r["_valid_from"], r["_valid_to"]) for r in rows}


@pytest.mark.parametrize("seed", range(2))
def test_any_order_gives_the_history_of_all(spark, seed):
    r = random.Random(seed)
    snapshots = {t: {f"k{i}": (r.choice(["a", "b", None]),) for i in range(12) if r.random() < 0.75} for t in DAY}
    for order in r.sample(list(itertools.permutations(DAY)), 3):
        assert histories(built(spark, snapshots, order)) == plain(snapshots), order


def test_a_back_dated_change_keeps_the_keys_of_its_neighbours(spark):
    a, b = ("a",), ("b",)
    snapshots = {DAY[0]: {"x": a, "y": a}, DAY[2]: {"x": a, "y": a}, DAY[1]: {"x": b, "y": a}}
    rows = built(spark, snapshots, [DAY[0], DAY[2], DAY[1]])
    x = sorted((r["_valid_from"], r["city"], r["sk"]) for r in rows if r["bk"] == "x")
    assert [v[:2] for v in x] == [(DAY[0], "a"), (DAY[1], "b"), (DAY[2], "a")]
    assert x[0][2] <= 2 < min(x[1][2], x[2][2])  # the first part keeps its key, the others are new
    again = scd2_apply(spark.createDataFrame(rows), spark.createDataFrame([("x", "b"), ("y", "a")], "bk string, city string"), "bk", "sk", ["city"], DAY[1], DAY[:3])
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, rows), key=repr)  # idempotent


def test_a_corrected_snapshot_replaces_what_it_said(spark):
    rows = built(spark, {DAY[0]: {"x": ("a",)}, DAY[1]: {"x": ("b",)}}, DAY[:2])
    fixed = scd2_apply(spark.createDataFrame(rows), spark.createDataFrame([("x", "c")], "bk string, city string"), "bk", "sk", ["city"], DAY[1], DAY[:2])
    got = {(r["city"], r["_valid_from"], r["sk"]) for r in fixed.collect()}
    assert got == {("a", DAY[0], 1), ("c", DAY[1], 2)}
