"""The sliced as-of lookup equals the plain one."""

import datetime as dt
import random

from strata.operators.joins import point_in_time_join, point_in_time_sliced

D0 = dt.datetime(2024, 1, 1)


def test_a_hot_key_with_many_versions_and_facts(spark):
    r = random.Random(4)
    days = lambda n: D0 + dt.timedelta(days=n)
    versions, n = [], 0
    for key, count in (("hot", 400), ("a", 3), ("gap", 30)):
        at = sorted(r.sample(range(900), count))
        for i, (lo, hi) in enumerate(zip(at, [*at[1:], None])):
            n += 1
            closes = hi if key != "gap" or hi is None else lo + max(1, (hi - lo) // 2)  # histories with holes
            versions.append((n, key, days(lo), None if closes is None else days(closes)))
    versions.append((9999, None, days(1), None))
    facts = [(i, r.choice(["hot", "hot", "a", "gap", "none", None]), r.choice([None, *[days(r.randint(-20, 950)) + dt.timedelta(hours=r.choice([0, 5])) for _ in range(8)]])) for i in range(1500)]
    f = spark.createDataFrame(facts, "id long, k string, at timestamp_ntz")
    d = spark.createDataFrame(versions, "sk long, bk string, _valid_from timestamp_ntz, _valid_to timestamp_ntz")
    want = point_in_time_join(f, d, "k", "bk", "at").select("id", "k", "at", "sk", "bk", "_valid_from", "_valid_to")
    for slice_by in ("month", "day"):
        got = point_in_time_sliced(f, d, "k", "bk", "at", slice_by).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert point_in_time_sliced(f.limit(0), d, "k", "bk", "at").count() == 0
    assert point_in_time_sliced(f, d.limit(0), "k", "bk", "at").filter("sk is null").count() == 1500
