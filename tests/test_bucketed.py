"""The co-located merge: no exchange above the table, the merge's rules."""

import uuid

import pytest

from strata.sources.bucketed import BucketedTable

KIND = "id long, v int, at int"


@pytest.fixture
def table(spark, tmp_path):
    t = BucketedTable(spark, f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "t"), ["id"], 4)
    t.create(spark.createDataFrame([(i, 1, 5) for i in range(100)] + [(None, 1, 1)], KIND))
    yield t
    for g in t._generations():
        spark.sql(f"DROP TABLE {t.name}__g{g}")


def rows(t):
    return sorted((tuple(r) for r in t.read().collect()), key=lambda r: (r[0] is None, r[0] or 0, r))


def test_the_batch_alone_is_shuffled(spark, table):
    source = spark.createDataFrame([(1, 2, 9), (500, 2, 9)], KIND)
    plan = table.merged(source)._jdf.queryExecution().executedPlan().toString()
    side = next(x for x in plan.split("FullOuter", 1)[1].split("\n:- ") if "Scan parquet" in x) if ":- " in plan else plan
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    # each exchange stands above the source (the dedupe of its keys and its dealing), none above the scan
    scan = plan[: plan.index("Scan parquet")].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    above, at = [], depth(plan[plan.rindex("\n", 0, plan.index("Scan parquet")) + 1 :].splitlines()[0])
    for line in reversed(scan[:-1]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    assert above and not any("Exchange" in line for line in above), side


def test_update_insert_and_null_keys(spark, table):
    table.merge(spark.createDataFrame([(1, 2, 9), (500, 2, 9), (None, 3, 3)], KIND))
    want = [(i, 2 if i == 1 else 1, 9 if i == 1 else 5) for i in range(100)] + [(500, 2, 9), (None, 1, 1), (None, 3, 3)]
    assert rows(table) == want and table._generations() == [2]


def test_a_condition_decides_between_both_rows(spark, table):
    table.merge(spark.createDataFrame([(1, 2, 4), (2, 2, 6), (3, 2, None), (700, 2, 1)], KIND), lambda new, old: new("at") >= old("at"))
    got = {r[0]: r[1] for r in rows(table)}
    assert (got[1], got[2], got[3], got[700]) == (1, 2, 2, 2)


def test_a_stopped_merge_leaves_the_table(spark, table, monkeypatch):
    before = rows(table)

    def fail(df, g):
        df.write.parquet(f"{table.path}/g{g}")
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(table, "_write", fail)
        with pytest.raises(RuntimeError):
            table.merge(spark.createDataFrame([(1, 2, 9)], KIND))
    assert rows(table) == before
    table.merge(spark.createDataFrame([(1, 2, 9)], KIND))
    assert {r[0]: r[1] for r in rows(table)}[1] == 2
