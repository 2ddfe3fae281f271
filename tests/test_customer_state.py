"""Customer 360 from retractable states equals the full build."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans import gold
from strata.plans.customer_state import CustomerState, merge_sales
from strata.sources.partitioned import KeyedTable

KIND = "transaction_id string, customer_id string, payment_method string, sale_date timestamp_ntz, total_amount decimal(14,2), _processed_at timestamp_ntz"
AS_OF = "2025-01-01 00:00:00"


def sale(t, n, r):
    day = None if r.random() < 0.1 else dt.datetime(2024, 1, 1) + dt.timedelta(days=r.randint(0, 60))
    return t, r.choice(["ann", "bob", "cy", None]), r.choice(["CARD", "CASH", None]), day, None if r.random() < 0.1 else Decimal(r.randint(1, 9000)) / 100, dt.datetime(2024, 6, n)


def lake(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "silver"), ["transaction_id"], F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit("undated")), 2)
    return t, CustomerState(spark, str(tmp_path / "state"), 2)


def same(target, state):
    want = gold.build_customer_360(target.read(), AS_OF).drop("_processed_at")
    got = state.table.read().select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_corrections_and_removals_equal_the_full_build(spark, tmp_path):
    r = random.Random(7)
    target, state = lake(spark, tmp_path)
    for n in range(1, 4):
        sales = spark.createDataFrame([sale(f"t{i}", n, r) for i in r.sample(range(30), 15)], KIND)
        gone = spark.createDataFrame([(f"t{r.randint(0, 29)}",) for _ in range(3)], "transaction_id string")
        merge_sales(target, state, sales, AS_OF, f"b{n}", latest=[F.col("_processed_at").desc()], deletes=gone if n > 1 else None)
        same(target, state)
        state.compact(f"b{n}")
    assert len(state._folders()) == 2  # the base and the last batch
    state.refresh(target.read().select("customer_id"), AS_OF)
    same(target, state)


@pytest.mark.parametrize("stop", ["apply", "refresh"])
def test_a_repeated_batch_counts_once(spark, tmp_path, monkeypatch, stop):
    r = random.Random(3)
    target, state = lake(spark, tmp_path)
    merge_sales(target, state, spark.createDataFrame([sale(f"t{i}", 1, r) for i in range(12)], KIND), AS_OF, "b1")
    second = spark.createDataFrame([sale(f"t{i}", 2, r) for i in range(8, 16)], KIND)

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(state, stop, fail)
        with pytest.raises(RuntimeError):
            merge_sales(target, state, second, AS_OF, "b2")
    for _ in range(2):
        merge_sales(target, state, second, AS_OF, "b2")
    same(target, state)


def test_only_the_batchs_customers_are_built_anew(spark, tmp_path):
    target, state = lake(spark, tmp_path)
    first = [(f"t{i}", c, "CARD", None, Decimal(1), None) for i, c in enumerate(["ann", "bob", "cy", "dan", "eve"])]
    merge_sales(target, state, spark.createDataFrame(first, KIND), AS_OF, "b1")
    merge_sales(target, state, spark.createDataFrame([("t1", "ann", "CARD", None, Decimal(2), None)], KIND), "2025-02-01 00:00:00", "b2")
    at = {x["customer_bk"]: str(x["_processed_at"])[:7] for x in state.table.read().collect()}
    assert at == {"ann": "2025-02", "cy": "2025-01", "dan": "2025-01", "eve": "2025-01"}  # bob has no sale left
