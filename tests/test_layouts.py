from __future__ import annotations

import itertools
import statistics

import pytest
from pyspark.sql import functions as F

from strata.operators.zorder import buckets, hilbert_layout, hilbert_value, order_key, zorder_layout


@pytest.mark.parametrize(("columns", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_neighbours(spark, columns, bits):
    cells = list(itertools.product(range(1 << bits), repeat=columns))
    names = [f"c{i}" for i in range(columns)]
    df = spark.createDataFrame(cells, ", ".join(f"{n} long" for n in names))
    rows = sorted(df.select(hilbert_value([F.col(n) for n in names], bits).alias("h"), *names).collect())
    assert [r[0] for r in rows] == list(range(len(cells)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1


def _events(spark):
    """A day and an address: all addresses share their first twenty bytes."""
    return spark.range(40_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(365))).cast("int").alias("day"),
        F.format_string("https://example.org/%05d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000))).alias("url"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("maybe"),
    )


def _spans(df, path):
    df.write.parquet(path)
    number = F.substring("url", 21, 5).cast("int")
    got = df.sparkSession.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg((F.max("day") - F.min("day")).alias("d"), (F.max(number) - F.min(number)).alias("u")).collect()
    return statistics.mean(r["d"] / 365 for r in got), statistics.mean(r["u"] / 5000 for r in got)


def test_files_cover_small_ranges_of_a_day_and_a_prefixed_string(spark, tmp_path):
    df = _events(spark)
    z = _spans(zorder_layout(df, ["day", "url"], 32), str(tmp_path / "z"))
    h = _spans(hilbert_layout(df, ["day", "url"], 32), str(tmp_path / "h"))
    assert max(h) < 0.45 and max(z) < 0.7
    assert sum(h) < sum(z)  # a file of the curve never jumps across the space


def test_rows_are_unchanged_with_nulls_binaries_and_empty_tables(spark):
    df = _events(spark).limit(500).withColumn("bytes", F.col("url").cast("binary"))
    for layout in (zorder_layout, hilbert_layout):
        out = layout(df, ["maybe", "bytes", "url"], 4)
        assert out.columns == df.columns
        assert out.exceptAll(df).count() == 0 and out.count() == 500
        assert layout(df.filter("day < 0"), ["maybe", "url"], 4).count() == 0
        with pytest.raises(ValueError, match="at least one column"):
            layout(df, [], 4)
    with pytest.raises(TypeError):
        order_key(df.select(F.array("day").alias("x")), "x")


def test_buckets_of_a_string_are_even(spark):
    df = _events(spark).withColumn("_k0", F.col("url").cast("binary"))
    got = df.select(buckets(df, ["url"], 3)[0].alias("b")).groupBy("b").count().collect()
    assert len(got) == 8 and max(r["count"] for r in got) < 1.3 * 40_000 / 8
