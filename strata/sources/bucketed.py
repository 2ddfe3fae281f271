"""Co-located merge: a table bucketed by its key in the session catalog.

The table's files are dealt by the hash of the key, so a merge shuffles the
batch alone into as many partitions and joins it with the table bucket by
bucket: no exchange stands above the table's scan, and each task writes the
one bucket it holds. The join reads and writes every bucket (a full merge);
``partitioned.KeyedTable`` is for tables where a batch touches few partitions.

A merge writes a new generation of the table, ``name__g<n>`` in a folder of
its own, and drops the old one when it is registered, so a merge that stops
leaves the table as it was. One writer per table. NULL keys match nothing."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import prepare_source, validate_merge_key
from strata.sources.partitioned import _hadoop


class BucketedTable:
    def __init__(self, spark: SparkSession, name: str, path: str, keys: list[str], buckets: int = 32):
        self.spark, self.name, self.path, self.keys, self.buckets = spark, name, path.rstrip("/"), list(keys), buckets

    def _generations(self) -> list[int]:
        found = (re.fullmatch(re.escape(self.name.lower()) + r"__g(\d+)", t.name.lower()) for t in self.spark.catalog.listTables())
        return sorted(int(m[1]) for m in found if m)

    def exists(self) -> bool:
        return bool(self._generations())

    def read(self) -> DataFrame:
        return self.spark.table(f"{self.name}__g{self._generations()[-1]}")

    def _write(self, df: DataFrame, g: int) -> None:
        folder = f"{self.path}/g{g}"
        fs, p = _hadoop(self.spark, folder)
        if fs.exists(p):  # of a merge that stopped
            fs.delete(p, True)
        df.write.option("path", folder).bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(f"{self.name}__g{g}")

    def create(self, df: DataFrame, order: list[Column] | None = None) -> None:
        validate_merge_key(df, self.keys)
        src = prepare_source(df, self.keys, order)
        self._write(src.repartition(self.buckets, *self.keys), 1)

    def merged(self, source: DataFrame, wins: Callable | None = None) -> DataFrame:
        """The table after the merge, as a plan. The source's row wins, or if
        ``wins(new, old)`` says so: a condition over columns of both rows, such
        as ``lambda new, old: new("at") >= old("at")`` (NULL counts as true)."""
        target = self.read()
        columns = target.columns
        src = prepare_source(source.select(*columns), self.keys)
        side = lambda df, s: df.select(*[F.col(c).alias(f"_{s}_{c}") for c in columns], F.lit(True).alias(f"_{s}"))
        # as many partitions as buckets, by the same hash
        t, s = side(target, "t"), side(src.repartition(self.buckets, *self.keys), "s")
        on = None
        for k in self.keys:
            c = F.col(f"_t_{k}") == F.col(f"_s_{k}")
            on = c if on is None else on & c
        j = t.join(s.hint("merge"), on, "full_outer")
        newer = F.col("_s") if wins is None else F.col("_s") & (F.col("_t").isNull() | F.coalesce(wins(lambda c: F.col(f"_s_{c}"), lambda c: F.col(f"_t_{c}")), F.lit(True)))
        return j.select(*[F.when(newer, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in columns])

    def merge(self, source: DataFrame, wins: Callable | None = None) -> None:
        g = self._generations()[-1]
        self._write(self.merged(source, wins), g + 1)
        self.spark.sql(f"DROP TABLE {self.name}__g{g}")
        fs, p = _hadoop(self.spark, f"{self.path}/g{g}")
        fs.delete(p, True)
