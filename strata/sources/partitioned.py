"""Partition-scoped writes for large tables: O(touched partitions), not
O(table).

``KeyedTable`` (below) is what the jobs and streams merge into: its rows may
move between partitions. ``upsert_partitions`` is the smaller tool for tables
whose partition the key determines. Its table is a plain partitioned Parquet folder. An upsert

1. takes the distinct partition values of the batch (one row per partition,
   a bounded set);
2. reads only those partitions of the table: the semi-join on the partition
   columns lets dynamic partition pruning skip every other folder at scan;
3. merges them with the batch (``merge_upsert``), writes the result to the
   shared folder (the output path is also an input), and
4. overwrites just those partitions (``partitionOverwriteMode=dynamic``).

Precondition: a key's rows always live in one partition (partition columns
are part of the record's identity, e.g. a date the key determines);
otherwise an old copy in an untouched partition survives. There is no time
travel and partitions are replaced one by one (not atomically as a set); use
``SnapshotTable`` where those matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.dedupe import dedupe_latest
from strata.operators.joins import bounded
from strata.operators.merge import merge_upsert, prepare_source, validate_merge_key
from strata.operators.zorder import hilbert_layout
from strata.session import written


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def upsert_partitions(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    merge_key: list[str],
    partition_by: list[str],
    order: list[Column] | None = None,
    null_safe: bool = False,
) -> None:
    validate_merge_key(source, merge_key)
    if not partition_by:
        raise ValueError("partition_by must name at least one column")
    missing = [c for c in partition_by if c not in source.columns]
    if missing:
        raise ValueError(f"partition columns not in DataFrame: {missing}")
    src = written(prepare_source(source, merge_key, order), "partition-batch")
    writer_opts = {"partitionOverwriteMode": "dynamic"}
    if not path_exists(spark, path):
        src.hint("rebalance", *partition_by).write.partitionBy(*partition_by).mode("overwrite").options(**writer_opts).parquet(path)
        return
    # the batch's types, also for the partition columns: inferred ones would
    # turn '01' into 1 and write it to another folder
    target = spark.read.schema(src.schema).parquet(path)
    touched = src.select(*partition_by).distinct()
    # semi-join on partition columns: planned with dynamic partition pruning
    # where the touched values are small enough for Spark to broadcast
    target_touched = target.join(touched, partition_by, "left_semi")
    merged = merge_upsert(
        target_touched.select(*src.columns), src, merge_key, null_safe=null_safe, on_duplicate="keep"
    )
    merged = written(merged, "partition-merged")  # the output path is also an input
    # REBALANCE on the partition columns: AQE splits a hot partition over
    # several tasks and packs small ones, so files are neither tiny nor huge.
    merged.hint("rebalance", *partition_by).write.partitionBy(*partition_by).mode("overwrite").options(**writer_opts).parquet(path)


#: The partition column of a keyed table, and the one of its index.
PART, BUCKET = "table_part", "key_bucket"


class PartitionedFolder:
    """Parquet under ``path``, partitioned by one text column, written a set of
    partitions at a time. Partitions are replaced one by one, so a reader may
    see some before others; a writer that stops is repeated as a whole."""

    def __init__(self, spark: SparkSession, path: str, column: str = PART, schema: StructType | None = None):
        self.spark, self.path, self.column, self._schema = spark, path.rstrip("/"), column, schema

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """All rows, or those of ``parts`` alone (pruned when planned)."""
        if self._schema is None:
            # stored by the first write: a folder without rows has no file to ask, and
            # inferred types would turn a partition '01' into 1 and days into dates
            kept = [f for f in self.spark.read.parquet(f"{self.path}__schema").schema if f.name != self.column]
            self._schema = StructType([*kept, StructField(self.column, StringType())])
        df = self.spark.read.schema(self._schema).parquet(self.path)
        return df if parts is None else df.filter(F.col(self.column).isin(parts))

    def files(self) -> DataFrame:
        """The partitions with the number and bytes of their files, from the
        listing alone."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.parquet").load(self.path)
        name = F.regexp_extract("path", f"/{self.column}=([^/]*)/[^/]*$", 1)
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        return found.groupBy(name.alias(self.column)).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))

    def replace(self, parts: list[str], rows: DataFrame) -> None:
        """The rows of ``parts`` become ``rows`` (a table that does not read
        this folder); partitions left without rows are removed."""
        old = []
        if not path_exists(self.spark, f"{self.path}__schema/_SUCCESS"):
            rows.limit(0).write.mode("overwrite").parquet(f"{self.path}__schema")
        if self.exists() and parts:
            left = [r[0] for r in rows.select(self.column).distinct().collect()]  # a row a partition
            gone = sorted(set(parts) - set(left))
            if gone:
                folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
                old = [r[0] for r in self.read(gone).select(folder).distinct().collect()]
        # REBALANCE: AQE splits a hot partition over several tasks and packs small ones
        rows.hint("rebalance", self.column).write.partitionBy(self.column).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(self.path)
        for folder in old:
            fs, p = _hadoop(self.spark, folder)
            fs.delete(p, True)


class KeyedTable:
    """One row per key in partitions by ``part`` (a text expression over the
    row, never NULL), merged in O(touched partitions).

    A compact index (``path/keys``: key and partition, in ``buckets`` folders by
    the key's hash) tells in which partition a key lives now, so a row whose
    partition changes leaves its old one. A merge reads and rewrites

    * the index buckets of the batch's keys, and
    * the partitions that the batch's rows have or that its keys lived in;

    their names go through the driver: a row a partition, not a row a key.

    A merge that stops half way is repeated with the same batch: the index is
    written last, so the old places of its keys are still found, and rows of a
    key in two partitions are rivals like any other. Keys are not NULL."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], part: Column, buckets: int = 16):
        self.spark, self.keys, self.part, self.buckets = spark, list(keys), part, buckets
        self.data = PartitionedFolder(spark, f"{path.rstrip('/')}/data")
        self.index = PartitionedFolder(spark, f"{path.rstrip('/')}/keys", BUCKET)
        self._tidied = f"{path.rstrip('/')}/tidied"

    def exists(self) -> bool:
        return self.index.exists()

    def read(self) -> DataFrame:
        return self.data.read().drop(PART)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string"))

    def _places(self, keys: DataFrame, rows: int | None = None) -> tuple[DataFrame, list[str], list[str]]:
        """Of ``keys`` (so many ``rows``): the known ones with their partition, these partitions, and all index buckets."""
        keys = self._bucketed(keys.select(*self.keys))
        buckets = [r[0] for r in keys.select(BUCKET).distinct().collect()]
        known = written(self.index.read(buckets).join(bounded(keys.drop(BUCKET), rows), self.keys, "left_semi").drop(BUCKET), "merge-known")
        return known, [r[0] for r in known.select(PART).distinct().collect()], buckets

    def _moved(self, known: DataFrame, new: DataFrame) -> list[str]:
        """The index buckets with a key that is new, gone or in another partition than ``known`` has."""
        a = known.select(*self.keys, F.col(PART).alias("_was"))
        b = new.select(*self.keys, F.col(PART).alias("_is"))
        moved = a.join(b, self.keys, "full_outer").filter(~F.col("_was").eqNullSafe(F.col("_is")))
        return [r[0] for r in self._bucketed(moved).select(BUCKET).distinct().collect()]  # a row a bucket

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The table's rows of ``keys``, from the partitions that hold them."""
        _, parts, _ = self._places(keys)
        return self.data.read(parts).join(keys.select(*self.keys), self.keys, "left_semi").drop(PART)

    def merge(self, source: DataFrame, latest: list[Column] | None = None, deletes: DataFrame | None = None, stored: bool = False, before: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, DataFrame]:
        """Upserts ``source`` (one row per key) and removes the keys of
        ``deletes``. With ``latest`` a key keeps the first of the table's and the
        batch's row under that order, else the batch wins. Returns the rows of
        all these keys before and after (tables of their own). ``stored``: the
        source is a table and need not be written to be read several times.
        ``before`` gets the rows before, when nothing has changed yet.

        The touched partitions are matched with the batch's keys once; their
        other rows are copied, and only rows of the batch's keys are compared."""
        validate_merge_key(source, self.keys)
        self._finish_tidy()
        src = source.withColumn(PART, self.part)
        src = src if stored else written(src, "merge-batch")
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        sizes = src.groupBy(PART).agg(F.count_if(null).alias("nulls"), F.count(F.lit(1)).alias("rows")).collect()
        if any(r["nulls"] for r in sizes):
            raise ValueError(f"NULL in the key {self.keys}")
        keys, n = src.select(*self.keys), sum(r["rows"] for r in sizes)
        if deletes is not None:
            deletes = written(deletes.select(*self.keys).distinct(), "merge-deletes")
            keys = written(keys.union(deletes).distinct(), "merge-keys")
            n = keys.count()
        known, new = None, src
        if self.exists():
            known, parts, buckets = self._places(keys, n)
            parts = sorted({r[PART] for r in sizes} | set(parts))
            target = self.data.read(parts).select(*src.columns) if self.data.exists() else src.limit(0)
            marks = bounded(keys.distinct().withColumn("_batch", F.lit(True)), n)
            target = written(target.join(marks, self.keys, "left"), "merge-target")  # the output path is also an input
            old = target.filter("_batch").select(*src.columns)
            kept = target.filter("_batch is null").select(*src.columns)
            if latest is not None:
                new = dedupe_latest(old.unionByName(src), self.keys, latest)
        else:
            # also after a first merge that stopped before its index was written: all data is the batch's
            parts, buckets, old, kept = [r[PART] for r in sizes], [], src.limit(0), None
        if deletes is not None:
            new = new.join(bounded(deletes), self.keys, "left_anti")
        if new is not src:
            new = written(new, "merge-new")
        if before is not None:
            before(old.drop(PART))
        self.data.replace(parts, new if kept is None else kept.unionByName(new))
        places = self._bucketed(new.select(*self.keys, PART))
        if known is not None and not (buckets := self._moved(known, new)):
            return old.drop(PART), new.drop(PART)  # every key is where the index has it
        if buckets:
            places = places.filter(F.col(BUCKET).isin(buckets))
            places = self.index.read(buckets).join(bounded(keys, n), self.keys, "left_anti").unionByName(places)
            places = written(places, "merge-index")  # the output path is also an input
        self.index.replace(buckets, places)
        return old.drop(PART), new.drop(PART)

    def tidy(self, cluster_by: list[str] | None = None, file_bytes: int = 128 << 20, all_parts: bool = False) -> list[dict]:
        """Compacts partitions that have more than twice the files they need
        (or all) to files of about ``file_bytes``, ordered by key or along a
        Hilbert curve over ``cluster_by``. Rows and index stay as they are, the
        other partitions keep their files. Returns a row a partition with the
        files and bytes before.

        The new files are first written aside (``path/tidied``). If the
        replacing stops half way, the next merge or tidy does it again from
        there before anything else."""
        self._finish_tidy()
        if not self.data.exists():
            return []
        need = F.ceil(F.col("bytes") / file_bytes)
        found = self.data.files().withColumn("need", need)
        found = [r.asDict() for r in (found if all_parts else found.filter("files > 2 * need")).orderBy(PART).collect()]
        if not found:
            return []
        parts, n = [r[PART] for r in found], sum(r["need"] for r in found)
        rows = self.data.read(parts)
        if cluster_by:
            rows = hilbert_layout(rows, cluster_by, n, within=[PART])
        else:
            rows = rows.repartitionByRange(n, PART, *self.keys).sortWithinPartitions(PART, *self.keys)
        rows.write.partitionBy(PART).mode("overwrite").parquet(self._tidied)
        self._finish_tidy()
        return found

    def _finish_tidy(self) -> None:
        """Puts files written aside in place of their partitions, one by one,
        by renaming; what is done already is found out by its absence."""
        fs, aside = _hadoop(self.spark, self._tidied)
        if not fs.exists(aside):
            return
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        if fs.exists(hadoop.Path(aside, "_SUCCESS")):
            _, data = _hadoop(self.spark, self.data.path)
            for x in fs.listStatus(aside):  # a folder a partition
                if x.isDirectory():
                    to = hadoop.Path(data, x.getPath().getName())
                    fs.delete(to, True)
                    if not fs.rename(x.getPath(), to):
                        raise OSError(f"could not move {x.getPath()} to {to}")
        fs.delete(aside, True)
