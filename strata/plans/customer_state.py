"""Customer 360 kept up to date from mergeable states, with retractions.

The state of a customer is, by payment method and purchase time, the number of
sales and the sum and count of their amounts. Sales that a merge replaces or
removes are subtracted, sales that it brings are added, so a correction costs
its own rows, not the customer's history; earliest and latest purchase and the
preferred method come out of the counts that are left.

States are written by batch, each in a folder of its own that a repeated batch
replaces, and add up over the folders: a batch counts once, however often it
is repeated. ``compact`` folds older folders into one. Everything is
partitioned by a hash of the customer; a batch reads the partitions of its
customers alone and rewrites their rows of the 360 table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType

from strata.plans import gold
from strata.session import written
from strata.sources.partitioned import KeyedTable, PartitionedFolder, _hadoop, path_exists

BUCKET = "customer_bucket"
#: What a state counts by, and what it adds up.
BY = ["customer_id", "payment_method", "sale_date"]
SUMS = {"sales": LongType(), "amounts": LongType(), "amount": DecimalType(38, 2)}
_KEYS = {"customer_id": StringType(), "payment_method": StringType(), "sale_date": TimestampNTZType()}
_STATE = StructType([StructField(n, t) for n, t in {**_KEYS, **SUMS, BUCKET: StringType()}.items()])


def change(old: DataFrame, new: DataFrame) -> DataFrame:
    """The states that silver sales ``new`` add and ``old`` take away, in one
    grouping; what is left of nothing goes."""
    signed = [df.filter(F.col("customer_id").isNotNull()).select(*BY, "total_amount", F.lit(sign).cast("long").alias("_sign")) for df, sign in ((old, -1), (new, 1))]
    amount = F.when(F.col("_sign") < 0, -F.col("total_amount")).otherwise(F.col("total_amount"))
    g = signed[0].unionByName(signed[1]).groupBy(*BY).agg(
        F.sum("_sign").alias("sales"), F.coalesce(F.sum(F.when(F.col("total_amount").isNotNull(), F.col("_sign"))), F.lit(0)).alias("amounts"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("amount"),
    )
    return _some(g.select(*BY, *[F.col(c).cast(t).alias(c) for c, t in SUMS.items()]))


def _some(states: DataFrame) -> DataFrame:
    return states.filter("sales <> 0 or amounts <> 0 or amount <> 0")


def added(parts: DataFrame) -> DataFrame:
    """States added up; what is left of nothing goes."""
    return _some(parts.groupBy(*BY).agg(*[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()]))


def customer_360(state: DataFrame, as_of) -> DataFrame:
    """As ``gold.build_customer_360`` over the sales that the states stand for."""
    per_method = state.groupBy(F.col("customer_id").alias("customer_bk"), "payment_method").agg(
        F.sum("sales").alias("_orders"), F.sum(F.when(F.col("amounts") > 0, F.col("amount"))).alias("_sum"), F.sum("amounts").alias("_n"),
        F.min("sale_date").alias("_first"), F.max("sale_date").alias("_last"), F.sum("sales").alias("_k"),
    )
    return gold.customer_360_of(per_method, as_of)


class CustomerState:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = PartitionedFolder(spark, f"{self.path}/customer_360", BUCKET)

    def _bucketed(self, df: DataFrame, customer: str = "customer_id") -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(customer), F.lit(self.buckets)).cast("string"))

    def _folders(self) -> list[str]:
        """The folders that count: of the last complete generation."""
        fs, p = _hadoop(self.spark, f"{self.path}/states")
        if not fs.exists(p):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(p)]
        generation = max(int(n.split("-")[0]) for n in names if self._complete(n) and n.endswith("-base")) if any(n.endswith("-base") and self._complete(n) for n in names) else 0
        return [f"{self.path}/states/{n}" for n in sorted(names) if int(n.split("-")[0]) == generation and self._complete(n)]

    def _complete(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.path}/states/{name}/_SUCCESS")

    def _generation(self) -> int:
        folders = self._folders()
        return int(folders[0].rsplit("/", 1)[1].split("-")[0]) if folders else 0

    def _parts(self, buckets: list[str] | None = None) -> DataFrame:
        """The states of all folders, not added up."""
        out = None
        for f in self._folders():
            part = PartitionedFolder(self.spark, f, BUCKET, _STATE).read(buckets).select(*BY, *SUMS)
            out = part if out is None else out.unionByName(part)
        return out

    def read(self, buckets: list[str] | None = None) -> DataFrame:
        """The states as they add up now."""
        return added(self._parts(buckets))

    def apply(self, old: DataFrame, new: DataFrame, batch: str) -> None:
        """Sales ``old`` become ``new``; ``batch`` names the change."""
        path = f"{self.path}/states/{self._generation():06d}-batch-{batch}"
        self._bucketed(change(old, new)).hint("rebalance", BUCKET).write.option("compression", "zstd").mode("overwrite").partitionBy(BUCKET).parquet(path)

    def refresh(self, customers: DataFrame, as_of) -> None:
        """Builds the 360 rows of ``customers`` (column customer_id) anew."""
        who = written(self._bucketed(customers.select("customer_id").filter("customer_id is not null").distinct()), "360-customers")
        buckets = sorted(r[0] for r in who.select(BUCKET).distinct().collect())  # a row a bucket
        if not buckets:
            return
        # joined first: rows dealt by customer need not be dealt again to be added up
        state = added(self._parts(buckets).join(who.select("customer_id"), "customer_id", "left_semi"))
        rows = self._bucketed(customer_360(state, as_of), "customer_bk")
        if self.table.exists():
            kept = self.table.read(buckets).join(who.select(F.col("customer_id").alias("customer_bk")), "customer_bk", "left_anti")
            rows = kept.select(*rows.columns).unionByName(rows)
        self.table.replace(buckets, written(rows, "360-rows"))

    def compact(self, last: str) -> None:
        """Folds all folders but that of the batch ``last``, which may be
        repeated, into the base of a new generation."""
        folders = self._folders()
        mine = [f for f in folders if f.endswith(f"-batch-{last}")]
        fold = [f for f in folders if f not in mine]
        if len(fold) < 2:
            return
        g = self._generation() + 1
        out = None
        for f in fold:
            part = PartitionedFolder(self.spark, f, BUCKET, _STATE).read().select(*BY, *SUMS)
            out = part if out is None else out.unionByName(part)
        # the last batch moves first: the new generation counts from its base on
        for f in mine:
            PartitionedFolder(self.spark, f, BUCKET, _STATE).read().write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/states/{g:06d}-batch-{last}")
        self._bucketed(added(out)).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/states/{g:06d}-base")
        for f in folders:
            fs, p = _hadoop(self.spark, f)
            fs.delete(p, True)


def merge_sales(target: KeyedTable, state: CustomerState, sales: DataFrame, as_of, batch: str, latest=None, deletes: DataFrame | None = None) -> None:
    """Merges sales (a table) into silver and brings the 360 table up to date.
    The rows that the batch replaces are stored under its name before anything
    changes, so a batch that is repeated retracts the same rows."""
    spark, staged = target.spark, f"{state.path}/replaced/{batch}"

    def keep(old: DataFrame) -> None:
        if not path_exists(spark, f"{staged}/_SUCCESS"):
            old.write.mode("overwrite").option("compression", "zstd").parquet(staged)

    _, new = target.merge(sales, latest=latest, deletes=deletes, stored=True, before=keep)
    old = spark.read.parquet(staged)
    state.apply(old, new, batch)
    state.refresh(old.select("customer_id").union(new.select("customer_id")), as_of)
