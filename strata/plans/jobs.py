"""Job drivers: the daily full refresh and the hourly incremental load.

A job is a plain function over one SparkSession: bronze and gold are written
as a snapshot version, silver is merged partition by partition, row counts come from ``DataFrame.observe`` on the
write itself (no extra counting jobs), and the data-quality suites gate the
next layer (``QualityGateError`` stops the run)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import quality
from strata.plans import gold, silver
from strata.sources import files
from strata.plans.clicks import SessionTable
from strata.plans.customer_state import CustomerState, merge_sales
from strata.session import scratch_removed, shuffles_removed, written
from strata.sources.partitioned import PART, KeyedTable
from strata.sources.snapshots import SnapshotTable

#: Silver tables that are merged: key, and the time whose month is the partition.
KEYED = {"pos_transactions": ("transaction_id", "sale_date"), "inventory_movements": ("movement_id", "movement_date"), "customers": ("customer_id", "signup_date")}

#: What rows of a merged table are looked up by, besides its months: files are clustered by it.
CLUSTERED = {"pos_transactions": ["sale_date", "product_id", "store_id"], "inventory_movements": ["movement_date", "product_id"], "customers": ["customer_id"]}

#: The tables of a daily run without clicks, by the gate that lets them be written: none, bronze, silver.
TABLES = {
    "bronze": ["pos_transactions", "inventory_movements", "customers"],
    "silver": ["pos_transactions", "inventory_movements", "customers"],
    "gold": ["dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales", "agg_customer_360", "fact_inventory_snapshot"],
}


def observed_clean_transactions(bronze: DataFrame, path: str, as_of) -> dict[str, int]:
    """Write silver POS to a new snapshot at ``path`` and return the row
    counts seen on the way (bronze, deduplicated, silver) from the same job."""
    o_in, o_dedup, o_out = Observation("bronze"), Observation("deduped"), Observation("silver")
    b = bronze.observe(o_in, F.count(F.lit(1)).alias("rows"))
    d = silver.pos_deduped(b).observe(o_dedup, F.count(F.lit(1)).alias("rows"))
    s = (
        silver.pos_typed(d)
        .filter(F.col("_reject_reason").isNull())
        .withColumn("_processed_at", F.lit(as_of).cast("timestamp_ntz"))
        .select(*silver.SILVER_POS_COLUMNS)
        .observe(o_out, F.count(F.lit(1)).alias("rows"))
    )
    SnapshotTable(bronze.sparkSession, path).publish(s, operation="WRITE")
    return {
        "bronze": o_in.get["rows"],
        "deduped": o_dedup.get["rows"],
        "silver": o_out.get["rows"],
    }


@dataclass
class Lakehouse:
    """Table locations of one lakehouse root."""

    root: str
    clicks_by: str = "yyyy-MM-dd"  # partition of the click events
    tables: dict = field(default_factory=dict)

    def table(self, spark: SparkSession, layer: str, name: str) -> SnapshotTable | KeyedTable | SessionTable:
        """Merged silver tables are partitioned, the others are published whole."""
        key = f"{layer}/{name}"
        if key not in self.tables:
            path = f"{self.root.rstrip('/')}/{key}"
            if layer == "silver" and name in KEYED:
                own, time = KEYED[name]
                month = F.coalesce(F.date_format(time, "yyyy-MM"), F.lit("undated"))
                self.tables[key] = KeyedTable(spark, path, [own], month)
            elif key == "silver/clickstream":
                self.tables[key] = SessionTable(spark, path, by=self.clicks_by)
            else:
                self.tables[key] = SnapshotTable(spark, path)
        return self.tables[key]


def _leaving_tables_only(job: Callable) -> Callable:
    """A run's disk is its tables and what one step needs: scratch tables and
    shuffle files do not gather over the steps."""

    @wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch_removed(spark), shuffles_removed(spark):
            return job(spark, *args, **kwargs)

    return run


@_leaving_tables_only
def daily_refresh(
    spark: SparkSession,
    landing: dict[str, str],
    root: str,
    as_of,
    products: DataFrame | None = None,
    stores: DataFrame | None = None,
    gate: bool = True,
    clicks_by: str = "yyyy-MM-dd",
) -> dict:
    """bronze x4 -> DQ -> silver x4 -> DQ -> dims, 360 -> fact -> DQ. Over an
    existing lake silver is merged and the dimensions keep history and keys.

    ``landing`` maps feed name (pos, inventory, customers, clicks) to a folder
    of raw files. Returns per-step row counts and the DQ results."""
    lh = Lakehouse(root, clicks_by)
    report: dict = {"counts": {}, "dq": {}}

    def write(layer, name, df):
        t = lh.table(spark, layer, name)
        if f"{layer}_{name}" in schemas.SCHEMAS:
            # nothing enters a layer but in its layout; what bronze has no place for stays in a column
            if layer == "bronze":
                df = schemas.conform_drift(df, f"{layer}_{name}")
            elif not isinstance(t, SessionTable):
                df = schemas.conform(df, f"{layer}_{name}")
        if isinstance(t, SnapshotTable):
            obs = Observation(f"{layer}_{name}")
            t.publish(df.observe(obs, F.count(F.lit(1)).alias("rows")), committed_at=as_of)
            report["counts"][f"{layer}.{name}"] = obs.get["rows"]
        else:
            with scratch_removed(spark):
                t.load(df, as_of) if isinstance(t, SessionTable) else t.merge(df)
            # a merged table is counted as it stands (from its Parquet footers)
            report["counts"][f"{layer}.{name}"] = t.read().count()
        return t.read()

    def before(name) -> DataFrame | None:
        t = lh.table(spark, "gold", name)
        return t.read() if t.exists() else None

    def check(suite, df):
        # stored before the gate, so a stopped run leaves its reasons
        res = quality.store_results(quality.run_suite(df, suite), f"{lh.root.rstrip('/')}/dq/results", as_of)
        rows = quality.run_checkpoint(res) if gate else res.collect()
        report["dq"][suite] = [r.asDict() for r in rows]

    # bronze: the landed rows of this run with ingestion metadata
    def land(feed, name, read=files.read_csv_feed, **options):
        """Good lines go to bronze, lines that do not parse to quarantine."""
        raw, lines = read(spark, landing[feed], files.raw_string_schema(f"bronze_{name}"), **options), Observation(f"{name}_lines")
        good, bad = files.split_corrupt(raw, lines)
        out = write("bronze", name, files.stamp_ingestion(good, as_of))
        # the files are parsed again only for lines that are known to be there
        bad = bad if lines.get["rows"] else spark.createDataFrame([], bad.schema)
        write("quarantine", f"{name}_lines", files.stamp_ingestion(bad, as_of))
        return out

    bronze_pos = land("pos", "pos_transactions", corrupt=True)
    bronze_inv = land("inventory", "inventory_movements", corrupt=True)
    bronze_cust = land("customers", "customers", corrupt=True)
    clicks = land("clicks", "clickstream", files.read_json_drift) if "clicks" in landing else None
    check("bronze_pos_transactions", bronze_pos)

    # silver
    landed = {"pos_transactions": bronze_pos, "inventory_movements": bronze_inv, "customers": bronze_cust, "clickstream": clicks}
    for feed, bronze in landed.items():
        if bronze is not None:
            write("quarantine", feed, silver.quarantine(bronze, feed, as_of))
    s_pos = write("silver", "pos_transactions", silver.clean_transactions(bronze_pos, as_of))
    s_inv = write("silver", "inventory_movements", silver.clean_inventory(bronze_inv, as_of))
    s_cust = write("silver", "customers", silver.clean_customers(bronze_cust, as_of))
    if clicks is not None:
        write("silver", "clickstream", silver.parse_clicks(clicks))
    check("silver_pos_transactions", s_pos)

    # gold
    prods = products if products is not None else s_pos.select("product_id").distinct().select(
        "product_id", *[F.lit(None).cast(t).alias(c) for c, t in
                        (("product_name", "string"), ("category", "string"),
                         ("sub_category", "string"), ("unit_cost", "decimal(12,2)"))])
    d_cust = write("gold", "dim_customer", gold.build_dim_customer(s_cust, as_of, before("dim_customer")))
    d_prod = write("gold", "dim_product", gold.build_dim_product(s_pos, prods, as_of, before("dim_product")))
    st = stores if stores is not None else s_pos.select(F.col("store_id")).distinct().select(
        "store_id", *[F.lit(None).cast("string").alias(c) for c in gold.STORE_ATTRS])
    d_store = write("gold", "dim_store", gold.build_dim_store(st, as_of, before("dim_store")))
    write("gold", "dim_date", gold.build_dim_date(s_pos))
    fact = write("gold", "fact_sales", gold.build_fact_sales(s_pos, d_cust, d_prod, d_store, as_of))
    write("gold", "agg_customer_360", gold.build_customer_360(s_pos, as_of))
    write("gold", "fact_inventory_snapshot", gold.build_inventory_snapshot(s_inv, d_prod, as_of))
    check("gold_fact_sales", fact)
    return report


def _available_now(stream: DataFrame, load, checkpoint: str) -> None:
    """Runs ``load(batch, batch id)`` for what landed since the last run. The
    stream's checkpoint holds the files of each batch; a batch that did not
    end is repeated with the same files and the same id."""
    q = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _log(df: DataFrame, path: str, batch: str) -> None:
    """The rows of a batch in a folder of their own, which a repeated run
    replaces (column ``batch`` when the log is read)."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={batch}")


def _landed(batch: DataFrame, report: dict) -> tuple[DataFrame, DataFrame]:
    """(good rows, lines that do not parse) of a batch; its files are counted."""
    good, bad = files.split_corrupt(batch)
    report["files"] += good.select("_source_file").union(bad.select("_source_file")).distinct().count()
    return good, bad


def customer_state(spark: SparkSession, root: str) -> CustomerState:
    return CustomerState(spark, f"{root.rstrip('/')}/gold/customer_state")


def replay_sales(spark: SparkSession, root: str, repaired: DataFrame, as_of, name: str) -> DataFrame:
    """Loads repaired rows of the POS quarantine (bronze columns) as a later
    delivery; returns what of them is still refused, with its reasons."""
    target = Lakehouse(root).table(spark, "silver", "pos_transactions")
    columns = [f.name for f in files.raw_string_schema("bronze_pos_transactions")]
    rows = written(files.stamp_ingestion(repaired.select(*columns).withColumn("_source_file", F.lit(f"replay-{name}")), as_of), "replay")
    cleaned = written(silver.clean_transactions(rows, as_of), "replay-cleaned")
    merge_sales(target, customer_state(spark, root), cleaned, as_of, f"replay-{name}", latest=silver.silver_pos_order())
    return silver.quarantine(rows, "pos_transactions", as_of)


def remove_sales(spark: SparkSession, root: str, ids: DataFrame, as_of, name: str) -> None:
    """Takes the sales with these ``transaction_id`` out of silver and of the
    customer 360 table; ``name`` is what a repeated removal is known by."""
    target = Lakehouse(root).table(spark, "silver", "pos_transactions")
    merge_sales(target, customer_state(spark, root), target.read().limit(0), as_of, f"removed-{name}", deletes=ids)


def hourly_incremental(spark: SparkSession, landing_pos: str, root: str, as_of, files_per_batch: int = 1000, with_360: bool = False) -> dict:
    """POS landing -> silver -> bronze for the files not loaded yet.

    Every row of a new file is loaded, whatever its sale date; the merge keeps
    the winner of ``silver_pos_order`` between table and batch and rewrites the
    months that the batch touches. ``with_360`` keeps the customer 360 table up
    to date as well (``customer_state``). A run that stops is repeated by the next
    one (``_available_now``), with the same silver, bronze and quarantine rows.
    Lines that do not parse and rejected rows go to quarantine."""
    lh = Lakehouse(root)
    base = lh.root.rstrip("/")
    target, state = lh.table(spark, "silver", "pos_transactions"), customer_state(spark, base)
    report = {"files": 0, "rows": 0, "batches": 0}

    def load(raw: DataFrame, batch_id: int) -> None:
        good, bad = _landed(raw, report)
        batch, obs = files.stamp_ingestion(good, as_of), Observation("hourly")
        cleaned = schemas.conform(silver.clean_transactions(batch, as_of), "silver_pos_transactions").observe(obs, F.count(F.lit(1)).alias("rows"))
        if with_360:
            cleaned = written(cleaned, "hourly-cleaned")  # read several times
            merge_sales(target, state, cleaned, as_of, f"hourly-{batch_id}", latest=silver.silver_pos_order())
            state.compact(f"hourly-{batch_id}")
        else:
            target.merge(cleaned, latest=silver.silver_pos_order())
        _log(batch, f"{base}/bronze/pos_transactions_log", str(batch_id))
        _log(silver.pos_quarantine(batch, as_of), f"{base}/quarantine/pos_transactions_log", str(batch_id))
        _log(files.stamp_ingestion(bad, as_of), f"{base}/quarantine/pos_transactions_lines_log", str(batch_id))
        report["rows"] += obs.get["rows"]
        report["batches"] += 1

    schema = files.raw_string_schema("bronze_pos_transactions")
    _available_now(files.stream_feed(spark, landing_pos, schema, "csv", files_per_batch=files_per_batch), load, f"{base}/checkpoints/hourly_pos")
    return report


def hourly_clicks(spark: SparkSession, landing: str, root: str, as_of, files_per_batch: int = 1000, clicks_by: str = "yyyy-MM-dd") -> dict:
    """Clickstream landing -> bronze -> silver sessions for the files not
    loaded yet; only the sessions that the new events reach or change are cut
    anew (``clicks.SessionTable``). A run that stops is repeated by the next
    one, with the same rows everywhere."""
    lh = Lakehouse(root, clicks_by)
    base = lh.root.rstrip("/")
    target = lh.table(spark, "silver", "clickstream")
    report = {"files": 0, "rows": 0, "batches": 0}

    def load(lines: DataFrame, batch_id: int) -> None:
        good, bad = _landed(lines, report)
        raw = files.stamp_ingestion(good, as_of)
        out = target.load(silver.parse_clicks(raw), as_of, f"hourly-{batch_id}")
        _log(raw, f"{base}/bronze/clickstream_log", str(batch_id))
        _log(files.stamp_ingestion(bad, as_of), f"{base}/quarantine/clickstream_lines_log", str(batch_id))
        report["rows"] += out.count()
        report["batches"] += 1

    schema = files.raw_string_schema("bronze_clickstream")
    _available_now(files.stream_json_drift(spark, landing, schema, files_per_batch), load, f"{base}/checkpoints/hourly_clicks")
    return report


def maintain_lake(spark: SparkSession, root: str, now, file_bytes: int = 128 << 20, retention_hours: int = 168) -> list[dict]:
    """Upkeep between runs, safe to repeat: months of merged silver tables that
    gathered many small files are compacted and clustered, versions of published
    tables replaced more than ``retention_hours`` ago go. Returns a row for each
    partition rewritten and each table that lost versions."""
    lh = Lakehouse(root)
    report = []
    for name, columns in CLUSTERED.items():
        t = lh.table(spark, "silver", name)
        if t.exists():
            report += [{"table": f"silver/{name}", "part": r[PART], "files": r["files"]} for r in t.tidy(columns, file_bytes)]
    for layer in ("bronze", "gold"):
        for name in TABLES[layer]:
            t = lh.table(spark, layer, name)
            gone = t.vacuum(retention_hours, now) if t.exists() else []
            if gone:
                report.append({"table": f"{layer}/{name}", "versions": gone})
    return report
