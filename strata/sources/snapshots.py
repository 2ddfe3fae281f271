"""Versioned Parquet snapshots: the table format this library writes.

Layout of a table at ``path``::

    path/v=00000001/part-*.parquet      data of version 1
    path/_commits/00000001.json         commit record, written last

A version is visible only once its commit record exists, so a reader never
sees a half-written version, and a crashed writer leaves an uncommitted
folder that the next write of that version replaces. One writer per table is
assumed. All file-system calls go through the Hadoop FileSystem of the path,
so the same code runs on HDFS, object stores and local disks.

Operations: publish (overwrite), upsert (keyed MERGE), read latest / by
version / by timestamp (time travel), compact, Z-order, vacuum.
"""

from __future__ import annotations

import datetime as _dt
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession

from strata.operators.merge import merge_upsert, validate_merge_key
from strata.session import written
from strata.operators.zorder import zorder_layout

MIN_RETENTION_HOURS = 168


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._IOUtils = jvm.org.apache.commons.io.IOUtils
        self._fs = self._Path(self.path).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration()
        )

    # -- file-system helpers -------------------------------------------------
    def _p(self, rel: str):
        return self._Path(f"{self.path}/{rel}")

    def _vdir(self, v: int) -> str:
        return f"{self.path}/v={v:08d}"

    def _commit_rel(self, v: int) -> str:
        return f"_commits/{v:08d}.json"

    def commits(self) -> list[dict]:
        d = self._p("_commits")
        if not self._fs.exists(d):
            return []
        out = []
        for st in self._fs.listStatus(d):
            name = st.getPath().getName()
            if not name.endswith(".json"):
                continue
            stream = self._fs.open(st.getPath())
            try:
                text = self._IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out.append(json.loads(text))
        return sorted(out, key=lambda c: c["version"])

    def exists(self) -> bool:
        return bool(self.commits())

    def latest_version(self) -> int | None:
        cs = self.commits()
        return cs[-1]["version"] if cs else None

    # -- reads -----------------------------------------------------------------
    def read(self, version: int | None = None, timestamp=None) -> DataFrame:
        """Latest committed version, or time travel by ``version`` XOR
        ``timestamp`` (the last version committed at or before it)."""
        if version is not None and timestamp is not None:
            raise ValueError("version and timestamp exclude each other")
        cs = self.commits()
        if not cs:
            raise FileNotFoundError(f"no committed snapshot at {self.path}")
        if version is not None:
            if version not in {c["version"] for c in cs}:
                raise ValueError(f"version {version} not committed at {self.path}")
            v = version
        elif timestamp is not None:
            ts = _as_dt(timestamp)
            older = [c for c in cs if _as_dt(c["committed_at"]) <= ts]
            if not older:
                raise ValueError(f"no version of {self.path} committed at or before {ts}")
            v = older[-1]["version"]
        else:
            v = cs[-1]["version"]
        return self.spark.read.parquet(self._vdir(v))

    # -- writes ----------------------------------------------------------------
    def publish(self, df: DataFrame, committed_at=None, operation: str = "WRITE",
                info: dict | None = None) -> int:
        """Write ``df`` as the next version and commit it; ``info`` adds
        fields to the commit record (written atomically with it)."""
        prev = self.latest_version()
        v = 1 if prev is None else prev + 1
        vdir = self._Path(self._vdir(v))
        if self._fs.exists(vdir):  # left over by a writer that never committed
            self._fs.delete(vdir, True)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(self._vdir(v))
        ts = _as_dt(committed_at) if committed_at is not None else _dt.datetime.now()
        rec = {**(info or {}), "version": v, "committed_at": ts.isoformat(), "operation": operation}
        tmp = self._p(f"_commits/.{v:08d}.json.tmp")
        out = self._fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(rec).encode("utf-8")))
        finally:
            out.close()
        if not self._fs.rename(tmp, self._p(self._commit_rel(v))):
            raise RuntimeError(f"could not commit version {v} of {self.path}")
        return v

    def upsert(
        self,
        source: DataFrame,
        merge_key: list[str],
        committed_at=None,
        null_safe: bool = False,
        order: list[Column] | None = None,
        on_duplicate: str = "dedupe",
        allow_missing_columns: bool = False,
        info: dict | None = None,
        latest: list[Column] | None = None,
    ) -> int:
        """MERGE ``source`` into the latest version (create when absent).

        The new version is a rewrite of the table: O(table) per upsert."""
        validate_merge_key(source, merge_key)
        if not self.exists():
            from strata.operators.merge import prepare_source

            return self.publish(
                prepare_source(source, merge_key, order, on_duplicate), committed_at, "CREATE", info
            )
        from strata.operators.merge import prepare_source

        # written once: the merge reads it several times
        batch = written(prepare_source(source, merge_key, order, on_duplicate), "merge-batch")
        merged = merge_upsert(
            self.read(), batch, merge_key, null_safe=null_safe, on_duplicate="keep",
            allow_missing_columns=allow_missing_columns, latest=latest,
        )
        return self.publish(merged, committed_at, "MERGE", info)

    def size_bytes(self, version: int | None = None) -> int:
        v = version if version is not None else self.latest_version()
        return int(self._fs.getContentSummary(self._Path(self._vdir(v))).getLength())

    def _file_count(self, version: int) -> int:
        """Data files of a version (a metadata listing, no job)."""
        st = self._fs.listStatus(self._Path(self._vdir(version)))
        return sum(1 for f in st if f.getPath().getName().endswith(".parquet"))

    def _files_for(self, target_file_bytes: int) -> int:
        return max(1, math.ceil(self.size_bytes() / target_file_bytes))

    def compact(self, target_file_bytes: int = 128 << 20, committed_at=None) -> int:
        """Rewrite the latest version into files of about ``target_file_bytes``
        (``coalesce`` when shrinking the file count: no shuffle)."""
        df = self.read()
        n = self._files_for(target_file_bytes)
        cur = self._file_count(self.latest_version())
        out = df.coalesce(n) if n < cur else df.repartition(n)
        return self.publish(out, committed_at, "OPTIMIZE")

    def zorder(self, cols: list[str], target_file_bytes: int = 128 << 20,
               num_files: int | None = None, committed_at=None) -> int:
        df = self.read()
        n = num_files or self._files_for(target_file_bytes)
        return self.publish(zorder_layout(df, cols, n), committed_at, "ZORDER")

    def vacuum(self, retention_hours: int = MIN_RETENTION_HOURS, now=None) -> list[int]:
        """Delete versions superseded more than ``retention_hours`` ago; the
        latest version is never deleted. Returns the deleted versions."""
        if retention_hours < MIN_RETENTION_HOURS:
            raise ValueError(f"versions are kept for {MIN_RETENTION_HOURS} hours or more")
        cs = self.commits()
        if not cs:
            return []
        now = _as_dt(now) if now is not None else _dt.datetime.now()
        cutoff = now - _dt.timedelta(hours=retention_hours)
        deleted = []
        for older, newer in zip(cs, cs[1:]):
            # a version is needed until the next one replaced it
            if _as_dt(newer["committed_at"]) <= cutoff:
                # commit file first: a crash in between leaves an invisible
                # folder (replaced or ignored), never a visible empty version
                self._fs.delete(self._p(self._commit_rel(older["version"])), False)
                self._fs.delete(self._Path(self._vdir(older["version"])), True)
                deleted.append(older["version"])
        return deleted


def _as_dt(v) -> _dt.datetime:
    if isinstance(v, _dt.datetime):
        return v
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day)
    return _dt.datetime.fromisoformat(str(v))


def upsert_to_table(df: DataFrame, path: str, merge_key: list[str], spark: SparkSession | None = None,
                    **kw) -> int:
    """Create the snapshot table at ``path`` or MERGE ``df`` into it."""
    validate_merge_key(df, merge_key)
    spark = spark or df.sparkSession
    return SnapshotTable(spark, path).upsert(df, merge_key, **kw)
