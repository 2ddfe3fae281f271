"""Session-level helpers: shared scratch folders and the session defaults the
library expects. The caller owns the SparkSession; nothing here hard-codes a
master, memory size or shuffle-partition count."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Lineage cuts (``DataFrame.checkpoint``) and scratch tables go here so that
    any executor can read them after a loss. A session without the setting is
    an error: a machine-local temp folder is not visible to other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        # Set on the context by the caller (``SparkContext.setCheckpointDir``);
        # the conf key itself cannot change once the session runs.
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can read"
        )
    d = d.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """For tests and local runs: keep the session's ``spark.checkpoint.dir``
    when it has one, else use ``fallback`` (a folder the caller made)."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(fallback)
    return shared_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared dir for one run's tables."""
    path = f"{shared_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
    for paths in _scratch.get():
        paths.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: a lineage
    cut that keeps column pruning, filter pushdown and a known size. Such
    tables are read a few times at most, so they are packed more tightly than
    the session's default."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """The scratch folders made inside (``written``, ``scratch_path``) are
    removed at the end, also after a failure: what is read later has to be
    stored elsewhere."""
    paths: list[str] = []
    token = _scratch.set((*_scratch.get(), paths))
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go as each query ends, not when the
    driver happens to collect its garbage; the caller's setting is put back."""
    before = spark.conf.get(_SHUFFLES, None)
    spark.conf.set(_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES)
        else:
            spark.conf.set(_SHUFFLES, before)
