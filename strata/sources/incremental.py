"""Incremental reads by arrival, never by event time.

Event times may be missing, equal or late; what has not been loaded yet is
decided by how it arrived: by landed file, or by a column that grows with
every delivery. The increment is then merged under a total order, so reading
a delivery again changes nothing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame, column: str | Column):
    """The latest arrival that ``target`` holds (one scalar)."""
    c = F.col(column) if isinstance(column, str) else column
    return target.agg(F.max(c)).first()[0]


def rows_after(source: DataFrame, column: str | Column, mark) -> DataFrame:
    """Rows that arrived after ``mark``; rows without an arrival are always
    read. A plain comparison, so Parquet scans get it pushed down."""
    c = F.col(column) if isinstance(column, str) else column
    if mark is None:
        return source
    return source.filter(c.isNull() | (c > F.lit(mark)))


def _plain(path: str) -> str:
    return re.sub(r"^([A-Za-z0-9]+):/+", r"\1:/", path)


def new_files(landing: DataFrame, loaded: DataFrame | None, column: str = "_source_file") -> list[str]:
    """Files of ``landing`` (a file listing, nothing is read) that ``loaded``
    does not name."""
    done = set()
    if loaded is not None:
        done = {_plain(r[0]) for r in loaded.select(column).distinct().collect() if r[0]}  # a row a file
    return sorted(f for f in landing.inputFiles() if _plain(f) not in done)
