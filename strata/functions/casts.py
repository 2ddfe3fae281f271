"""Safe typed casts for raw string feeds.

Spark 4 runs with ANSI mode on, where a plain ``cast`` of a dirty string
raises. Every raw-feed cast is therefore a ``try_cast``: unparsable values
become NULL and the cleaning step filters or reports them.

Differences from a non-ANSI cast, kept on purpose: a fractional string such as
``'5.7'`` is NULL for an integer column (a unit count with a fraction is a
reject, not a truncation).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    return _c(c).try_cast("int")


def to_decimal(c: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """String -> decimal(p,s), HALF_UP rounding, overflow -> NULL."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def to_ts(c: str | Column) -> Column:
    """String -> TIMESTAMP_NTZ. Raw feeds carry wall-clock times without a zone,
    so the result does not depend on the session time zone. A bare
    ``yyyy-MM-dd`` parses as midnight."""
    return _c(c).try_cast("timestamp_ntz")


def norm_upper(c: str | Column) -> Column:
    """``upper(trim(x))``: strips spaces only (a leading tab stays)."""
    return F.upper(F.trim(_c(c)))
