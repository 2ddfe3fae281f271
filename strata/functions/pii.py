"""PII hashing: SHA-256 hex of the raw value; NULL stays NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sha256_hex(c: Column, salt: str | None = None, normalise: bool = False) -> Column:
    if normalise:
        c = F.lower(F.trim(c))
    if salt:
        c = F.concat(F.lit(salt), c)
    return F.sha2(c, 256)


def hash_pii(
    df: DataFrame,
    columns: list[str],
    suffix: str = "_hash",
    salt: str | None = None,
    normalise: bool = False,
    drop: bool = True,
) -> DataFrame:
    """Add ``<col>_hash`` for every PII column and drop the clear values.

    ``salt`` and ``normalise`` are off by default so the hashes equal a plain
    SHA-256 of the stored value."""
    out = df.withColumns(
        {f"{c}{suffix}": sha256_hex(F.col(c), salt, normalise) for c in columns}
    )
    return out.drop(*columns) if drop else out
