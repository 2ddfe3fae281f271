"""Column-level helpers (all JVM-side built-ins, no UDFs)."""

from strata.functions.casts import (
    norm_upper,
    to_decimal,
    to_int,
    to_ts,
)
from strata.functions.calendar import date_sk, calendar_columns
from strata.functions.pii import hash_pii
from strata.functions.tiers import value_tier

__all__ = [
    "norm_upper",
    "to_decimal",
    "to_int",
    "to_ts",
    "date_sk",
    "calendar_columns",
    "hash_pii",
    "value_tier",
]
