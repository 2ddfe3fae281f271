"""Keyed upsert (MERGE: update-all on match, insert-all otherwise) as a pure
DataFrame operator, so it works on plain Parquet snapshots.

``result = target LEFT ANTI JOIN source.keys  UNION ALL  source``

Semantics kept from a SQL MERGE with ``t.k = s.k``: a NULL key never matches
(so NULL-key source rows are inserted every time) unless ``null_safe``;
matched rows take every source value, NULLs included. Several source rows for
one key would make MERGE ambiguous; here they are resolved by
``dedupe_latest`` (``on_duplicate="dedupe"``) or rejected (``"error"``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest, duplicate_keys


def validate_merge_key(df: DataFrame, merge_key: list[str]) -> None:
    if not merge_key:
        raise ValueError("a merge needs one key column or more")
    missing = [c for c in merge_key if c not in df.columns]
    if missing:
        raise ValueError(f"no such key columns: {missing}")


def prepare_source(
    source: DataFrame,
    merge_key: list[str],
    order: list[Column] | None = None,
    on_duplicate: str = "dedupe",
) -> DataFrame:
    validate_merge_key(source, merge_key)
    if on_duplicate == "dedupe":
        return dedupe_latest(source, merge_key, order)
    if on_duplicate == "error":
        if duplicate_keys(source, merge_key).limit(1).count():
            raise ValueError(f"source has several rows for one merge_key {merge_key}")
        return source
    if on_duplicate == "keep":
        return source
    raise ValueError(f"on_duplicate must be dedupe, error or keep, not {on_duplicate!r}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    merge_key: list[str],
    null_safe: bool = False,
    order: list[Column] | None = None,
    on_duplicate: str = "dedupe",
    allow_missing_columns: bool = False,
    latest: list[Column] | None = None,
) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``merge_key``.

    The anti-join only carries the key columns of the source, which Spark
    broadcasts if it knows them to be small. With ``latest`` a matched key
    keeps the first of the target's and the source's row under that order
    (a late delivery does not overwrite a newer row); without it the source
    wins. The source is read several times: pass a table, not a long plan."""
    validate_merge_key(target, merge_key)
    src = prepare_source(source, merge_key, order, on_duplicate)
    keys = src.select(*merge_key)
    if latest is not None:
        if null_safe:
            raise ValueError("latest is for keys without NULLs")
        some = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in merge_key])
        keys = keys.filter(some).distinct()
        rivals = target.join(keys, merge_key, "left_semi").unionByName(src.filter(some), allowMissingColumns=allow_missing_columns)
        src = dedupe_latest(rivals, merge_key, latest).unionByName(src.filter(~some), allowMissingColumns=allow_missing_columns)
    if null_safe:
        cond = reduce(
            lambda a, b: a & b, [target[k].eqNullSafe(keys[k]) for k in merge_key]
        )
        kept = target.join(keys, cond, "left_anti")
    else:
        # a NULL key never matches: such rows stay without a shuffle
        some = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in merge_key])
        kept = target.filter(some).join(keys, merge_key, "left_anti").select(*target.columns)
        kept = kept.unionByName(target.filter(~some))
    return kept.unionByName(src, allowMissingColumns=allow_missing_columns)
