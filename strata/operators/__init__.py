"""DataFrame-level operators Spark does not ship as one call: deterministic
dedupe, keyed upsert on plain Parquet, SCD type 2, dense surrogate keys,
gap sessions that split hot users, size-checked lookup joins, one-pass data
quality rules, reject routing and Z-order layout."""
