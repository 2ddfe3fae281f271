"""Compare every registered query with its DuckDB oracle: row count, column
names and an order-insensitive hash of the values (the shape of the
driver's correctness gate). Usage:

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return h, lines


def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    results = {}
    for n in names or list(qs):
        t0 = time.time()
        try:
            df = qs[n](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[n] = ("SPARK_ERROR", str(e)[:400])
            print(f"SPARK_ERROR {n}: {str(e)[:400]}", flush=True)
            continue
        ts = time.time() - t0
        if n not in sqls:
            results[n] = ("ROWS_ONLY", len(srows))
            print(f"ROWS_ONLY {n}: {len(srows)} rows ({ts:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[n])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[n] = ("SQL_ERROR", str(e)[:400])
            print(f"SQL_ERROR {n}: {str(e)[:600]}", flush=True)
            continue
        if sorted(scols) != sorted(dcols):
            results[n] = ("COLS", (scols, dcols))
            print(f"COLS {n}: spark={scols} sql={dcols}", flush=True)
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = hs == hd and len(srows) == len(drows)
        results[n] = ("MATCH" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{'MATCH' if ok else 'MISMATCH'} {n}: spark={len(srows)} sql={len(drows)} ({ts:.1f}s)", flush=True)
        if not ok and verbose:
            a, b = set(ls), set(ld)
            print("   cols:", sorted(scols))
            for x in sorted(a - b)[:4]:
                print("   spark-only:", x[:300])
            for x in sorted(b - a)[:4]:
                print("   sql-only  :", x[:300])
    return results


def session():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[8]")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    if not s.conf.get("spark.checkpoint.dir", None):
        from strata.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="strata-ck-"))
    s.sparkContext.setLogLevel("ERROR")
    return s


if __name__ == "__main__":
    args = sys.argv[1:]
    s = session()
    if args and args[0] == "--no-broadcast":  # plan every join as a shuffle join
        args = args[1:]
        s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sf = args[0] if args else "/root/testdata/sf0.01"
    res = compare(s, sf, args[1:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("MATCH", "ROWS_ONLY")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; problems: {sorted(bad)}")
