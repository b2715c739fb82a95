"""Run registered queries against their DuckDB oracles.

Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name, doubles rounded to 9 places).

    python tests/oracle_check.py [SF_DIR] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 9) + 0.0))
    if isinstance(v, bool):
        return (1, repr(int(v)))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else repr(v))
    if isinstance(v, (list, tuple)):
        return (2, repr([_norm(x) for x in v]))
    return (3, str(v))


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keys = sorted(repr([_norm(r[i]) for i in order]) for r in rows)
    h = hashlib.sha256()
    for k in keys:
        h.update(k.encode())
        h.update(b"\n")
    return len(rows), h.hexdigest()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"name": name, "rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    con = con or duck_connection(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    ds = digest(s_cols, s_rows)
    dd = digest(d_cols, d_rows)
    out["status"] = "match" if ds == dd else "MISMATCH"
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = entry.queries()
    sqls = entry.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
