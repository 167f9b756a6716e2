"""Run a registered query and its DuckDB oracle side by side and compare.

Comparison: same column names (order-insensitive), same row count, and the
same multiset of rows after normalising values (datetimes, decimals and
floats).  Usable from pytest and from the command line:

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, key: str, query, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {
        "key": key,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
        "columns_match": sorted(s_names) == sorted(d_names),
    }
    if not out["columns_match"]:
        out["spark_columns"] = s_names
        out["oracle_columns"] = d_names
        out["match"] = False
        return out
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    out["match"] = a == b
    if not out["match"]:
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    return out


def local_spark():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .appName("tillsight-oracle")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = local_spark()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in wanted or sorted(qs):
        try:
            r = compare(spark, con, key, qs[key], sqls[key], sf_dir)
        except Exception as exc:  # report and continue
            r = {"key": key, "match": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += not r["match"]
        print(r, flush=True)
    print(f"mismatches: {bad}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
