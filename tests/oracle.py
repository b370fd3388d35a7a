"""Run registered queries against DuckDB: python tests/oracle.py [sf] [name prefix ...]"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plain(value):
    """Comparable form of a value of either engine."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value:.6f}".replace("-0.000000", "0.000000")
    if hasattr(value, "is_integer") or type(value).__name__ == "Decimal":
        return plain(float(value)) if type(value).__name__ == "Decimal" else str(value)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, fn, sql, sf_dir):
    """None if the query and the SQL agree, else what differs."""
    df = fn(spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, first {str(bad[0][0])[:400]} instead of {str(bad[0][1])[:400]}" if bad else None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    import __spark_entry__ as entry

    sf = next((a for a in argv if a.replace(".", "").isdigit()), "0.001")
    prefixes = tuple(a for a in argv if not a.replace(".", "").isdigit()) or ("",)
    sf_dir, failed = f"/root/testdata/sf{sf}", 0
    spark, con = session(), duck(f"/root/testdata/sf{sf}")
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in sqls:
                verdict = compare(spark, con, fn, sqls[name], sf_dir)
            else:
                df = fn(spark, sf_dir)
                rows = df.collect()
                verdict = None if rows else "no rows"
                print(f"   {name}: {len(rows)} rows, no SQL; {str(rows[:1])[:150]}")
        except Exception:
            verdict = traceback.format_exc()[-1500:]
        failed += verdict is not None
        print(f"{'FAIL' if verdict else 'ok  '} {time.time() - start:6.2f}s {name} {verdict or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
