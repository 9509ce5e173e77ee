"""Run the catalog beside its SQL and compare rows: python tests/compare.py [folder] [names…]"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def same_rows(df, con, sql):
    """None when columns and rows agree, else what differs."""
    theirs = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(theirs.columns):
        return f"columns {names} and {sorted(theirs.columns)}"
    order = [theirs.columns.index(n) for n in names]
    want = sorted((tuple(_plain(r[i]) for i in order) for r in theirs.fetchall()), key=repr)
    got = sorted((tuple(map(_plain, r)) for r in df.select(*(f"`{n}`" for n in names)).collect()), key=repr)
    if want == got and [list(map(type, r)) for r in want[:50]] == [list(map(type, r)) for r in got[:50]]:
        return None
    off = next((p for p in zip(got, want) if p[0] != p[1]), None)
    return f"{len(got)} and {len(want)} rows, first difference {str(off)[:600]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = same_rows(query(spark, folder), con, sql[name])
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print("different:", bad)
