"""Run registered queries next to their SQL and compare row by row.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree in column names, value types and values."""
    ours_names = df.columns
    ours = _rows(ours_names, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(ours_names):
        return f"columns {sorted(ours_names)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} != {b}"
    return None if ours else "no rows"


def main() -> int:
    import __spark_entry__ as entry

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    checks = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in checks:
                problem = difference(df, con, checks[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        state = "ok" if problem is None else "FAIL"
        kind = "sql" if name in checks else "rows"
        print(f"{state:4} {kind:4} {time.time() - start:6.2f}s {name}", flush=True)
        if problem:
            failed += 1
            print("     ", problem, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
