"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tools/check.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import importlib.util
import pathlib
import sys
import time
import traceback
from collections import Counter

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from workload.inputs import TABLES  # noqa: E402


def registry():
    spec = importlib.util.spec_from_file_location("entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def plain(value):
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(v := plain(r[i])).__name__, repr(v)) for i in order) for r in rows)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, fn, sql, folder):
    df = fn(spark, folder)
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, sum(ours.values()), df.columns
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = bag(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}", sum(ours.values()), df.columns
    if ours != theirs:
        return (
            f"spark {sum(ours.values())} rows, oracle {sum(theirs.values())}\n"
            f"    only spark:  {str(list((ours - theirs).elements())[:2])[:500]}\n    only oracle: {str(list((theirs - ours).elements())[:2])[:500]}"
        ), sum(ours.values()), df.columns
    return "", sum(ours.values()), df.columns


def main():
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = tuple(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    module, con = registry(), duck(folder)
    queries, oracle = module.queries(), module.oracle_sql()
    bad = 0
    print(f"folder {folder}", flush=True)
    for name, fn in queries.items():
        if wanted and not name.startswith(wanted):
            continue
        began = time.time()
        try:
            problem, rows, _ = compare(spark, con, fn, oracle.get(name), folder)
        except Exception:
            problem, rows = traceback.format_exc(limit=4)[-1800:], 0
        took = time.time() - began
        mark = "rows-only" if problem is None else "ok" if not problem else "FAIL"
        bad += mark == "FAIL"
        print(f"{mark:9} {name:32} {rows:8} rows {took:6.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
