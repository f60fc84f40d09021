"""Run queries and their SQL twins side by side and report differences.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb
from pyspark.sql import SparkSession

from catalog.registry import TABLES


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return float(v)
    return v


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql) -> str:
    """Empty when both sides agree in names, rows and values."""
    columns, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} != {sorted(names)}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    for a, b in zip(rows_of(columns, rows), rows_of(names, expected)):
        if a != b:
            return f"first difference ({sorted(names)}):\n    spark  {str(a)[:600]}\n    oracle {str(b)[:600]}"
    return ""


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    sql = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(run(spark, sf_dir), con, sql[name])
            else:
                problem, n = "", run(spark, sf_dir).count()
                name += f" (rows only: {n})"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok ':4}{time.time() - start:6.1f}s {name}" + (f"\n    {problem}" if problem else ""), flush=True)
    print(f"{bad} bad")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
