"""Run queries on Spark and their SQL on DuckDB over the same tables and compare.

python tests/compare.py [sf_dir] [name ...]; also used by the test suite.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("airloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def check_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(spark_rows, check_rows, columns) -> str | None:
    """None when equal as bags of rows, else a short description."""
    if len(spark_rows) != len(check_rows):
        return f"rows {len(spark_rows)} != {len(check_rows)}"
    a, b = sorted(map(tuple, spark_rows), key=_key), sorted(map(tuple, check_rows), key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if not bad:
        return None
    near = all(
        p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=2e-6))
        for x, y in bad for p, q in zip(x, y)
    )
    x, y = bad[0]
    cells = [(c, p, q) for c, p, q in zip(columns, x, y) if p != q]
    return f"{'ROUNDING ' if near else ''}{len(bad)} of {len(a)} rows differ, first {cells[:4]}"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = check_engine(sf_dir)
    sqls, failed = oracle_sql(), 0
    names = [n for n in queries() if len(argv) < 3 or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv[2:])]
    for name in names:
        started = time.monotonic()
        try:
            df = queries()[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            spent = time.monotonic() - started
            if name not in sqls:
                print(f"rows  {name}: {len(rows)} rows {spent:.1f}s", flush=True)
                continue
            columns = df.columns
            result = con.execute(sqls[name])
            theirs = [d[0] for d in result.description]
            problem = f"columns {columns} != {theirs}" if columns != theirs else difference(rows, result.fetchall(), columns)
            if problem is None and not rows:
                problem = "EMPTY"
        except Exception as error:  # noqa: BLE001
            problem, spent, rows = "ERROR " + str(error).split("JVM stacktrace")[0][:900], time.monotonic() - started, []
        if problem:
            failed += 1
            print(f"FAIL  {name}: {problem}", flush=True)
        else:
            print(f"ok    {name}: {len(rows)} rows {spent:.1f}s", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
