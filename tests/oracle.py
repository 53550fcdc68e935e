"""Compare registered queries with their SQL in DuckDB: `python tests/oracle.py [sf] [name ...]`."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

DATA = "/root/testdata"
SETTINGS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.checkpoint.dir": "/tmp/tidewatch-tests",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v + 0.0)
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in at) for row in rows), key=repr)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'' when equal, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    res = con.execute(sql)
    names, types = [d[0] for d in res.description], [str(d[1]) for d in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    spark_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    odd = {n: (spark_types[n], t) for n, t in zip(names, types) if spark_types[n] != t}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    if not got:
        return "no rows"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    wanted = args[1:] or list(entry.queries())
    spark = build_session(master="local[8]", **SETTINGS)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, failed = f"{DATA}/sf{sf}", 0
    con = connect(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # a report line per query, whatever goes wrong
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        mark = "ok  " if not problem else "FAIL"
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{mark} {kind:4} {time.time() - start:6.1f}s {name} {problem[:900]}", flush=True)
        failed += bool(problem)
    print(f"{len(wanted) - failed} of {len(wanted)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
