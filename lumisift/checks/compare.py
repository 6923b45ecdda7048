"""Run registered queries in Spark and their oracle SQL in DuckDB and compare the results.

    python -m lumisift.checks.compare SF_DIR [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from lumisift.checks.catalog import ORACLES, QUERIES
from lumisift.session import local_session


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    frame = frame.map(lambda v: repr(v.tolist()) if hasattr(v, "tolist") and getattr(v, "ndim", 0) else v)
    return frame.sort_values(list(frame.columns), kind="stable", ignore_index=True)


def differences(mine: pd.DataFrame, other: pd.DataFrame) -> list[str]:
    out = []
    if sorted(mine.columns) != sorted(other.columns):
        return [f"columns {sorted(mine.columns)} vs {sorted(other.columns)}"]
    if len(mine) != len(other):
        return [f"rows {len(mine)} vs {len(other)}"]
    a, b = canonical(mine), canonical(other)
    for c in a.columns:
        if str(a[c].dtype) != str(b[c].dtype):
            out.append(f"{c}: type {a[c].dtype} vs {b[c].dtype}")
        x, y = a[c].astype(object), b[c].astype(object)
        bad = ~((x == y) | (x.isna() & y.isna()))
        if bad.any():
            i = bad.idxmax()
            out.append(f"{c}: {int(bad.sum())} values differ, first {x[i]!r} vs {y[i]!r}")
    return out


def check(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[str, int, float, float]:
    start = time.time()
    mine = QUERIES[name](spark, sf_dir).toPandas()
    spent = time.time() - start
    if name not in ORACLES:
        return "rows only", len(mine), spent, 0.0
    start = time.time()
    other = con.execute(ORACLES[name]).df()
    problems = differences(mine, other)
    return "ok" if not problems else "; ".join(problems), len(mine), spent, time.time() - start


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:]
    wanted = [n for n in QUERIES if not names or any(n.startswith(p) for p in names)]
    spark, con, failed = local_session("compare"), oracle_connection(sf_dir), 0
    for name in wanted:
        try:
            verdict, rows, spent, oracle = check(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            verdict, rows, spent, oracle = f"{type(exc).__name__}: {str(exc)[:600]}", -1, 0.0, 0.0
        failed += verdict not in ("ok", "rows only")
        print(f"{name:32s} {rows:8d} rows {spent:6.2f}s oracle {oracle:6.2f}s  {verdict}", flush=True)
    print(f"{len(wanted) - failed}/{len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
