"""Run registered queries beside their SQL and compare whole results.

Usage: python tests/oracle_check.py [sf] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> str:
    started = time.time()
    mine = query(spark, sf_dir).toPandas()
    took = time.time() - started
    if sql is None:
        return f"rows  {name}: {len(mine)} rows, {took:.1f}s"
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"FAIL  {name}: columns {sorted(mine.columns)} against {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"FAIL  {name}: {len(mine)} rows against {len(theirs)}"
    a, b = _sorted(mine), _sorted(theirs)
    for column in a.columns:
        same = (a[column] == b[column]) | (a[column].isna() & b[column].isna())
        if not same.all():
            at = same.idxmin()
            return f"FAIL  {name}: {column}, {(~same).sum()} rows differ\n{a.loc[at]}\n{b.loc[at]}"
    types = [f"{c}:{a[c].dtype}/{b[c].dtype}" for c in a.columns if str(a[c].dtype) != str(b[c].dtype)]
    return f"ok    {name}: {len(mine)} rows, {took:.1f}s {' '.join(types)}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from ratewell.session import local_session

    sf_dir = f"{TESTDATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    for name, query in queries().items():
        if not wanted or name in wanted:
            print(compare(spark, con, name, query, sql.get(name), sf_dir), flush=True)


if __name__ == "__main__":
    main()
