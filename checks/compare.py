"""Run queries against their SQL and report differences: ``python -m checks.compare [sf] [names..]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.catalog import QUERIES
from checks.oracle import ORACLE
from tickloom.session import job_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows(names: list[str], raw: list) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in raw]
    return sorted(plain, key=repr)


def differences(spark, db, name: str, sf_dir: str) -> tuple[int, int, int | str]:
    """Row counts and the number of rows that differ (or a schema message)."""
    frame = QUERIES[name](spark, sf_dir)
    mine = rows(frame.columns, frame.collect())
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    theirs = rows(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return len(mine), len(theirs), f"columns {sorted(frame.columns)} / {sorted(columns)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if len(mine) != len(theirs):
        only = sorted(set(mine) - set(theirs), key=repr)[:2], sorted(set(theirs) - set(mine), key=repr)[:2]
        return len(mine), len(theirs), f"rows only here / there: {only}"
    if bad:
        return len(mine), len(theirs), f"{len(bad)} differ, first {bad[0]}"
    return len(mine), len(theirs), 0


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/{sf}"
    spark = job_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                        spark__driver__memory="12g", spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name not in ORACLE:
                print(f"{name:24s} rows {QUERIES[name](spark, sf_dir).count()} (no SQL)  {time.time() - start:.1f}s", flush=True)
                continue
            mine, theirs, diff = differences(spark, db, name, sf_dir)
        except Exception as error:  # keep going: the report lists every failure
            mine, theirs, diff = -1, -1, f"{type(error).__name__}: {str(error)[:600]}"
        ok = diff == 0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {mine}/{theirs}  {time.time() - start:.1f}s {'' if ok else diff}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
