"""Run registered queries against DuckDB: `python tests/compare.py [sf] [name ...]`."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return 0.0 if value == 0 else (None if math.isnan(value) else value)
    return value


def normal(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_result(df):
    return sorted(df.columns), normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    rel = con.sql(sql)
    return sorted(rel.columns), normal(rel.columns, rel.fetchall())


def main(sf: str = "0.01", *names: str) -> int:
    import __spark_entry__ as entry

    from harborflow.session import local_session

    spark = local_session("compare", "8")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, queries, oracle = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        begun = time.time()
        try:
            columns, rows = spark_result(queries[name](spark, sf_dir))
            taken = time.time() - begun
            if name not in oracle:
                print(f"{name:30s} no SQL, {len(rows)} rows, {taken:.2f}s", flush=True)
                continue
            expected_columns, expected = duck_result(con, oracle[name])
            same = columns == expected_columns and rows == expected
            print(f"{name:30s} {'ok ' if same else 'DIFFERENT'} {len(rows)} rows, {taken:.2f}s", flush=True)
            if not same:
                bad += 1
                print("   columns", columns, expected_columns, "rows", len(rows), len(expected))
                print("   only spark", sorted(set(rows) - set(expected), key=repr)[:3])
                print("   only duck ", sorted(set(expected) - set(rows), key=repr)[:3])
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"{name:30s} ERROR {str(error)[:1500]}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
