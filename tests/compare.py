"""Runs registered queries against their SQL twins: python -m tests.compare [sf_dir] [names...]"""

from __future__ import annotations

import sys
import time
from glob import glob
from os.path import basename

import duckdb

from __spark_entry__ import oracle_sql, queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _bag(rows, names) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    bag = sorted((tuple(row[i] for i in order) for row in rows), key=repr)
    return [names[i] for i in order], bag


def spark_result(spark, name: str, sf_dir: str):
    df = queries()[name](spark, sf_dir)
    return _bag([tuple(r) for r in df.collect()], df.columns)


def sql_result(con, name: str):
    cursor = con.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    return _bag(cursor.fetchall(), names)


def main(sf_dir: str, *only: str) -> int:
    from farelane.session import local_session

    spark, con, bad = local_session(8), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in only or queries():
        start = time.time()
        try:
            names, rows = spark_result(spark, name, sf_dir)
            took = time.time() - start
            if name not in oracle_sql():
                print(f"{'rows':5} {name} {len(rows)} {took:.2f}s", flush=True)
                continue
            sql_names, sql_rows = sql_result(con, name)
        except Exception as problem:
            bad += 1
            print(f"FAIL  {name} {type(problem).__name__} {str(problem)[:1500]}", flush=True)
            continue
        if (names, rows) == (sql_names, sql_rows):
            print(f"{'ok':5} {name} {len(rows)} {took:.2f}s", flush=True)
        else:
            bad += 1
            print(f"DIFF  {name} {len(rows)} {len(sql_rows)} {names} {sql_names}")
            both = [(a, b) for a, b in zip(rows, sql_rows) if a != b]
            print(*both[0] if both else (), sep="\n", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*(sys.argv[1:] or ["/root/testdata/sf0.01"])))
