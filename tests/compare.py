"""Runs registered queries beside their SQL on DuckDB and compares columns and rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of_spark(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(_key(r[n]) for n in names) for r in frame.collect())


def rows_of_duckdb(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(tuple(_key(row[i]) for i in at) for row in result.fetchall())


def difference(frame, con, sql) -> str | None:
    names, ours = rows_of_spark(frame)
    their_names, theirs = rows_of_duckdb(con, sql)
    if names != their_names:
        return f"columns {names} and {their_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{dict(zip(names, a))}\n   and {dict(zip(names, b))}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from meterflow.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sql, con = oracle_sql(), connect(folder)
    wanted = sys.argv[1:] or list(queries())
    for name in wanted:
        begun = time.time()
        try:
            found = difference(queries()[name](spark, folder), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - begun:.2f}s {found or ''}", flush=True)
    spark.stop()
