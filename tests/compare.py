"""Runs queries in Spark and their oracle in DuckDB and compares the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(row[name]) for name in names) for row in df.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    names = sorted(columns)
    places = [columns.index(name) for name in names]
    return names, Counter(tuple(plain(row[place]) for place in places) for row in result.fetchall())


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from retrolane.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    connection = duck(folder)
    sql = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            names, rows = spark_rows(query(spark, folder))
            took = time.time() - start
            expected_names, expected = oracle_rows(connection, sql[name])
        except Exception as error:  # noqa: BLE001
            print("ERROR", name, str(error)[:1500], flush=True)
            continue
        good = names == expected_names and rows == expected
        print("ok   " if good else "DIFF ", name, sum(rows.values()), f"{took:.1f}s", flush=True)
        if not good:
            print("   columns", names if names != expected_names else "same", expected_names)
            print("   spark only", list((rows - expected).items())[:3], sum((rows - expected).values()))
            print("   oracle only", list((expected - rows).items())[:3], sum((expected - rows).values()))
