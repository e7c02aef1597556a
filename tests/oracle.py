"""Compares registered queries with their DuckDB SQL: python tests/oracle.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "null" if value != value else f"{value:.9g}"
    return str(value)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir: str, name: str, query, sql: str) -> tuple[list[str], int, float]:
    start = time.time()
    df = query(spark, sf_dir)
    ours = df.collect()
    spark_seconds = time.time() - start
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"], len(ours), spark_seconds
    a, b = rows_of(df.columns, ours), rows_of(columns, theirs)
    found = [f"rows {len(a)} != {len(b)}"] if len(a) != len(b) else []
    count_a, count_b = Counter(a), Counter(b)
    only_a, only_b = list((count_a - count_b).elements()), list((count_b - count_a).elements())
    if only_a or only_b:
        found.append(f"{len(only_a)} only in Spark, {len(only_b)} only in DuckDB")
        found += [f"  spark  {x}"[:600] for x in only_a[:2]] + [f"  duckdb {x}"[:600] for x in only_b[:2]]
    return found, len(ours), spark_seconds


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found, n, spent = differences(spark, con, sf_dir, name, query, oracles[name])
        except Exception as e:  # a failing query must not hide the others
            found, n, spent = [f"{type(e).__name__}: {str(e)[:1500]}"], -1, 0.0
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name:28} {n:8} rows {spent:6.1f}s Spark {time.time() - start - spent:6.1f}s DuckDB", flush=True)
        for line in found:
            print("    " + line, flush=True)
    print(f"{bad} bad")
