"""Run registered queries in Spark and DuckDB and compare all rows."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(r[i] for i in order) for r in rows)


def compare(spark, connection, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    frame = query(spark, sf_dir)
    got_columns, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    kinds = {d[0]: str(d[1]) for d in result.description}
    odd = {n: (types[n], kinds[n]) for n in types if n in kinds and TYPES.get(types[n]) != kinds[n]}
    if odd:
        return f"types differ: {odd}"
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, lost = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}; spark only {extra}; sql only {lost}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, name, query, sql[name], sf_dir)
        except Exception as caught:
            problem = f"{type(caught).__name__}: {str(caught)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
