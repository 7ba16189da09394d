"""Order-insensitive comparison of a Spark result with a DuckDB query."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.9g}"))
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return repr(float(f"{value:.9g}")) if abs(value) < 10**9 else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"create view {name} as select * from read_parquet('{os.path.join(sf_dir, name)}.parquet')"
        )
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} vs {sorted(expected_names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    expected = rows_of(expected_names, cursor.fetchall())
    if len(got) != len(expected):
        return f"{len(got)} rows vs {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"first difference: {str(a)[:600]} vs {str(b)[:600]}"
    return None


def main(argv: list[str]) -> int:
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = argv[0]
    wanted = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = compare(df, con, oracle[name]) if name in oracle else f"rows {df.count()} (no oracle)"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem) and "no oracle" not in problem
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
