"""Compare queries with their SQL counterparts the way a checker would: sorted columns, row multisets."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def oracle(sf_dir: str, sql: str) -> tuple[list[str], list]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def difference(df: DataFrame, sf_dir: str, sql: str) -> str | None:
    collected = df.collect()
    columns, rows = oracle(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    got, expected = rows_of(df.columns, collected), rows_of(columns, rows)
    if got == expected:
        return None
    only_got, only_expected = got - expected, expected - got
    sample = [str(r)[:600] for r in list(only_got)[:2] + ["|"] + list(only_expected)[:2]]
    return f"{sum(only_got.values())}/{sum(only_expected.values())} rows differ: {sample}"


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as contract
    from dictforge.session import local_session

    spark: SparkSession = local_session(int(os.environ.get("COMPARE_CPUS", "8")), 8)
    failed = 0
    for name, fn in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        planned = 0.0
        try:
            df = fn(spark, sf_dir)
            planned = time.time() - start
            sql = contract.oracle_sql().get(name)
            problem = difference(df, sf_dir, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{name:28s} eager {planned:6.2f}s all {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
