"""Compare every registered query with its SQL: ``python tests/check_oracles.py [sf_dir] [name ..]``."""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, str | None]:
    """Row count of the query and what is wrong with it, None when it equals its SQL."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got), None if got else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return len(got), f"columns {df.columns} / {columns}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows / {len(want)}"
    if not got:
        return 0, "no rows"
    for a, b in zip(got, want):
        if a != b and not all(
            x == y and math.copysign(1, x) == math.copysign(1, y) if isinstance(x, float) else x == y
            for x, y in zip(a, b)
        ):
            return len(got), f"{a} / {b}"
    return len(got), None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            n, wrong = differences(spark, con, name, sf_dir)
        except Exception as exc:
            n, wrong = -1, f"{type(exc).__name__}: {str(exc)[:6000]}"
        spark.catalog.clearCache()
        failed += wrong is not None
        print(f"{name:28s} {n:8d} rows {time.time() - start:6.2f}s  {'ok' if wrong is None else 'FAIL ' + wrong}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main())
