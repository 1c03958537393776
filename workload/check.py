"""Compare every query with its SQL on one data folder: ``python -m workload.check FOLDER [NAME ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What is different between a query's rows and its SQL's rows, None when they are equal."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    expected = Counter(cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    if actual == expected:
        return None
    return f"rows {actual.total()} and {expected.total()}; only query {list((actual - expected).items())[:2]}; only SQL {list((expected - actual).items())[:2]}"


def main() -> int:
    from .queries import ORACLES, QUERIES

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            wrong = difference(QUERIES[name](spark, folder), con, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            wrong = f"{type(error).__name__}: {str(error)[:400]}"
        failed += wrong is not None
        print(f"{name}: {'ok' if wrong is None else wrong} ({time.perf_counter() - start:.1f}s)", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
