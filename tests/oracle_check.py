"""Compare every query with its SQL oracle: ``python tests/oracle_check.py [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
}


def _cell(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def compare(spark: SparkSession, db: duckdb.DuckDBPyConnection, name: str, folder: str) -> str:
    """Empty when query and oracle agree, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, folder)
    columns, found = _bag(df.columns, df.collect())
    if name not in oracle_sql():
        return ""
    result = db.execute(oracle_sql()[name])
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    if types != dict(df.dtypes):
        return f"types {dict(df.dtypes)} instead of {types}"
    names, expected = _bag([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return f"columns {columns} instead of {names}"
    if found != expected:
        extra, missing = found - expected, expected - found
        return (
            f"{found.total()} rows for {expected.total()}; extra {extra.total()} {list(extra)[:2]};"
            f" missing {missing.total()} {list(missing)[:2]}"
        )
    return ""


def main() -> None:
    from __spark_entry__ import queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TIMEZONE", "UTC"))
        .config("spark.sql.ansi.enabled", os.environ.get("CHECK_ANSI", "true"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = oracle(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
