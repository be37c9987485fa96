"""Run registered queries and their SQL side by side: ``python -m checks.compare [folder] [names]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.jobs import QUERIES
from checks.oracles import ORACLES

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cpus: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("logferry-checks")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in ALL_TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, db, folder: str, name: str) -> tuple[str | None, int]:
    """(first difference or None, number of rows) of one query."""
    frame = QUERIES[name](spark, folder)
    got = sorted_rows(frame.columns, frame.collect())
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = sorted_rows(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}", len(got)
    if len(got) != len(want):
        extra = [r for r in got if r not in set(want)][:1], [r for r in want if r not in set(got)][:1]
        return f"{len(got)} rows / {len(want)}: {extra}", len(got)
    for mine, other in zip(got, want):
        if mine != other:
            return f"{mine} / {other}", len(got)
    return None, len(got)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, db = session(), database(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found, rows = differences(spark, db, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {rows} rows {time.time()-start:.1f}s", found or "", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()


if __name__ == "__main__":
    main()
