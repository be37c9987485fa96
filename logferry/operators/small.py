"""Tables with one row per log partition, kept on the driver when they are provably small."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# 100,000 rows of three numbers are under 3 MB, well below Spark's own broadcast threshold.
LOCAL_ROWS = 100_000

_ARROW = {"partition": pa.int32(), "low": pa.int64(), "high": pa.int64(), "shift": pa.int64()}


def local_rows(df: DataFrame, limit: int = LOCAL_ROWS) -> list[Row] | None:
    """The rows of ``df``, or None when there are more than ``limit``."""
    rows = df.take(limit + 1)
    return rows if len(rows) <= limit else None


def local_table(spark: SparkSession, rows: Iterable[dict], columns: list[str]) -> DataFrame:
    """A local relation: Spark knows its exact size and need not start a Python worker for it."""
    schema = pa.schema([(name, _ARROW[name]) for name in columns])
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=schema))


def checked_broadcast(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if counting its rows shows that it is small, else as it is."""
    rows = local_rows(df)
    if rows is None:
        return df
    return F.broadcast(local_table(df.sparkSession, (r.asDict() for r in rows), df.columns))


def partition_ids(spark: SparkSession, partitions: int | DataFrame) -> DataFrame:
    """Declared partition ids, from a count or from a table that has a ``partition`` column."""
    if isinstance(partitions, int):
        return spark.range(partitions).select(F.col("id").cast("int").alias("partition"))
    return partitions.select("partition").distinct()
