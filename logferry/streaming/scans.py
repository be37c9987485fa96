"""Unbounded reads of a topic log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.operators.scans import slice_log
from logferry.operators.small import local_rows
from logferry.sources.topic_log import TopicLog


def stream_from_end(log: TopicLog, bounds: DataFrame | None = None, most_bytes: int | None = None) -> DataFrame:
    """Records at or after the end captured at startup. Saved progress plays no part.

    ``most_bytes`` limits a micro-batch, see ``TopicLog.stream``.
    """
    ends = log.bounds() if bounds is None else bounds
    return _from(log, ends.select("partition", F.col("high").alias("low")), most_bytes)


def stream_from_progress(log: TopicLog, progress: DataFrame, most_bytes: int | None = None) -> DataFrame:
    """Records at or after the saved next offset; from the beginning where there is none.

    ``most_bytes`` limits a micro-batch, see ``TopicLog.stream``.
    """
    starts = progress.select("partition", F.coalesce("next_offset", F.lit(0)).alias("low"))
    return _from(log, starts, most_bytes)


def _from(log: TopicLog, starts: DataFrame, most_bytes: int | None) -> DataFrame:
    rows = local_rows(starts)
    # Commits that lie wholly before the starts are left out by directory.
    after = log.covered({r["partition"]: r["low"] for r in rows}) if rows else 0
    return slice_log(log.stream(after, most_bytes), starts.withColumn("high", F.lit(None).cast("long")))
