"""Offset bounds of a log and reads restricted to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.operators.small import local_rows, local_table, partition_ids
from logferry.schemas import LOG_COLUMNS

# Up to this many partitions the bounds become a plain predicate, which Parquet uses per partition
# to skip row groups. Beyond it they are joined, and only their envelope is a predicate.
PREDICATE_PARTITIONS = 64


class BeyondEnd(ValueError):
    """Saved progress lies after the end that was captured at startup."""


def beyond_end(partition: int, saved: int, end: int) -> BeyondEnd:
    return BeyondEnd(
        f"saved offset {saved} is beyond captured end offset {end} for partition {partition}"
    )


def watermarks(
    log: DataFrame, partitions: int | DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """(partition, low, high) for every declared partition; high is exclusive.

    ``known`` carries bounds recorded by the writer. They win where they reach further than the
    data, because the tail of a partition may have been removed.
    """
    seen = log.groupBy("partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )
    out = partition_ids(log.sparkSession, partitions).join(seen, "partition", "left")
    if known is None:
        low, high = F.coalesce("low", F.lit(0)), F.coalesce("high", F.lit(0))
    else:
        recorded = known.select("partition", F.col("high").alias("known_high"))
        out = out.join(recorded, "partition", "left")
        high = F.coalesce(F.greatest("high", "known_high"), F.lit(0))
        low = F.coalesce("low", "known_high", F.lit(0))
    return out.select(
        "partition", low.cast("long").alias("low"), high.cast("long").alias("high")
    )


def slice_log(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows with ``low <= offset < high`` of their partition; a null high leaves the end open.

    Works on batch and streaming logs. Partitions that ``ranges`` does not name are dropped: the
    set of partitions is fixed when the bounds are captured.
    """
    rows = local_rows(ranges)
    inside = (F.col("offset") >= F.col("low")) & (
        F.col("high").isNull() | (F.col("offset") < F.col("high"))
    )
    if rows is None:
        return log.join(ranges, "partition").where(inside).select(*log.columns)
    live = [r for r in rows if r["high"] is None or r["low"] < r["high"]]
    if not live:
        return log.where(F.lit(False))
    if len(live) <= PREDICATE_PARTITIONS:
        return log.where(reduce(lambda a, b: a | b, [_one_range(r) for r in live]))
    envelope = F.col("offset") >= min(r["low"] for r in live)
    if all(r["high"] is not None for r in live):
        envelope = envelope & (F.col("offset") < max(r["high"] for r in live))
    table = local_table(
        log.sparkSession, (r.asDict() for r in live), ["partition", "low", "high"]
    )
    joined = log.where(envelope).join(F.broadcast(table), "partition")
    return joined.where(inside).select(*log.columns)


def _one_range(row):
    hit = (F.col("partition") == row["partition"]) & (F.col("offset") >= row["low"])
    return hit if row["high"] is None else hit & (F.col("offset") < row["high"])


def bounded_scan(log: DataFrame, bounds: DataFrame) -> DataFrame:
    """Records inside the captured bounds; empty partitions cost nothing."""
    return slice_log(log, bounds.select("partition", "low", "high")).select(*LOG_COLUMNS)


def resume_ranges(progress: DataFrame, bounds: DataFrame) -> DataFrame:
    """Where each partition continues: at its saved offset, else at its beginning."""
    saved = progress.select("partition", "next_offset")
    return bounds.join(saved, "partition", "left").select(
        "partition", F.coalesce("next_offset", "low").alias("low"), "high"
    )


def resume_scan(log: DataFrame, progress: DataFrame, bounds: DataFrame) -> DataFrame:
    """Records after the saved progress and before the captured end."""
    ranges = resume_ranges(progress, bounds)
    rows = local_rows(ranges)
    # Bounds never end before they begin, so such a range comes from saved progress.
    if rows is None:
        bad = ranges.where(F.col("low") > F.col("high")).take(1)
    else:
        bad = [r for r in rows if r["low"] > r["high"]]
        ranges = local_table(
            log.sparkSession, (r.asDict() for r in rows), ["partition", "low", "high"]
        )
    if bad:
        raise beyond_end(bad[0]["partition"], bad[0]["low"], bad[0]["high"])
    return slice_log(log, ranges).select(*LOG_COLUMNS)
