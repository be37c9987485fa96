"""How far a copy has come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.operators.small import partition_ids


def fold_progress(appended: DataFrame) -> DataFrame:
    """(partition, next_offset) after the given source records were written."""
    return appended.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))


def finish_progress(progress: DataFrame, bounds: DataFrame) -> DataFrame:
    """Progress once the captured end was reached: raised to the end, never lowered.

    The last offsets before the end may hold no records, so the records alone do not tell.
    """
    saved = progress.select("partition", "next_offset")
    ends = bounds.select("partition", "high")
    return saved.join(ends, "partition", "full").select(
        "partition", F.greatest("next_offset", "high").alias("next_offset")
    )


def copy_status(progress: DataFrame, errors: DataFrame, partitions: DataFrame) -> DataFrame:
    """One line per (topic, partition): next offset, ``error`` / ``ok`` / ``starting``, last error.

    ``partitions`` (topic, partition) lists what is copied; ``errors`` has (topic, partition,
    last_error) for those whose last attempt failed.
    """
    key = ["topic", "partition"]
    lines = (
        partitions.select(*key)
        .join(progress.select(*key, "next_offset"), key, "left")
        .join(errors.select(*key, "last_error"), key, "left")
    )
    status = (
        F.when(F.col("last_error").isNotNull(), "error")
        .when(F.col("next_offset").isNotNull(), "ok")
        .otherwise("starting")
    )
    return lines.select(*key, "next_offset", status.alias("status"), "last_error").orderBy(*key)


def initial_progress(identity: dict, partitions: int, spark) -> DataFrame:
    """Trusted progress of a clone that has copied nothing: one row per partition, no offset."""
    rows = partition_ids(spark, partitions)
    return rows.select(
        *[F.lit(v).alias(k) for k, v in identity.items()],
        "partition",
        F.lit(None).cast("long").alias("next_offset"),
    )
