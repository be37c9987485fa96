"""Dense positions inside a partition, without one task per partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logferry.operators.small import checked_broadcast, local_table

RANK_CHUNK = 65_536


def partition_sequence(log: DataFrame, chunk: int = RANK_CHUNK) -> DataFrame:
    """Add ``seq``: the 0-based position of each record in its partition by offset.

    Offsets are unique in a partition, so a chunk of ``chunk`` consecutive offsets never holds more
    rows than that and can be ranked by one task whatever the skew between partitions. A second,
    two-column read of the log counts rows per chunk; its running sum is each chunk's first
    position. The rows are shuffled once, by (partition, chunk), and the merge join reuses that
    partitioning and sort order. The hint keeps size estimates, which go by compressed file size,
    from broadcasting the log itself.
    """
    chunk_no = F.expr(f"`offset` div {int(chunk)}")
    before = (
        W.partitionBy("partition").orderBy("chunk_no").rowsBetween(W.unboundedPreceding, -1)
    )
    bases = (
        log.groupBy("partition", chunk_no.alias("chunk_no"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "partition",
            "chunk_no",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
        )
    )
    inside = W.partitionBy("partition", "chunk_no").orderBy("offset")
    ranked = log.withColumn("chunk_no", chunk_no).withColumn(
        "rank_in_chunk", F.row_number().over(inside)
    )
    return ranked.join(bases.hint("merge"), ["partition", "chunk_no"]).select(
        *log.columns, (F.col("base") + F.col("rank_in_chunk") - 1).alias("seq")
    )


def offset_stats(log: DataFrame) -> DataFrame:
    """(partition, low, high, records): reads two columns and combines before the shuffle."""
    return log.groupBy("partition").agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
        F.count(F.lit(1)).alias("records"),
    )


def is_dense(stats: Sequence[Row]) -> bool:
    """No partition has gaps between its first and last offset."""
    return all(r["high"] - r["low"] == r["records"] for r in stats)


def choose_chunk(stats: Sequence[Row], tasks: int) -> int:
    """Chunk size that gives every task a few chunks but keeps the table of chunks small."""
    span = sum(r["high"] - r["low"] for r in stats)
    return max(1_024, min(262_144, span // max(1, 4 * tasks)))


def renumber(
    log: DataFrame, stats: Sequence[Row], start: Mapping[int, int], to: str
) -> DataFrame:
    """Replace ``offset`` by ``to`` = start of the partition + position in ``log``.

    ``stats`` are the collected rows of ``offset_stats(log)``. A log without gaps needs no ranking:
    its positions are offsets minus the first offset, so nothing is shuffled.
    """
    rest = [c for c in log.columns if c not in ("partition", "offset")]
    dense = is_dense(stats)
    if dense:
        numbered, position = log, "offset"
        shifts = {r["partition"]: start.get(r["partition"], 0) - r["low"] for r in stats}
    else:
        tasks = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        numbered, position = partition_sequence(log, choose_chunk(stats, tasks)), "seq"
        shifts = {r["partition"]: start.get(r["partition"], 0) for r in stats}
    if not any(shifts.values()):
        return numbered.select("partition", F.col(position).alias(to), *rest)
    table = local_table(
        log.sparkSession,
        ({"partition": p, "shift": s} for p, s in shifts.items()),
        ["partition", "shift"],
    )
    # Spark knows the exact size of this table and chooses the join by it.
    return numbered.join(table, "partition").select(
        "partition", (F.col(position) + F.col("shift")).alias(to), *rest
    )


def assign_offsets(
    batch: DataFrame, destination: DataFrame, chunk: int = RANK_CHUNK
) -> DataFrame:
    """Destination offsets: the end of the destination partition + position in the batch.

    ``destination`` is a BOUNDS table with one row per partition of the destination topic.
    """
    ends = checked_broadcast(destination.select("partition", "high"))
    numbered = partition_sequence(batch, chunk)
    rest = [c for c in batch.columns if c not in ("partition", "offset")]
    return numbered.join(ends, "partition", "left").select(
        "partition", (F.coalesce("high", F.lit(0)) + F.col("seq")).alias("offset"), *rest
    )


def check_partitions(df: DataFrame) -> DataFrame:
    """Partition ids that break 0..n-1, first violation first; empty when all is well."""
    ids = df.select("partition").distinct()
    # One row per log partition is left here, so a window over all of them is small.
    ordered = ids.withColumn(
        "expected", (F.row_number().over(W.orderBy("partition")) - 1).cast("int")
    )
    return ordered.where(F.col("partition") != F.col("expected")).orderBy("expected").limit(1)
