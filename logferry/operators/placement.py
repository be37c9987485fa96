"""Where records are written: tasks of about equal bytes, each one run of positions of one log partition.

Offsets are divided into fine ranges. One pass over the log counts records and bytes of each; running sums
of these say how many records lie before a range and which task it belongs to. Each record then finds its
task by an equi-join with the table of ranges, which is small by construction, and is sent there directly:
one shuffle, no sampling, and no key of the data decides how much a task gets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bytes of records that one task writes, about: it ends with the fine range that reaches them.
TASK_BYTES = 128 << 20
#: Fine ranges of a log at most; their table is broadcast, 24 bytes a range.
FINE_RANGES = 500_000
#: Fine ranges that a task is made of, about, while there are few enough.
RANGES_PER_TASK = 64
#: Tasks of one shuffle at most; beyond that they get more bytes each.
MOST_TASKS = 100_000


def record_bytes() -> Column:
    """Bytes of a record's key, value and headers, and what its numbers take."""
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(0))
    headers = F.aggregate("headers", F.lit(0), lambda n, h: n + size(h["key"].cast("binary")) + size(h["value"]))
    return (size(F.col("key")) + size(F.col("value")) + F.coalesce(headers, F.lit(0)) + F.lit(24)).cast("long")


def fine_ranges(log: DataFrame, width: int, position: str = "offset") -> DataFrame:
    """(partition, fine, records, bytes) of every range of ``width`` positions that holds records."""
    fine = F.expr(f"`{position}` div {int(width)}").alias("fine")
    return log.groupBy("partition", fine).agg(F.count(F.lit(1)).alias("records"), F.sum(record_bytes()).alias("bytes"))


@dataclass(frozen=True)
class Layout:
    """Which task writes which positions."""

    width: int
    tasks: int
    #: Bytes of the largest task, and records of all.
    most_bytes: int
    records: int
    #: (partition, fine, task, base): base is the number of records before the task in its partition.
    table: pa.Table


def choose_width(stats: Sequence[Row], ranges: int) -> int:
    """The least width that gives at most about ``ranges`` fine ranges; a partition adds one that is not full."""
    span = sum(r["high"] - r["low"] for r in stats)
    return max(1, -(-span // max(1, ranges)))


def layout(log: DataFrame, stats: Sequence[Row], task_bytes: int = TASK_BYTES, position: str = "offset") -> Layout:
    """Tasks of about ``task_bytes`` for ``log``, whose offsets lie within ``stats``: its ``offset_stats`` or
    its bounds.

    Where a fine range holds more than a task should, ranges are made finer once, as far as ``FINE_RANGES``
    allows. Ranges are never divided between tasks.
    """
    tasks = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = choose_width(stats, min(FINE_RANGES, RANGES_PER_TASK * tasks))
    found = fine_ranges(log, width, position).toArrow()
    largest = max(found["bytes"].to_pylist(), default=0)
    finer = max(choose_width(stats, FINE_RANGES), width * task_bytes // (2 * max(1, largest)))
    if largest > task_bytes and finer < width:
        width = finer
        found = fine_ranges(log, width, position).toArrow()
    return arranged(found, width, task_bytes)


def arranged(found: pa.Table, width: int, task_bytes: int) -> Layout:
    """The layout of fine ranges that have been counted."""
    partition, fine, records, size = (found[c].to_numpy().astype(np.int64) for c in ("partition", "fine", "records", "bytes"))
    order = np.lexsort((fine, partition))
    partition, fine, records, size = partition[order], fine[order], records[order], size[order]
    if not len(order):
        empty = {"partition": pa.array([], pa.int32()), "fine": pa.array([], pa.int64()), "task": pa.array([], pa.int32()), "base": pa.array([], pa.int64())}
        return Layout(width, 1, 0, 0, pa.table(empty))
    new_partition = np.diff(partition, prepend=partition[0] - 1) != 0
    first = np.flatnonzero(new_partition)[np.cumsum(new_partition) - 1]
    before = lambda v: (np.cumsum(v) - v) - (np.cumsum(v) - v)[first]
    task_bytes = max(task_bytes, int(size.sum()) // MOST_TASKS + 1)
    slab = before(size) // task_bytes
    new_task = new_partition | (np.diff(slab, prepend=-1) != 0)
    task = np.cumsum(new_task) - 1
    base = before(records)[np.flatnonzero(new_task)[task]]
    most = int(np.bincount(task, weights=size).max())
    table = pa.table({"partition": pa.array(partition, pa.int32()), "fine": fine, "task": pa.array(task, pa.int32()), "base": base})
    return Layout(width, int(task[-1]) + 1, most, int(records.sum()), table)


def placed(log: DataFrame, plan: Layout, position: str = "offset", to: str = "seq") -> DataFrame:
    """``log`` with ``position`` replaced by the place in the partition, each task's rows one run in order.

    The rank inside a task uses the partitioning that the one shuffle made.
    """
    rest = [c for c in log.columns if c not in ("partition", position)]
    table = F.broadcast(log.sparkSession.createDataFrame(plan.table))
    found = log.withColumn("fine", F.expr(f"`{position}` div {plan.width}")).join(table, ["partition", "fine"])
    sent = found.repartitionById(plan.tasks, F.col("task"))
    inside = W.partitionBy("partition", "task").orderBy(position)
    return sent.withColumn("place", F.col("base") + F.row_number().over(inside) - 1).select("partition", F.col("place").alias(to), *rest)


def by_position(rows: DataFrame, stats: Sequence[Row], tasks: int, position: str = "seq") -> DataFrame:
    """Rows whose positions are known, sent to about ``tasks`` tasks by equal ranges of positions, in order."""
    width = choose_width(stats, tasks)
    first, lines = 0, []
    for r in sorted(stats, key=lambda r: r["partition"]):
        low = r["low"] // width
        lines.append((r["partition"], first - low))
        first += (r["high"] - 1) // width - low + 1
    table = pa.table({"partition": pa.array([p for p, _ in lines], pa.int32()), "shift": pa.array([s for _, s in lines], pa.int64())})
    shifts = F.broadcast(rows.sparkSession.createDataFrame(table))
    task = (F.expr(f"`{position}` div {width}") + F.col("shift")).cast("int")
    sent = rows.join(shifts, "partition").withColumn("task", task).repartitionById(max(1, first), F.col("task"))
    return sent.sortWithinPartitions("partition", position).select(*rows.columns)
