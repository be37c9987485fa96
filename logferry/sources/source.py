"""What jobs copy from: a topic of some cluster, read in bounded pieces.

A source knows its identity, resolves its bounds once, and hands out records between given offsets. Jobs
only use this interface, so file-backed topics and Kafka topics are copied by the same code.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logferry.operators.ranking import offset_stats
from logferry.operators.scans import bounded_scan, slice_log
from logferry.operators.small import local_table
from logferry.sources.topic_log import TopicLog

#: Bytes that one commit of a copy takes over, about: what a run works on between two saved positions.
PIECE_BYTES = 64 << 30


@dataclass(frozen=True)
class Piece:
    """Records to copy together, and the next offset of each partition once they are copied."""

    rows: DataFrame
    ends: Mapping[int, int]


class Source(Protocol):
    cluster_id: str
    name: str
    topic_id: str
    partitions: int

    def bounds(self) -> DataFrame:
        """BOUNDS of all partitions as they are now; the answer is a plain table that later records do not move."""

    def slice(self, bounds: DataFrame) -> DataFrame:
        """LOG rows inside ``bounds``, the same at every evaluation."""

    def pieces(self, starts: Mapping[int, int], ends: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
        """The records from ``starts`` to ``ends``, each piece following on the one before."""

    def changes(self, starts: Mapping[int, int]) -> DataFrame:
        """A stream with rows whenever there are records after ``starts``."""

    def arrived(self, batch: DataFrame, starts: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
        """The records after ``starts`` that a micro-batch of ``changes`` announces."""


def ranges(spark: SparkSession, starts: Mapping[int, int], ends: Mapping[int, int]) -> DataFrame:
    """BOUNDS from ``starts`` to ``ends``; a partition without a start begins at 0."""
    rows = ({"partition": p, "low": starts.get(p, 0), "high": high} for p, high in sorted(ends.items()))
    return local_table(spark, rows, ["partition", "low", "high"])


def cut_evenly(starts: Mapping[int, int], ends: Mapping[int, int], pieces: int) -> Iterator[tuple[dict[int, int], dict[int, int]]]:
    """``pieces`` ranges of offsets that follow on each other, each with the same share of every partition."""
    low = {p: min(starts.get(p, 0), end) for p, end in ends.items()}
    span = {p: end - low[p] for p, end in ends.items()}
    at = dict(low)
    for k in range(1, pieces + 1):
        upto = {p: low[p] + span[p] * k // pieces for p in ends}
        if upto != at or k == pieces:
            yield at, upto
            at = upto


class FileSource:
    """A topic kept as files. Its commits are handed out whole, as many at once as ``most_bytes`` allows; a
    larger commit is cut by offsets."""

    def __init__(self, log: TopicLog, cluster_id: str, name: str, topic_id: str):
        self.log, self.cluster_id, self.name, self.topic_id = log, cluster_id, name, topic_id
        self.partitions = log.partitions

    def bounds(self) -> DataFrame:
        return self.log.bounds()

    def slice(self, bounds: DataFrame) -> DataFrame:
        # Commits are numbered, so those of now hold whatever lies before the bounds.
        return bounded_scan(self.log.scan(upto=self.log.head().commit), bounds)

    def pieces(self, starts: Mapping[int, int], ends: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
        at = {p: starts.get(p, 0) for p in ends}
        for after, upto, held in self.log.commit_ranges(self.log.covered(starts), self.log.reaching(ends), most_bytes):
            high = self.log.at(upto).high
            # An end that lies after all records belongs to the last piece.
            whole = {p: max(at[p], min(end, high.get(p, 0))) for p, end in ends.items()}
            for low, stop in cut_evenly(at, whole, -(-held // most_bytes) or 1):
                rows = bounded_scan(self.log.scan(after, upto), ranges(self.log.spark, low, stop))
                yield Piece(rows, stop)
            at = whole

    def changes(self, starts: Mapping[int, int]) -> DataFrame:
        """Commit numbers: what has arrived is read in pieces, never as the micro-batch itself."""
        return self.log.commits(self.log.covered(starts))

    def arrived(self, batch: DataFrame, starts: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
        head = self.log.head()
        ends = {p: head.high.get(p, 0) for p in range(self.partitions)}
        return self.pieces(starts, ends, most_bytes)


def arrived_rows(batch: DataFrame, starts: Mapping[int, int]) -> Piece | None:
    """The records of a micro-batch that lie after ``starts``, as one piece; partitions without a start are left out."""
    spark = batch.sparkSession
    table = local_table(spark, ({"partition": p, "low": low} for p, low in sorted(starts.items())), ["partition", "low"])
    fresh = slice_log(batch, table.withColumn("high", F.lit(None).cast("long")))
    ends = {r["partition"]: r["high"] for r in offset_stats(fresh).collect()}
    return Piece(fresh, ends) if ends else None
