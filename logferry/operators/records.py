"""Record projections: what is kept, dropped and renamed when records move."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.functions import normalize, record_digest
from logferry.operators.ranking import RANK_CHUNK, partition_sequence
from logferry.schemas import ARCHIVE_COLUMNS, LOG_COLUMNS, RECORD_COLUMNS


def identity_copy(log: DataFrame, topic: str) -> DataFrame:
    """Rows ready to be written to ``topic``: same partition and record, no source offset."""
    return normalize(log).select(F.lit(topic).alias("topic"), "partition", *RECORD_COLUMNS)


def to_archive(log: DataFrame, chunk: int = RANK_CHUNK) -> DataFrame:
    """Archive rows: the position in the partition replaces the offset."""
    return partition_sequence(normalize(log), chunk).select(*ARCHIVE_COLUMNS)


def ranked_digests(log: DataFrame, chunk: int = RANK_CHUNK) -> DataFrame:
    """(partition, offset, d, seq): digests in archive order. Records are hashed where they are read,
    so only 32 bytes of each are shuffled to be ranked."""
    hashed = normalize(log).select("partition", "offset", F.unhex(record_digest()).alias("d"))
    return partition_sequence(hashed, chunk)


def from_archive(archive: DataFrame) -> DataFrame:
    """Log rows of a fresh destination, whose offsets are the archive positions."""
    rows = normalize(archive, "seq").withColumnRenamed("seq", "offset")
    return rows.select(*LOG_COLUMNS)
