"""Bounded jobs: dump a topic, restore an archive, clone up to the end seen at startup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from logferry.operators.placement import TASK_BYTES, layout, placed
from logferry.operators.ranking import offset_stats
from logferry.operators.scans import beyond_end
from logferry.operators.small import local_table
from logferry.operators.state import upsert_state
from logferry.schemas import (
    ARCHIVE_FORMAT,
    COMPLETE,
    IN_PROGRESS,
    MARKERS,
    REASON_NO_STATE,
    REASON_OTHER_SOURCE,
)
from logferry.sources.archive import (
    BrokenArchive,
    is_archive,
    matches_manifest,
    read_archive,
    read_manifest,
    write_archive,
)
from logferry.sources.cluster import Cluster
from logferry.sources.files import AlreadyPublished
from logferry.sources.source import PIECE_BYTES, FileSource, Piece, Source
from logferry.sources.topic_log import RUN, Head, TopicLog


class SourceCluster(Protocol):
    """Topics to copy from: file-backed (``Cluster``) or Kafka's (``KafkaCluster``)."""

    cluster_id: str

    def source(self, name: str) -> Source: ...

    def listed(self) -> DataFrame:
        """(name, topic_id, partitions) of all topics."""


class Untrusted(RuntimeError):
    """The destination holds records that saved progress does not account for."""


def dump(log: TopicLog | Source, archive: str, force: bool = False) -> dict:
    """Archive everything up to the end captured now; returns the archive's manifest.

    The end is resolved once: every pass over a topic that goes on growing reads the same records.
    """
    if isinstance(log, TopicLog):
        log = FileSource(log, "", "", "")
    bounds = log.bounds()
    if not force and is_archive(bounds.sparkSession, archive):
        raise AlreadyPublished(f"archive {archive} already exists; pass force to replace it")
    return dump_rows(log.slice(bounds), archive, log.partitions, force, span=bounds.collect())


def dump_rows(
    rows: DataFrame,
    archive: str,
    partitions: int,
    force: bool = False,
    task_bytes: int = TASK_BYTES,
    span: Sequence[Row] | None = None,
) -> dict:
    """Archive bounded LOG rows of any source, with gaps in their offsets or without.

    Records are counted and measured, then shuffled once, to tasks of about ``task_bytes`` that each write
    one run of positions. ``span`` has (partition, low, high), where these are known to hold all offsets.
    """
    plan = layout(rows, offset_stats(rows).collect() if span is None else span, task_bytes)
    return write_archive(placed(rows, plan), archive, partitions, force, placed=True, expected=plan.records)


def topic_key(cluster: Cluster, name: str) -> DataFrame:
    return cluster.spark.createDataFrame(
        [(cluster.cluster_id, name)], "dest_cluster STRING, dest_topic STRING"
    )


def save(table, cluster: Cluster, name: str, rows: DataFrame) -> None:
    """Replace the rows of one topic in a state table."""
    managed = topic_key(cluster, name)
    table.update(lambda current: upsert_state(current, rows, managed))


def mark(cluster: Cluster, topic, digest: str, status: str) -> None:
    row = (cluster.cluster_id, topic["name"], topic["topic_id"], digest, ARCHIVE_FORMAT, status)
    save(
        cluster.markers, cluster, topic["name"], cluster.spark.createDataFrame([row], MARKERS)
    )


def restore(dest: Cluster, name: str, archive: str) -> bool:
    """Fill the fresh topic ``name`` from an archive. False if that was done before.

    The marker says ``in_progress`` from before the first record until after the last. A topic that
    already holds records without a completed marker has to be recreated first.
    """
    spark = dest.spark
    topic = dest.describe(name)
    manifest = read_manifest(spark, archive)
    if len(manifest["partitions"]) != topic["partitions"]:
        raise ValueError(
            f"archive {archive} has {len(manifest['partitions'])} partitions but topic {name} "
            f"has {topic['partitions']}"
        )
    key = (
        (F.col("dest_cluster") == dest.cluster_id)
        & (F.col("dest_topic") == name)
        & (F.col("topic_id") == topic["topic_id"])
    )
    done = dest.markers.read().where(
        key
        & (F.col("archive_digest") == manifest["digest"])
        & (F.col("format_version") == ARCHIVE_FORMAT)
        & (F.col("status") == COMPLETE)
    )
    if done.take(1):
        return False
    log = dest.open(topic).create()
    if log.head().commit:
        raise ValueError(f"topic {name} is not empty and was not restored completely")
    mark(dest, topic, manifest["digest"], IN_PROGRESS)
    # Positions are proved to be 0 to n-1, so the manifest's counts are all that an append has to know.
    rows = read_archive(spark, archive).withColumnRenamed("seq", "offset")
    stats = [{**p, "low": 0, "high": p["records"]} for p in manifest["partitions"] if p["records"]]
    log.append(rows, stats=stats)
    # What lies in the topic now is hashed and compared: the manifest alone proves nothing.
    restored = log.scan().withColumnRenamed("offset", "seq")
    if not matches_manifest(restored, manifest):
        raise BrokenArchive(f"what was restored from {archive} is not what its manifest declares")
    mark(dest, topic, manifest["digest"], COMPLETE)
    return True


def clone(
    source: SourceCluster,
    source_topic: str,
    dest: Cluster,
    name: str,
    bounds: DataFrame | None = None,
    most_bytes: int = PIECE_BYTES,
) -> Head:
    """Copy what is new in ``source_topic`` up to its captured end.

    A backlog is copied in pieces of about ``most_bytes``, each one commit. The rows and the source offsets
    they cover are committed together, so a crash at any point and a rerun neither lose nor repeat a record
    and redo one piece at most. The PROGRESS table follows the commits.
    """
    origin, target = source.source(source_topic), dest.describe(name)
    same_shape(origin, target)
    log = dest.open(target).create()
    bounds = origin.bounds() if bounds is None else bounds
    head = trusted_head(log, origin.topic_id)
    starts, ends = open_ranges(head.copied.get(origin.topic_id, {}), bounds)
    for piece in origin.pieces(starts, ends, most_bytes):
        head = take_over(log, origin.topic_id, piece, head)
    if ends != head.copied.get(origin.topic_id, {}):
        head = log.append(origin.slice(bounds.limit(0)), copied=(origin.topic_id, ends), stats=[])
    save_progress(dest, target, origin, committed_progress(log, head, origin.topic_id))
    return head


def open_ranges(done: Mapping[int, int], bounds: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """(starts, ends) of what is left to copy: from the committed offset, or the beginning, to the captured
    end. Commits keep their offsets by partition on the driver, so these are plain numbers too."""
    rows = bounds.collect()
    starts = {r["partition"]: done.get(r["partition"], r["low"]) for r in rows}
    for r in rows:
        if starts[r["partition"]] > r["high"]:
            raise beyond_end(r["partition"], starts[r["partition"]], r["high"])
    return starts, {r["partition"]: r["high"] for r in rows}


def take_over(log: TopicLog, key: str, piece: Piece, head: Head) -> Head:
    """Commit a piece with the source offsets it covers; nothing where it holds no record and changes no end."""
    stats = offset_stats(piece.rows).collect()
    if not stats and dict(piece.ends) == head.copied.get(key, {}):
        return head
    return log.append(piece.rows, copied=(key, piece.ends), stats=stats)


def same_shape(origin: Source, target) -> None:
    if origin.partitions != target["partitions"]:
        raise ValueError(
            f"topic {target['name']} has {target['partitions']} partitions but its source has "
            f"{origin.partitions}"
        )


def trusted_head(log: TopicLog, source_topic_id: str) -> Head:
    """State of a clone destination; refuses one that was filled from anywhere else."""
    head = log.head()
    cloned = {key for key in head.copied if not key.startswith(RUN)}
    if head.commit and cloned != {source_topic_id}:
        raise Untrusted(REASON_OTHER_SOURCE if cloned else REASON_NO_STATE)
    return head


def committed_progress(log: TopicLog, head: Head, source_topic_id: str) -> DataFrame:
    """(partition, next_offset) as committed with the records; null where nothing was copied."""
    done = head.copied.get(source_topic_id, {})
    rows = ({"partition": p, "high": done.get(p)} for p in range(log.partitions))
    table = local_table(log.spark, rows, ["partition", "high"])
    return table.withColumnRenamed("high", "next_offset")


def identity(dest: Cluster, target, origin: Source) -> dict[str, str]:
    return {
        "dest_cluster": dest.cluster_id,
        "dest_topic": target["name"],
        "topic_id": target["topic_id"],
        "source_cluster": origin.cluster_id,
        "source_topic": origin.name,
        "source_topic_id": origin.topic_id,
    }


def save_progress(dest: Cluster, target, origin: Source, offsets: DataFrame) -> None:
    names = identity(dest, target, origin)
    rows = offsets.select(
        *[F.lit(v).alias(k) for k, v in names.items()], "partition", "next_offset"
    )
    save(dest.progress, dest, target["name"], rows)
