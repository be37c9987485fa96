"""Copy, archive and replay partitioned record logs with Spark."""

from logferry.plans.run import finish, finish_copies, reconcile, restore_all, run, status
from logferry.plans.transfer import clone, dump, dump_rows, restore
from logferry.sources.archive import archive_differences, read_archive, verify_archive, write_archive
from logferry.sources.cluster import Cluster
from logferry.sources.kafka import KafkaCluster
from logferry.sources.topic_log import TopicLog
from logferry.streaming.jobs import clone_stream, forward
from logferry.streaming.scans import stream_from_end, stream_from_progress

__all__ = [
    "Cluster",
    "KafkaCluster",
    "TopicLog",
    "archive_differences",
    "clone",
    "clone_stream",
    "dump",
    "dump_rows",
    "finish",
    "finish_copies",
    "forward",
    "read_archive",
    "reconcile",
    "restore",
    "restore_all",
    "run",
    "status",
    "stream_from_end",
    "stream_from_progress",
    "verify_archive",
    "write_archive",
]
