"""Table schemas and fixed values shared by the whole package."""

from __future__ import annotations

_RECORD = (
    "timestamp_ms BIGINT, key BINARY, value BINARY, "
    "headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
)

LOG = f"`partition` INT, `offset` BIGINT, {_RECORD}"
ARCHIVE = f"`partition` INT, seq BIGINT, {_RECORD}"
BOUNDS = "`partition` INT, low BIGINT, high BIGINT"
PROGRESS = (
    "dest_cluster STRING, dest_topic STRING, topic_id STRING, "
    "source_cluster STRING, source_topic STRING, source_topic_id STRING, "
    "`partition` INT, next_offset BIGINT"
)
MARKERS = (
    "dest_cluster STRING, dest_topic STRING, topic_id STRING, "
    "archive_digest STRING, format_version INT, status STRING"
)
CATALOG = (
    "name STRING, topic_id STRING, generation INT, partitions INT, "
    "replication_factor INT, config MAP<STRING, STRING>"
)
MAPPINGS = (
    "name STRING, mode STRING, source_ref STRING, archive STRING, partitions INT, "
    "replication_factor INT, config MAP<STRING, STRING>, force BOOLEAN"
)

RECORD_COLUMNS = ["timestamp_ms", "key", "value", "headers"]
LOG_COLUMNS = ["partition", "offset", *RECORD_COLUMNS]
ARCHIVE_COLUMNS = ["partition", "seq", *RECORD_COLUMNS]
PROGRESS_COLUMNS = [
    "dest_cluster", "dest_topic", "topic_id",
    "source_cluster", "source_topic", "source_topic_id",
    "partition", "next_offset",
]
MARKER_COLUMNS = [
    "dest_cluster", "dest_topic", "topic_id", "archive_digest", "format_version", "status",
]
MAPPINGS_COLUMNS = [
    "name", "mode", "source_ref", "archive", "partitions", "replication_factor", "config", "force",
]

# Layout of archives written by this package; readers refuse any other number.
ARCHIVE_FORMAT = 1

# Mode names, marker states, the topic setting every copied topic must have, and
# the reasons a reconciliation reports. They have to match what users of such tools know.
MODES = ["manage", "empty", "clone", "stream", "restore"]
IN_PROGRESS = "in_progress"
COMPLETE = "complete"
TIMESTAMP_SETTING = "message.timestamp.type"
TIMESTAMP_VALUE = "CreateTime"
REASON_EMPTY = "configured empty topic must be recreated"
REASON_NOT_RESTORED = "configured archive has not completed successfully"
REASON_NO_STATE = "existing clone topic has no trusted state"
REASON_OTHER_SOURCE = "saved clone source identity differs from the configured source"
REASON_OTHER_MODE = "saved state belongs to a different data mode"
