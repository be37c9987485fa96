"""The same log on Spark's Kafka connector, which is not installed here: what is read or written is tested
as options, not against a broker.

``KafkaCluster`` is a cluster to copy from, like the file-backed one. Spark's Kafka sink has no timestamp
column, so a copy through it gets the broker's time. That changes the record; writing is refused unless the
caller accepts it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logferry.functions import normalize
from logferry.operators.records import identity_copy
from logferry.operators.small import local_table
from logferry.schemas import LOG_COLUMNS
from logferry.sources.source import PIECE_BYTES, Piece, arrived_rows, cut_evenly, ranges

NO_TIMESTAMP = -1


def offsets_json(topic: str, rows: Iterable, column: str) -> str:
    """``startingOffsets`` / ``endingOffsets`` for rows that carry partition and ``column``."""
    return json.dumps({topic: {str(r["partition"]): r[column] for r in rows}})


def _records(raw: DataFrame) -> DataFrame:
    stamp = F.when(F.col("timestampType") != NO_TIMESTAMP, F.unix_millis("timestamp"))
    rows = raw.withColumn("timestamp_ms", stamp)
    return normalize(rows).select(*LOG_COLUMNS)


def _options(servers: str, topic: str, extra: Mapping[str, str] | None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "includeHeaders": "true",
        "failOnDataLoss": "true",
        **(extra or {}),
    }


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A bounded read. ``kafka.isolation.level`` and ``minPartitions`` go in ``options``."""
    reader = spark.read.format("kafka").options(**_options(servers, topic, options))
    return _records(reader.options(startingOffsets=starting, endingOffsets=ending).load())


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """An unbounded read; ``starting`` is ``latest`` to forward or saved offsets to clone."""
    reader = spark.readStream.format("kafka").options(**_options(servers, topic, options))
    return _records(reader.option("startingOffsets", starting).load())


def sink_rows(log: DataFrame, topic: str, timestamp_policy: str | None = None) -> DataFrame:
    """Rows for Spark's Kafka sink, in offset order inside every Spark partition."""
    if timestamp_policy != "broker":
        raise ValueError(
            "Spark's Kafka sink cannot set record timestamps; pass timestamp_policy='broker' "
            "to accept the broker's time"
        )
    ordered = log.repartition("partition").sortWithinPartitions("partition", "offset")
    return identity_copy(ordered, topic).drop("timestamp_ms")


def write_topic(
    log: DataFrame,
    servers: str,
    topic: str,
    timestamp_policy: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """At-least-once append that keeps partition and order."""
    delivery = {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.compression.type": "lz4",
        **(options or {}),
    }
    sink_rows(log, topic, timestamp_policy).write.format("kafka").options(**delivery).save()


class Broker(Protocol):
    """What has to be asked of a Kafka cluster beside its records."""

    def topics(self) -> Mapping[str, tuple[str, int]]:
        """Topic id and number of partitions of every topic."""

    def offsets(self, topic: str, partitions: int) -> Iterable[tuple[int, int, int]]:
        """(partition, first offset, end) as they are now."""


class ClientBroker:
    """Asks through the Kafka client that the connector brings along. Untested without a broker."""

    def __init__(self, spark: SparkSession, servers: str, options: Mapping[str, str]):
        self._jvm, self._servers = spark._jvm, servers
        self._options = {k.removeprefix("kafka."): v for k, v in options.items() if k.startswith("kafka.")}

    def _properties(self):
        properties = self._jvm.java.util.Properties()
        plain = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
        given = {"bootstrap.servers": self._servers, "key.deserializer": plain, "value.deserializer": plain}
        for key, value in {**given, **self._options}.items():
            properties.put(key, value)
        return properties

    def topics(self) -> Mapping[str, tuple[str, int]]:
        admin = self._jvm.org.apache.kafka.clients.admin.Admin.create(self._properties())
        try:
            described = admin.describeTopics(admin.listTopics().names().get()).allTopicNames().get()
            return {str(n): (str(d.topicId()), d.partitions().size()) for n, d in dict(described).items()}
        finally:
            admin.close()

    def offsets(self, topic: str, partitions: int) -> Iterable[tuple[int, int, int]]:
        consumer = self._jvm.org.apache.kafka.clients.consumer.KafkaConsumer(self._properties())
        try:
            asked = self._jvm.java.util.ArrayList()
            for p in range(partitions):
                asked.add(self._jvm.org.apache.kafka.common.TopicPartition(topic, p))
            low, high = (dict(f(asked)) for f in (consumer.beginningOffsets, consumer.endOffsets))
            return [(key.partition(), low[key], high[key]) for key in high]
        finally:
            consumer.close()


class KafkaSource:
    """A Kafka topic. Its partitions are fixed when the source is made, its bounds whenever they are asked for.

    Sizes of records are not known before they are read; a piece holds as many offsets as ``most_bytes``
    allows for records of ``record_bytes``.
    """

    def __init__(self, spark: SparkSession, servers: str, cluster_id: str, name: str, topic_id: str, partitions: int, broker: Broker, options: Mapping[str, str], record_bytes: int = 1_024):
        self.spark, self._servers, self._broker, self._options = spark, servers, broker, dict(options)
        self.cluster_id, self.name, self.topic_id, self.partitions = cluster_id, name, topic_id, partitions
        self._record_bytes = record_bytes

    def bounds(self) -> DataFrame:
        rows = ({"partition": p, "low": low, "high": high} for p, low, high in sorted(self._broker.offsets(self.name, self.partitions)))
        return local_table(self.spark, rows, ["partition", "low", "high"])

    def _given(self, partitions: Iterable[int]) -> dict[str, str]:
        options = _options(self._servers, self.name, self._options)
        del options["subscribe"]
        # Partitions that appear later are not read: the next reconciliation sees them as drift.
        return options | {"assign": json.dumps({self.name: sorted(partitions)})}

    def read_options(self, bounds: DataFrame) -> dict[str, str]:
        """Options of a bounded read; both ends are offsets, never ``latest``."""
        rows = bounds.orderBy("partition").collect()
        return self._given(r["partition"] for r in rows) | {
            "startingOffsets": offsets_json(self.name, rows, "low"),
            "endingOffsets": offsets_json(self.name, rows, "high"),
        }

    def stream_options(self, starts: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> dict[str, str]:
        """Options of an unbounded read from ``starts`` whose micro-batches are limited."""
        rows = [{"partition": p, "low": starts.get(p, 0)} for p in range(self.partitions)]
        return self._given(range(self.partitions)) | {
            "startingOffsets": offsets_json(self.name, rows, "low"),
            "maxOffsetsPerTrigger": str(max(1, most_bytes // self._record_bytes)),
        }

    def slice(self, bounds: DataFrame) -> DataFrame:
        return _records(self.spark.read.format("kafka").options(**self.read_options(bounds)).load())

    def pieces(self, starts: Mapping[int, int], ends: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
        span = sum(max(0, end - starts.get(p, 0)) for p, end in ends.items())
        most = max(1, most_bytes // self._record_bytes)
        for low, stop in cut_evenly(starts, ends, -(-span // most)):
            yield Piece(self.slice(ranges(self.spark, low, stop)), stop)

    def changes(self, starts: Mapping[int, int]) -> DataFrame:
        return _records(self.spark.readStream.format("kafka").options(**self.stream_options(starts)).load())

    def arrived(self, batch: DataFrame, starts: Mapping[int, int], most_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
        piece = arrived_rows(batch, starts)
        if piece:
            yield piece


class KafkaCluster:
    """Topics of a Kafka cluster, as sources for dumps, clones and streams."""

    def __init__(self, spark: SparkSession, servers: str, cluster_id: str, options: Mapping[str, str] | None = None, broker: Broker | None = None):
        self.spark, self.cluster_id = spark, cluster_id
        self._servers, self._options = servers, dict(options or {})
        self._broker = broker or ClientBroker(spark, servers, self._options)

    def source(self, name: str) -> KafkaSource:
        known = self._broker.topics()
        if name not in known:
            raise KeyError(f"topic {name} does not exist on {self.cluster_id}")
        topic_id, partitions = known[name]
        return KafkaSource(self.spark, self._servers, self.cluster_id, name, topic_id, partitions, self._broker, self._options)

    def listed(self) -> DataFrame:
        rows = [(name, topic_id, partitions) for name, (topic_id, partitions) in sorted(self._broker.topics().items())]
        return self.spark.createDataFrame(rows, "name STRING, topic_id STRING, partitions INT")
