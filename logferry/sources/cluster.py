"""A set of topics with one catalog and the state that jobs keep about them.

    <root>/catalog/                      CATALOG
    <root>/state/progress, state/markers PROGRESS and MARKERS of the topics written here
    <root>/logs/<name>/<topic_id>/       one log per topic generation
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logferry.schemas import CATALOG, MARKERS, PROGRESS, TIMESTAMP_SETTING, TIMESTAMP_VALUE
from logferry.sources.source import FileSource
from logferry.sources.tables import SmallTable
from logferry.sources.topic_log import TopicLog


class UnknownTopic(KeyError):
    pass


def topic_identity(cluster_id: str, name: Column, generation: Column) -> Column:
    """Identity of one generation of a topic; recreating a topic always changes it."""
    parts = [F.lit(cluster_id), name, generation.cast("string")]
    return F.sha2(F.concat_ws("\n", *parts).cast("binary"), 256)


class Cluster:
    def __init__(self, spark: SparkSession, root: str, cluster_id: str):
        self.spark, self.root, self.cluster_id = spark, root, cluster_id
        self.catalog = SmallTable(spark, f"{root}/catalog", CATALOG)
        self.progress = SmallTable(spark, f"{root}/state/progress", PROGRESS)
        self.markers = SmallTable(spark, f"{root}/state/markers", MARKERS)

    def describe(self, name: str):
        rows = self.catalog.read().where(F.col("name") == name).take(1)
        if not rows:
            raise UnknownTopic(f"topic {name} does not exist on {self.cluster_id}")
        return rows[0]

    def topic(self, name: str) -> TopicLog:
        return self.open(self.describe(name))

    def source(self, name: str) -> FileSource:
        """A topic as something to copy from."""
        row = self.describe(name)
        return FileSource(self.open(row), self.cluster_id, name, row["topic_id"])

    def listed(self) -> DataFrame:
        """(name, topic_id, partitions) of all topics."""
        return self.catalog.read().select("name", "topic_id", "partitions")

    def open(self, row) -> TopicLog:
        """The log of a catalog row."""
        return TopicLog(self.spark, self.log_path(row), row["partitions"])

    def log_path(self, row) -> str:
        return f"{self.root}/logs/{row['name']}/{row['topic_id']}"

    def create_topic(
        self,
        name: str,
        partitions: int,
        replication_factor: int = 1,
        config: Mapping[str, str] | None = None,
    ) -> TopicLog:
        return self._declare(name, partitions, replication_factor, config).create()

    def import_topic(
        self, name: str, rows: DataFrame, partitions: int, high: Mapping[int, int] | None = None
    ) -> TopicLog:
        """A new topic holding ``rows`` with their own offsets."""
        log = self._declare(name, partitions, 1, None).create()
        log.ingest(rows, high)
        return log

    def _declare(self, name, partitions, replication_factor, config) -> TopicLog:
        settings = {**(config or {}), TIMESTAMP_SETTING: TIMESTAMP_VALUE}
        given = self.spark.createDataFrame(
            [(name, None, 1, partitions, replication_factor, settings)], CATALOG
        )
        identity = topic_identity(self.cluster_id, F.col("name"), F.col("generation"))
        row = given.withColumn("topic_id", identity)

        def add(current: DataFrame) -> DataFrame:
            if current.where(F.col("name") == name).take(1):
                raise ValueError(f"topic {name} already exists on {self.cluster_id}")
            return current.unionByName(row)

        self.catalog.update(add)
        return self.topic(name)
