"""Declared topics against live ones: what has to be created, rebuilt or kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logferry.operators.state import TOPIC, clone_mismatch, restore_done
from logferry.schemas import (
    REASON_EMPTY,
    REASON_NOT_RESTORED,
    TIMESTAMP_SETTING,
    TIMESTAMP_VALUE,
)
from logferry.sources.cluster import topic_identity

DEFAULT_REPLICATION = 1


class RecreationRefused(RuntimeError):
    """Topics would have to be rebuilt but nobody allowed it. Nothing was changed."""


def partition_counts(topic_partitions: DataFrame) -> DataFrame:
    """(topic, partitions) from rows that name a topic and one of its partitions."""
    return topic_partitions.groupBy("topic").agg(
        F.countDistinct("partition").cast("int").alias("partitions")
    )


def desired(mappings: DataFrame, counts: DataFrame, archives: DataFrame) -> DataFrame:
    """Mappings with ``desired_partitions``: from the source, the archive or the declaration.

    ``counts`` has (source_ref, partitions), ``archives`` has (archive, partitions). Null means
    that the source or archive is missing.
    """
    by_source = counts.select(
        F.col("source_ref").alias("source_key"), F.col("partitions").alias("source_partitions")
    )
    by_archive = archives.select(
        F.col("archive").alias("archive_key"), F.col("partitions").alias("archive_partitions")
    )
    wanted = (
        F.when(F.col("mode").isin("clone", "stream"), F.col("source_partitions"))
        .when(F.col("mode") == "restore", F.col("archive_partitions"))
        .otherwise(F.col("partitions"))
    )
    return (
        mappings.withColumn("source_key", _spread("source_ref"))
        .withColumn("archive_key", _spread("archive"))
        .join(by_source, "source_key", "left")
        .join(by_archive, "archive_key", "left")
        .select(*mappings.columns, wanted.alias("desired_partitions"))
    )


def _spread(column: str) -> Column:
    """Join key in which rows without a value do not all land in one task."""
    return F.coalesce(column, F.concat(F.lit("\0"), F.col("name")))


def _setting_differs(name: Column, live: Column, wanted: Column) -> Column:
    return F.concat(
        F.lit("config "),
        name,
        F.lit(" is "),
        F.coalesce(live, F.lit("not set")),
        F.lit(" but expected "),
        wanted,
    )


def drift(wanted: DataFrame, live: DataFrame) -> DataFrame:
    """(name, reason): first difference of each existing declared topic, or null.

    Partition count first, then a declared replication factor, the timestamp setting, and the
    declared settings in key order. Settings that are not declared are not compared.
    """
    now = live.select(
        "name",
        F.col("partitions").alias("live_partitions"),
        F.col("replication_factor").alias("live_replication"),
        F.col("config").alias("live_config"),
    )
    stamp = F.col("live_config")[TIMESTAMP_SETTING]
    wrong_keys = F.filter(
        F.array_sort(F.map_keys("config")),
        lambda k: ~F.col("live_config")[k].eqNullSafe(F.col("config")[k]),
    )
    first = F.get(wrong_keys, 0)
    reason = (
        F.when(
            F.col("live_partitions") != F.col("desired_partitions"),
            F.concat(
                F.lit("partition count is "),
                F.col("live_partitions").cast("string"),
                F.lit(" but expected "),
                F.col("desired_partitions").cast("string"),
            ),
        )
        .when(
            F.col("live_replication") != F.col("replication_factor"),
            F.concat(
                F.lit("replication factor is "),
                F.col("live_replication").cast("string"),
                F.lit(" but expected "),
                F.col("replication_factor").cast("string"),
            ),
        )
        .when(
            ~stamp.eqNullSafe(F.lit(TIMESTAMP_VALUE)),
            _setting_differs(F.lit(TIMESTAMP_SETTING), stamp, F.lit(TIMESTAMP_VALUE)),
        )
        .when(
            first.isNotNull(),
            _setting_differs(first, F.col("live_config")[first], F.col("config")[first]),
        )
    )
    return wanted.join(now, "name").select("name", reason.alias("reason"))


def decide(existing: Column, reason: Column) -> Column:
    return (
        F.when(~existing, "create").when(reason.isNotNull(), "recreate").otherwise("none")
    )


def reconcile_actions(
    wanted: DataFrame,
    live: DataFrame,
    progress: DataFrame,
    markers: DataFrame,
    sources: DataFrame,
    archives: DataFrame,
) -> DataFrame:
    """Declarations with ``action`` (create, recreate, none) and its ``reason``.

    The first reason counts: always-empty topics, shape, unfinished restore, untrusted clone state.
    ``sources`` and ``archives`` name the identity behind each clone and restore topic.
    """
    shape = drift(wanted, live).withColumnRenamed("reason", "shape_reason")
    restored = restore_done(live, markers, archives)
    clones = clone_mismatch(live, progress, markers, sources)
    clones = clones.withColumnRenamed("reason", "clone_reason")
    alive = live.select("name", F.lit(True).alias("exists"))
    existing = F.coalesce("exists", F.lit(False))
    reason = F.coalesce(
        F.when(F.col("mode") == "empty", REASON_EMPTY),
        F.col("shape_reason"),
        F.when((F.col("mode") == "restore") & ~F.col("restored"), REASON_NOT_RESTORED),
        F.when(F.col("mode") == "clone", F.col("clone_reason")),
    )
    joined = wanted
    for side in (alive, shape, restored, clones):
        joined = joined.join(side, "name", "left")
    return (
        joined.withColumn("action", decide(existing, reason))
        .withColumn("reason", F.when(existing, reason))
        .select(*wanted.columns, "action", "reason")
    )


def preflight(actions: DataFrame, force: bool) -> DataFrame:
    """(name, reason) of every rebuild that neither the run nor the topic allows."""
    allowed = F.lit(force) | F.coalesce("force", F.lit(False))
    return actions.where((F.col("action") == "recreate") & ~allowed).select("name", "reason")


def require_allowed(actions: DataFrame, force: bool) -> None:
    """Raise before anything changes if any rebuild is not allowed."""
    blocked = preflight(actions, force).orderBy("name").collect()
    if blocked:
        lines = "".join(f"\n- {r['name']}: {r['reason']}" for r in blocked)
        raise RecreationRefused(f"destination topics need force to be recreated:{lines}")


def apply_to_catalog(catalog: DataFrame, actions: DataFrame, cluster: str) -> DataFrame:
    """The catalog after the actions. A rebuilt topic is a new generation with a new identity and
    therefore an empty log; topics with nothing to do, and undeclared ones, keep theirs."""
    stamped = F.map_concat(
        F.coalesce("config", F.create_map().cast("map<string,string>")),
        F.create_map(F.lit(TIMESTAMP_SETTING), F.lit(TIMESTAMP_VALUE)),
    )
    shapes = _changed(actions).select(
        "name",
        F.struct(
            F.col("desired_partitions").cast("int").alias("partitions"),
            F.coalesce("replication_factor", F.lit(DEFAULT_REPLICATION)).alias("replication_factor"),
            stamped.alias("config"),
        ).alias("new"),
    )
    # One join says which topics are kept, rebuilt and new.
    both = catalog.select("name", F.struct(*catalog.columns).alias("old")).join(shapes, "name", "full")
    generation = F.coalesce(F.col("old.generation") + 1, F.lit(1))
    rebuilt = {"name": F.col("name"), "topic_id": topic_identity(cluster, F.col("name"), generation), "generation": generation}
    return both.select(
        *[
            F.when(F.col("new").isNull(), F.col(f"old.{c}")).otherwise(rebuilt.get(c, F.col(f"new.{c}"))).alias(c)
            for c in catalog.columns
        ]
    )


def _changed(actions: DataFrame) -> DataFrame:
    """What is created or rebuilt. Stored decisions are small as files, which must not make them a broadcast."""
    return actions.where(F.col("action") != "none").hint("merge")


def apply_to_state(state: DataFrame, actions: DataFrame, cluster: str) -> DataFrame:
    """State without the rows of created and rebuilt topics."""
    changed = _changed(actions).select(
        F.lit(cluster).alias("dest_cluster"), F.col("name").alias("dest_topic")
    )
    return state.join(changed, TOPIC, "left_anti")
