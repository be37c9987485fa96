"""Whole runs over declared topics: reconcile, then restore, clone and forward."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logferry.operators import catalog as topics
from logferry.operators.mappings import audit_mappings, declarations, split_source
from logferry.operators.progress import copy_status, initial_progress
from logferry.operators.state import clear_stateless, validate_sources
from logferry.plans.transfer import SourceCluster, clone, identity, restore, save
from logferry.schemas import MAPPINGS_COLUMNS
from logferry.sources.archive import read_manifest
from logferry.sources.cluster import Cluster
from logferry.sources.files import Files, fresh_name
from logferry.sources.source import PIECE_BYTES
from logferry.streaming.jobs import Figures, clone_stream, forward


class BadMappings(ValueError):
    pass


def restore_all(
    dest: Cluster,
    sources: Mapping[str, SourceCluster],
    mappings: DataFrame,
    force: bool = False,
    parallel: int = 4,
) -> None:
    """Reconcile, restore what is incomplete, and advance every clone to the end its source has
    now, ``parallel`` at a time. Streams stay inactive. The first failure cancels waiting clones."""
    declared = _audited(mappings, sources)
    if not declared:
        raise BadMappings("nothing is declared")
    clones = [m for m in declared if m["mode"] == "clone"]
    ends = {}
    for m in clones:
        source, topic = _source(m, sources)
        ends[m["name"]] = source.source(topic).bounds()
    reconcile(dest, sources, mappings, force, parallel)

    def advance(m) -> None:
        source, topic = _source(m, sources)
        clone(source, topic, dest, m["name"], ends[m["name"]])

    _at_once(advance, clones, parallel)


def _at_once(job: Callable, rows: list, parallel: int) -> None:
    """``job`` of every row, ``parallel`` at a time; the first failure cancels those that wait."""
    # Each is a distributed job of its own; the threads only submit them.
    with ThreadPoolExecutor(parallel) as pool:
        try:
            for result in as_completed([pool.submit(job, r) for r in rows]):
                result.result()
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


@dataclass(frozen=True)
class Copy:
    """A running clone or stream of one destination topic."""

    topic: str
    query: StreamingQuery
    # Next source offset per partition of a stream, which saves no progress.
    positions: dict[int, int]
    # Whether the query ends by itself when it has reached the present end.
    bounded: bool = False
    # Live offsets and errors of its micro-batches.
    figures: Figures = field(default_factory=Figures)


def run(
    dest: Cluster,
    sources: Mapping[str, SourceCluster],
    mappings: DataFrame,
    checkpoints: str,
    force: bool = False,
    available_now: bool = False,
    every: str | None = None,
    most_bytes: int = PIECE_BYTES,
    patience: float = 0.0,
) -> list[Copy]:
    """Reconcile, then start one query per clone and stream. Wait with ``finish_copies``.

    A backlog is copied in commits of about ``most_bytes``; what fails is tried again for ``patience``
    seconds before its copy fails, and with it all others.
    """
    declared = _audited(mappings, sources)
    if not any(m["mode"] in ("clone", "stream") for m in declared):
        raise BadMappings("run needs at least one clone or stream topic")
    reconcile(dest, sources, mappings, force)
    started: list[Copy] = []
    try:
        for m in declared:
            if m["mode"] not in ("clone", "stream"):
                continue
            name, positions, figures = m["name"], {}, Figures()
            source, topic = _source(m, sources)
            timing = {"available_now": available_now, "every": every, "most_bytes": most_bytes, "patience": patience, "figures": figures}
            if m["mode"] == "clone":
                place = f"{checkpoints}/{name}-{dest.describe(name)['topic_id']}"
                query = clone_stream(source, topic, dest, name, place, **timing)
            else:
                place = f"{checkpoints}/{name}-{fresh_name()}"
                query = forward(
                    source, topic, dest, name, place, positions=positions, **timing
                )
            started.append(Copy(name, query, positions, available_now, figures))
    except BaseException:
        _stop([c.query for c in started])
        raise
    return started


class EndedEarly(RuntimeError):
    """A copy that should run on has ended without an error."""


def finish(started: list[StreamingQuery], endless: Iterable[StreamingQuery] = ()) -> None:
    """Wait until all queries end. The first failure stops the others and is raised; so does the end,
    even without an error, of one of ``endless``."""
    running_on = {q.id for q in endless}
    waiting = list(started)
    try:
        while waiting:
            for query in [q for q in waiting if not q.isActive]:
                query.awaitTermination()  # raises what ended it
                waiting.remove(query)
                if query.id in running_on:
                    raise EndedEarly(f"{query.name} ended although it should run on")
            time.sleep(0.2)
    finally:
        _stop(started)


def finish_copies(started: list[Copy]) -> None:
    """Wait for the copies of ``run``: until all are done if they are bounded, else until one ends."""
    finish([c.query for c in started], [c.query for c in started if not c.bounded])


def status(dest: Cluster, started: list[Copy]) -> DataFrame:
    """``copy_status`` of running copies: saved progress of clones, positions of streams, and errors: of the
    partitions whose last attempt failed while the copy goes on, and of all partitions of a copy that died."""
    spark = dest.spark
    partitions = {c.topic: dest.describe(c.topic)["partitions"] for c in started}
    topics_of = spark.createDataFrame(list(partitions.items()), "topic STRING, partitions INT")
    listed = topics_of.select(
        "topic", F.explode(F.sequence(F.lit(0), F.col("partitions") - 1)).alias("partition")
    )
    passed = spark.createDataFrame(
        [(c.topic, p, offset) for c in started for p, offset in c.positions.items()],
        "topic STRING, `partition` INT, next_offset BIGINT",
    )
    saved = dest.progress.read().where(F.col("dest_cluster") == dest.cluster_id)
    progress = saved.select(F.col("dest_topic").alias("topic"), "partition", "next_offset")
    dead = {c.topic: str(c.query.exception()) for c in started if c.query.exception()}
    said = {(c.topic, p): message for c in started for p, message in c.figures.last_error.items()}
    rows = [(c.topic, p, dead.get(c.topic) or said.get((c.topic, p))) for c in started for p in range(partitions[c.topic])]
    errors = spark.createDataFrame([r for r in rows if r[2]], "topic STRING, `partition` INT, last_error STRING")
    return copy_status(progress.unionByName(passed), errors, listed)


def _stop(started: list[StreamingQuery]) -> None:
    for query in started:
        if query.isActive:
            query.stop()


def _audited(mappings: DataFrame, sources: Mapping[str, SourceCluster]) -> list:
    known = mappings.sparkSession.createDataFrame([(s,) for s in sources], "instance STRING")
    faults = audit_mappings(declarations(mappings), known).orderBy("name", "violation").collect()
    if faults:
        lines = "".join(f"\n- {r['name']}: {r['violation']} {r['detail']}" for r in faults)
        raise BadMappings(f"declared topics are not valid:{lines}")
    # One row per declared topic: the jobs below are started one by one.
    return mappings.orderBy("name").collect()


def _source(mapping, sources: Mapping[str, SourceCluster]) -> tuple[SourceCluster, str]:
    instance, topic = mapping["source_ref"].split(":", 1)
    return sources[instance], topic


def _source_topics(mappings: DataFrame, sources: Mapping[str, SourceCluster]) -> DataFrame:
    """Identity and partition count behind every clone and stream declaration."""
    instance, topic = split_source(F.col("source_ref"))
    wanted = mappings.where(F.col("mode").isin("clone", "stream")).select(
        "name", "mode", "source_ref", instance.alias("instance"), topic.alias("source_topic")
    )
    live = None
    for label, cluster in sources.items():
        rows = cluster.listed().select(
            F.lit(label).alias("instance"),
            F.lit(cluster.cluster_id).alias("source_cluster"),
            F.col("name").alias("source_topic"),
            F.col("topic_id").alias("source_topic_id"),
            "partitions",
        )
        live = rows if live is None else live.unionByName(rows)
    if live is None:
        live = mappings.sparkSession.createDataFrame(
            [],
            "instance STRING, source_cluster STRING, source_topic STRING, "
            "source_topic_id STRING, partitions INT",
        )
    return wanted.join(live, ["instance", "source_topic"])


def reconcile(
    dest: Cluster,
    sources: Mapping[str, SourceCluster],
    mappings: DataFrame,
    force: bool = False,
    parallel: int = 4,
) -> DataFrame:
    """Bring the destination topics into their declared shape; returns the actions taken. Archives
    are restored ``parallel`` at a time.

    All decisions are made, and refused if need be, before the first change. State rows go before
    the catalog changes, so a crash in between leaves topics that are not trusted, never state that
    belongs to other contents.
    """
    spark = dest.spark
    mappings = mappings.select(*MAPPINGS_COLUMNS)
    archived = {
        r["archive"]: read_manifest(spark, r["archive"])
        for r in mappings.where(F.col("mode") == "restore").select("archive").distinct().collect()
    }
    manifests = spark.createDataFrame(
        [(path, len(m["partitions"]), m["digest"]) for path, m in archived.items()],
        "archive STRING, partitions INT, archive_digest STRING",
    )
    origin = _source_topics(mappings, sources)
    wanted = topics.desired(
        mappings, origin.select("source_ref", "partitions"), manifests
    )
    identities = origin.where(F.col("mode") == "clone").select(
        "name", "source_cluster", "source_topic", "source_topic_id"
    )
    mine = F.col("dest_cluster") == dest.cluster_id
    decided = topics.reconcile_actions(
        wanted,
        dest.catalog.read(),
        dest.progress.read().where(mine),
        dest.markers.read().where(mine),
        identities,
        mappings.where(F.col("mode") == "restore")
        .join(manifests, "archive")
        .select("name", "archive_digest"),
    )
    # The decisions must not change while they are carried out: fix them as a plain table. It has
    # one row per declared topic.
    rows = decided.collect()
    for row in rows:
        if row["desired_partitions"] is None:
            raise BadMappings(f"source of {row['name']} does not exist")
    actions = spark.createDataFrame(rows, decided.schema)
    topics.require_allowed(actions, force)
    for table in (dest.progress, dest.markers):
        table.update(
            lambda saved: clear_stateless(
                topics.apply_to_state(saved, actions, dest.cluster_id), dest.cluster_id, actions
            )
        )
    _apply(dest, sources, actions, parallel)
    foreign = validate_sources(dest.progress.read().where(mine), identities).take(1)
    if foreign:
        raise RuntimeError(f"saved state of {foreign[0]['name']} belongs to another source")
    return actions


def _apply(
    dest: Cluster, sources: Mapping[str, SourceCluster], actions: DataFrame, parallel: int
) -> None:
    changed = actions.where(F.col("action") != "none").orderBy("name").collect()
    if not changed:
        return
    names = [r["name"] for r in changed]
    old = dest.catalog.read().where(F.col("name").isin(names)).collect()
    dest.catalog.update(lambda rows: topics.apply_to_catalog(rows, actions, dest.cluster_id))
    files = Files(dest.spark)
    for row in old:
        files.delete(dest.log_path(row))
    live = {r["name"]: r for r in dest.catalog.read().where(F.col("name").isin(names)).collect()}
    for row in changed:
        target = live[row["name"]]
        dest.open(target).create()
        if row["mode"] == "clone":
            source, topic = _source(row, sources)
            names_of = identity(dest, target, source.source(topic))
            fresh = initial_progress(names_of, target["partitions"], dest.spark)
            save(dest.progress, dest, row["name"], fresh)
    restores = [r for r in changed if r["mode"] == "restore"]
    _at_once(lambda r: restore(dest, r["name"], r["archive"]), restores, parallel)
