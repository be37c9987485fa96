"""The registered queries: one per operator or job, each over whole derived inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import EVENT_PARTITIONS, ORDER_PARTITIONS, Inputs
from logferry.functions import headers_text, normalize, with_digest
from logferry.operators import catalog, mappings, placement, progress, ranking, records, scans, state
from logferry.operators.digest import fingerprint, root_digest, roundtrip_check
from logferry.plans.run import finish, restore_all, run
from logferry.plans.transfer import clone, dump, restore
from logferry.schemas import MAPPINGS
from logferry.sources.archive import archive_differences, read_archive, read_manifest, write_archive
from logferry.sources.cluster import Cluster
from logferry.sources.files import shared_folder, written
from logferry.streaming.jobs import clone_stream, forward
from logferry.streaming.scans import stream_from_end, stream_from_progress

FAN_IN = 1_024
# Declared but empty partitions behind the four that hold events.
DECLARED = 6

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register under the function's name; a trailing underscore only avoids a clash."""
    name = function.__name__.rstrip("_")
    QUERIES[name] = lambda spark, folder: function(Inputs(spark, folder))
    return function


# ---- shapes that the checks compare


def as_text(rows: DataFrame, position: str = "offset") -> DataFrame:
    return rows.select(
        "partition",
        position,
        "timestamp_ms",
        F.hex("key").alias("key_hex"),
        F.hex("value").alias("value_hex"),
        headers_text(F.col("headers")).alias("headers_text"),
    )


def settings_text(config: Column) -> Column:
    pairs = F.transform(
        F.array_sort(F.map_entries(config)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(pairs, ";")


def cut_point(log: DataFrame) -> int:
    """Offset that separates what exists at startup from what arrives later."""
    return (log.agg(F.max("offset")).first()[0] + 1) * 6 // 10


def split(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = cut_point(log)
    return log.where(F.col("offset") < cut), log.where(F.col("offset") >= cut)


def source_cluster(inputs: Inputs) -> Cluster:
    return Cluster(inputs.spark, f"{shared_folder(inputs.spark)}/source", "source")


def dest_cluster(inputs: Inputs) -> Cluster:
    return Cluster(inputs.spark, f"{shared_folder(inputs.spark)}/dest", "dest")


def drain(stream: DataFrame, inputs: Inputs) -> DataFrame:
    """All rows that a stream holds now."""
    place = shared_folder(inputs.spark)
    started = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{place}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{place}/rows")
    )
    started.awaitTermination()
    return inputs.spark.read.schema(stream.schema).parquet(f"{place}/rows")


# ---- scans


@query
def topic_scan(inputs: Inputs) -> DataFrame:
    log = source_cluster(inputs).import_topic("events", inputs.events_log(), EVENT_PARTITIONS)
    return as_text(log.scan())


@query
def topic_watermarks(inputs: Inputs) -> DataFrame:
    rows = inputs.events_log()
    end = rows.agg(F.max("offset") + 1).first()[0]
    ends = {p: end for p in range(DECLARED)}
    log = source_cluster(inputs).import_topic("events", rows, DECLARED, ends)
    return scans.watermarks(log.scan(), DECLARED, log.bounds())


@query
def bounded_scan(inputs: Inputs) -> DataFrame:
    log = normalize(inputs.events_log())
    before, _ = split(log)
    return as_text(scans.bounded_scan(log, scans.watermarks(before, DECLARED)))


@query
def resume_scan(inputs: Inputs) -> DataFrame:
    log = normalize(inputs.events_log())
    before, _ = split(log)
    saved = progress.fold_progress(before.where("partition < 3"))
    return as_text(scans.resume_scan(log, saved, scans.watermarks(log, EVENT_PARTITIONS)))


@query
def stream_from_end_(inputs: Inputs) -> DataFrame:
    before, after = split(inputs.events_log())
    log = source_cluster(inputs).import_topic("events", before, EVENT_PARTITIONS)
    ends = log.bounds()
    log.ingest(after)
    return as_text(drain(stream_from_end(log, ends), inputs))


@query
def stream_from_progress_(inputs: Inputs) -> DataFrame:
    before, after = split(inputs.events_log())
    log = source_cluster(inputs).import_topic("events", before, EVENT_PARTITIONS)
    log.ingest(after)
    saved = progress.fold_progress(before).join(log.bounds(), "partition", "right")
    # Partition 3 has trusted progress but nothing was copied yet.
    nothing = F.when(F.col("partition") != 3, F.col("next_offset"))
    return as_text(
        drain(stream_from_progress(log, saved.select("partition", nothing.alias("next_offset"))), inputs)
    )


@query
def archive_scan(inputs: Inputs) -> DataFrame:
    path = f"{shared_folder(inputs.spark)}/events"
    write_archive(records.to_archive(inputs.events_log()), path, EVENT_PARTITIONS)
    return as_text(read_archive(inputs.spark, path), "seq")


# ---- sinks


@query
def archive_write(inputs: Inputs) -> DataFrame:
    path = f"{shared_folder(inputs.spark)}/orders"
    rows = records.to_archive(inputs.orders_log())
    write_archive(rows, path, ORDER_PARTITIONS + 1)
    return manifest_rows(inputs.spark, path)


def manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """Manifest entries beside what the files hold; the root digest is partition -1."""
    manifest = read_manifest(spark, path)
    rows = [(p["partition"], p["records"], p["digest"]) for p in manifest["partitions"]]
    rows.append((-1, manifest["records"], manifest["digest"]))
    listed = spark.createDataFrame(rows, "`partition` INT, records BIGINT, digest STRING")
    held = (
        read_archive(spark, path)
        .groupBy("partition")
        .agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    )
    return listed.join(held, "partition", "left")


@query
def topic_append(inputs: Inputs) -> DataFrame:
    before, after = split(inputs.events_log())
    log = dest_cluster(inputs).create_topic("copy", EVENT_PARTITIONS)
    log.append(before, batch=("job", 0))
    log.append(before, batch=("job", 0))
    log.append(after, batch=("job", 1))
    return as_text(log.scan())


# ---- projections and identity


@query
def identity_copy(inputs: Inputs) -> DataFrame:
    rows = records.identity_copy(inputs.events_log(), "copy")
    return as_text(rows, "topic")


@query
def record_digest(inputs: Inputs) -> DataFrame:
    return with_digest(normalize(inputs.events_log())).select(
        "partition", "offset", "record_digest"
    )


@query
def archive_projection(inputs: Inputs) -> DataFrame:
    return as_text(records.to_archive(inputs.events_log(), chunk=4_096), "seq")


@query
def record_from_archive(inputs: Inputs) -> DataFrame:
    return as_text(records.from_archive(records.to_archive(inputs.events_log())))


# ---- ordering


@query
def partition_sequence(inputs: Inputs) -> DataFrame:
    numbered = ranking.partition_sequence(inputs.orders_log(), chunk=4_096)
    return numbered.select("partition", "offset", "seq")


@query
def assign_offsets(inputs: Inputs) -> DataFrame:
    before, after = split(normalize(inputs.events_log()))
    held = before.groupBy("partition").agg(
        F.lit(0).cast("long").alias("low"), F.count(F.lit(1)).alias("high")
    )
    return as_text(ranking.assign_offsets(after, held))


@query
def partition_contiguity(inputs: Inputs) -> DataFrame:
    shifted = F.when(F.col("partition") >= 5, F.col("partition") + 1).otherwise(F.col("partition"))
    return ranking.check_partitions(inputs.orders_log().withColumn("partition", shifted))


# ---- aggregations and comparisons


@query
def topic_fingerprint(inputs: Inputs) -> DataFrame:
    digests = records.ranked_digests(inputs.events_log())
    prints = fingerprint(digests, DECLARED, FAN_IN)
    root = root_digest(prints).select(
        F.lit(-1).alias("partition"), F.col("records"), F.col("digest")
    )
    return prints.unionByName(root)


@query
def roundtrip_check_(inputs: Inputs) -> DataFrame:
    left = records.to_archive(inputs.events_log())
    changed = F.when(F.decode("value", "UTF-8").contains("7"), F.lit(b"")).otherwise(
        F.col("value")
    )
    return roundtrip_check(left, left.withColumn("value", changed), FAN_IN)


@query
def archive_differences_(inputs: Inputs) -> DataFrame:
    left = records.to_archive(inputs.events_log())
    changed = F.when(F.decode("value", "UTF-8").contains("7"), F.lit(b"")).otherwise(F.col("value"))
    place = shared_folder(inputs.spark)
    write_archive(left, f"{place}/left", EVENT_PARTITIONS)
    write_archive(left.withColumn("value", changed), f"{place}/right", EVENT_PARTITIONS)
    return archive_differences(inputs.spark, f"{place}/left", f"{place}/right")


@query
def payload_sequence(inputs: Inputs) -> DataFrame:
    """Positions of large records, ranked by tasks of about equal bytes."""
    log = inputs.payload_log()
    plan = placement.layout(log, ranking.offset_stats(log).collect())
    kept = log.withColumn("at", F.col("offset"))
    return placement.placed(kept, plan).select(
        "partition", F.col("at").alias("offset"), "seq", F.octet_length("value").cast("long").alias("n_bytes")
    )


@query
def partition_counts(inputs: Inputs) -> DataFrame:
    rows = inputs.events.select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 16).alias("partition")
    )
    return catalog.partition_counts(rows)


@query
def progress_fold(inputs: Inputs) -> DataFrame:
    return progress.fold_progress(inputs.events_log())


@query
def progress_finish(inputs: Inputs) -> DataFrame:
    log = inputs.events_log()
    before, _ = split(log)
    return progress.finish_progress(
        progress.fold_progress(before), scans.watermarks(log, DECLARED)
    )


@query
def copy_status(inputs: Inputs) -> DataFrame:
    spread = inputs.orders.select(
        F.concat(F.lit("topic-"), F.col("o_custkey").cast("string")).alias("topic"),
        (F.col("o_orderkey") % 4).cast("int").alias("partition"),
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
    )
    key = ["topic", "partition"]
    done = spread.where("o_orderstatus <> 'P'").groupBy(*key)
    done = done.agg((F.max("o_orderkey") + 1).alias("next_offset"))
    failed = spread.where("o_orderpriority like '1%'").groupBy(*key)
    failed = failed.agg(
        F.concat(F.lit("consumer error at "), F.max("o_orderkey").cast("string")).alias("last_error")
    )
    listed = inputs.customer.select(
        F.concat(F.lit("topic-"), F.col("c_custkey").cast("string")).alias("topic"),
        F.explode(F.sequence(F.lit(0), F.lit(3))).alias("partition"),
    )
    return progress.copy_status(done, failed, listed)


# ---- saved state


@query
def state_upsert(inputs: Inputs) -> DataFrame:
    table = inputs.shared("progress")
    traits = inputs.shared("traits")
    managed = traits.where("balance > 0").select(
        F.lit("dest").alias("dest_cluster"), F.col("name").alias("dest_topic")
    )
    moved = table.withColumn("next_offset", F.col("next_offset") + 100)
    snapshot = moved.where("`partition` <> 2")
    return state.upsert_state(table, snapshot, managed)


@query
def state_reset(inputs: Inputs) -> DataFrame:
    declared = inputs.mappings().where("mode = 'clone'")
    return state.reset_state(inputs.shared("progress"), "dest", declared)


@query
def clear_stateless(inputs: Inputs) -> DataFrame:
    return state.clear_stateless(inputs.shared("markers"), "dest", inputs.mappings())


def archive_of_topics(inputs: Inputs) -> DataFrame:
    return (
        inputs.mappings()
        .where("mode = 'restore'")
        .join(inputs.shared("archives").drop("partitions"), "archive")
        .select("name", "archive_digest")
    )


@query
def restore_matches(inputs: Inputs) -> DataFrame:
    return state.restore_done(inputs.live(), inputs.shared("markers"), archive_of_topics(inputs))


@query
def clone_state_mismatch(inputs: Inputs) -> DataFrame:
    return state.clone_mismatch(
        inputs.live(),
        inputs.shared("progress"),
        inputs.shared("markers"),
        inputs.shared("sources"),
    )


@query
def validate_sources(inputs: Inputs) -> DataFrame:
    return state.validate_sources(inputs.shared("progress"), inputs.shared("sources"))


# ---- catalog


@query
def mapping_audit(inputs: Inputs) -> DataFrame:
    raw = inputs.shared("raw_declared")
    modes = F.filter(F.split("modes_text", ","), lambda m: m != "")
    declared = raw.withColumn("modes", modes).withColumn(
        "config", F.create_map(F.col("setting"), F.lit("1"))
    )
    known = inputs.customer.select(
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("instance")
    )
    return mappings.audit_mappings(declared, known)


def wanted(inputs: Inputs) -> DataFrame:
    return catalog.desired(inputs.mappings(), inputs.shared("counts"), inputs.shared("archives"))


def actions(inputs: Inputs) -> DataFrame:
    return catalog.reconcile_actions(
        wanted(inputs),
        inputs.live(),
        inputs.shared("progress"),
        inputs.shared("markers"),
        inputs.shared("sources"),
        archive_of_topics(inputs),
    )


@query
def desired_partitions(inputs: Inputs) -> DataFrame:
    return wanted(inputs).select("name", "mode", "desired_partitions")


@query
def topic_drift(inputs: Inputs) -> DataFrame:
    return catalog.drift(wanted(inputs), inputs.live())


@query
def reconcile_actions(inputs: Inputs) -> DataFrame:
    return actions(inputs).select("name", "mode", "action", "reason")


@query
def preflight(inputs: Inputs) -> DataFrame:
    return catalog.preflight(actions(inputs), force=False)


@query
def apply_actions(inputs: Inputs) -> DataFrame:
    # Used three times: written, as otherwise one stage would hold the joins of all three.
    decided = written(actions(inputs))
    after = catalog.apply_to_catalog(inputs.live(), decided, "dest")
    result = after.withColumn("config_text", settings_text(F.col("config"))).drop("config")
    for column, table in (("progress_rows", "progress"), ("marker_rows", "markers")):
        kept = catalog.apply_to_state(inputs.shared(table), decided, "dest")
        per_topic = kept.groupBy(F.col("dest_topic").alias("name")).agg(
            F.count(F.lit(1)).alias(column)
        )
        result = result.join(per_topic, "name", "left").fillna(0, [column])
    return result


# ---- whole jobs


@query
def dump_job(inputs: Inputs) -> DataFrame:
    log = source_cluster(inputs).import_topic("events", inputs.events_log(), EVENT_PARTITIONS)
    path = f"{shared_folder(inputs.spark)}/events"
    dump(log, path)
    return manifest_rows(inputs.spark, path)


@query
def restore_job(inputs: Inputs) -> DataFrame:
    log = source_cluster(inputs).import_topic("events", inputs.events_log(), EVENT_PARTITIONS)
    path = f"{shared_folder(inputs.spark)}/events"
    dump(log, path)
    dest = dest_cluster(inputs)
    dest.create_topic("copy", EVENT_PARTITIONS)
    for _ in range(2):
        restore(dest, "copy", path)
    marker = dest.markers.read().select(F.col("status").alias("marker"))
    # One marker row for the one topic.
    status = marker.first()["marker"]
    return as_text(dest.topic("copy").scan()).withColumn("marker", F.lit(status))


@query
def clone_bounded(inputs: Inputs) -> DataFrame:
    before, after = split(inputs.events_log())
    source, dest = source_cluster(inputs), dest_cluster(inputs)
    log = source.import_topic("events", before, EVENT_PARTITIONS)
    dest.create_topic("copy", EVENT_PARTITIONS)
    clone(source, "events", dest, "copy")
    log.ingest(after)
    for _ in range(2):
        clone(source, "events", dest, "copy")
    return with_progress(dest)


def with_progress(dest: Cluster) -> DataFrame:
    """Copied rows; each carries the saved progress of its partition."""
    saved = dest.progress.read().select("partition", "next_offset")
    return as_text(dest.topic("copy").scan()).join(saved, "partition")


@query
def clone_continuous(inputs: Inputs) -> DataFrame:
    before, after = split(inputs.events_log())
    source, dest = source_cluster(inputs), dest_cluster(inputs)
    log = source.import_topic("events", before, EVENT_PARTITIONS)
    dest.create_topic("copy", EVENT_PARTITIONS)
    place = shared_folder(inputs.spark)
    for step in range(2):
        finish([clone_stream(source, "events", dest, "copy", f"{place}/c", available_now=True)])
        if step == 0:
            log.ingest(after)
    # A lost checkpoint: everything is read again and nothing is copied twice.
    finish([clone_stream(source, "events", dest, "copy", f"{place}/lost", available_now=True)])
    return with_progress(dest)


@query
def clone_backlog(inputs: Inputs) -> DataFrame:
    """What piled up in five commits is copied in pieces smaller than all of it, by a clone and by a stream."""
    log, source, dest = inputs.events_log(), source_cluster(inputs), dest_cluster(inputs)
    end = log.agg(F.max("offset") + 1).first()[0]
    topic = source.create_topic("events", EVENT_PARTITIONS)
    dest.create_topic("copy", EVENT_PARTITIONS)
    for step in range(5):
        topic.ingest(log.where((F.col("offset") >= end * step // 5) & (F.col("offset") < end * (step + 1) // 5)))
        if step == 1:
            clone(source, "events", dest, "copy", most_bytes=topic.head().total_bytes // 2)
    most = topic.head().total_bytes // 3
    finish([clone_stream(source, "events", dest, "copy", f"{shared_folder(inputs.spark)}/c", available_now=True, most_bytes=most)])
    return with_progress(dest)


@query
def forward_new(inputs: Inputs) -> DataFrame:
    before, after = split(inputs.events_log())
    source, dest = source_cluster(inputs), dest_cluster(inputs)
    log = source.import_topic("events", before, EVENT_PARTITIONS)
    dest.create_topic("copy", EVENT_PARTITIONS)
    ends = log.bounds()
    log.ingest(after)
    place = f"{shared_folder(inputs.spark)}/c"
    for _ in range(2):
        finish([forward(source, "events", dest, "copy", place, ends, available_now=True)])
    return as_text(dest.topic("copy").scan())


def declared_topics(spark: SparkSession, archive: str) -> DataFrame:
    """One topic per mode."""
    config = {"cleanup.policy": "delete"}
    rows = [
        ("ledger", "clone", "primary:orders", None, None, 3, config, False),
        ("pulse", "stream", "primary:events", None, None, None, config, False),
        ("replay", "restore", None, archive, None, None, config, True),
        ("board", "manage", None, None, 3, None, config, False),
        ("blank", "empty", None, None, 3, None, config, True),
    ]
    return spark.createDataFrame(rows, MAPPINGS)


def topic_contents(dest: Cluster) -> DataFrame:
    """(topic, partition, records, high) of every topic and declared partition."""
    result = None
    for topic in dest.catalog.read().orderBy("name").collect():
        log = dest.open(topic)
        held = log.scan().groupBy("partition").agg(F.count(F.lit(1)).alias("records"))
        rows = (
            log.bounds()
            .join(held, "partition", "left")
            .select(
                F.lit(topic["name"]).alias("topic"),
                "partition",
                F.coalesce("records", F.lit(0)).alias("records"),
                "high",
            )
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def _prepared(inputs: Inputs) -> tuple[Cluster, Cluster, DataFrame]:
    source, dest = source_cluster(inputs), dest_cluster(inputs)
    source.import_topic("orders", inputs.orders_log(), ORDER_PARTITIONS)
    before, _ = split(inputs.events_log())
    log = source.import_topic("events", before, EVENT_PARTITIONS)
    archive = f"{shared_folder(inputs.spark)}/events-before"
    dump(log, archive)
    return source, dest, declared_topics(inputs.spark, archive)


@query
def run_all(inputs: Inputs) -> DataFrame:
    source, dest, declared = _prepared(inputs)
    _, after = split(inputs.events_log())
    place = shared_folder(inputs.spark)
    started = run(dest, {"primary": source}, declared, place)
    # The streams took their ends when they started; what arrives now is forwarded.
    source.topic("events").ingest(after)
    try:
        for each in started:
            each.query.processAllAvailable()
    finally:
        for each in started:
            each.query.stop()
    return topic_contents(dest)


@query
def restore_all_(inputs: Inputs) -> DataFrame:
    source, dest, declared = _prepared(inputs)
    _, after = split(inputs.events_log())
    restore_all(dest, {"primary": source}, declared)
    # What arrives now reaches neither the restored topic nor the inactive stream.
    source.topic("events").ingest(after)
    restore_all(dest, {"primary": source}, declared)
    return topic_contents(dest)
