"""Saved state, declarations and reconciliation."""

import threading

import pytest
from pyspark.sql import functions as F

from checks.jobs import QUERIES
from logferry.operators import catalog, mappings, state
from logferry.plans.run import (
    BadMappings,
    finish_copies,
    reconcile,
    restore_all,
    run,
    status,
)
from logferry.plans.transfer import dump
from logferry.schemas import CATALOG, MAPPINGS, MARKERS, PROGRESS
from tests.conftest import FOLDER

SOURCE = ("source-cluster", "source", "source-topic-id")
DEST = ("dest-cluster", "destination")


def progress_row(topic_id="destination-topic-id", source=SOURCE, name="destination", offset=42):
    return (DEST[0], name, topic_id, *source, 0, offset)


@pytest.fixture
def tables(spark):
    def build(progress=(), markers=()):
        return (
            spark.createDataFrame(list(progress), PROGRESS),
            spark.createDataFrame(list(markers), MARKERS),
        )

    return build


@pytest.fixture
def live(spark):
    row = ("destination", "destination-topic-id", 1, 1, 1, {})
    return spark.createDataFrame([row], CATALOG)


@pytest.mark.parametrize(
    "saved, expected",
    [
        ([], "existing clone topic has no trusted state"),
        ([progress_row("old-destination-id")], "UUID"),
        ([progress_row()], None),
        ([progress_row(source=SOURCE[:2] + ("replacement-source-id",))], "source identity"),
        ([progress_row(offset=None)], None),
    ],
)
def test_clone_state(spark, tables, live, saved, expected):
    rows, markers = tables(saved)
    sources = spark.createDataFrame(
        [("destination", *SOURCE)],
        "name STRING, source_cluster STRING, source_topic STRING, source_topic_id STRING",
    )
    reason = state.clone_mismatch(live, rows, markers, sources).first()["reason"]
    assert reason is None if expected is None else expected in reason


def test_clone_state_of_another_mode(spark, tables, live):
    rows, markers = tables(markers=[(*DEST, "destination-topic-id", "d", 1, "complete")])
    sources = spark.createDataFrame(
        [("destination", *SOURCE)],
        "name STRING, source_cluster STRING, source_topic STRING, source_topic_id STRING",
    )
    got = state.clone_mismatch(live, rows, markers, sources).first()["reason"]
    assert "different data mode" in got


@pytest.mark.parametrize(
    "marker, expected",
    [
        (("destination-topic-id", "hash", 1, "in_progress"), False),
        (("destination-topic-id", "hash", 1, "complete"), True),
        (("other-topic-id", "hash", 1, "complete"), False),
        (("destination-topic-id", "other", 1, "complete"), False),
        (("destination-topic-id", "hash", 2, "complete"), False),
        (None, False),
    ],
)
def test_restore_marker(spark, tables, live, marker, expected):
    _, markers = tables(markers=[(*DEST, *marker)] if marker else [])
    archives = spark.createDataFrame([("destination", "hash")], "name STRING, archive_digest STRING")
    assert state.restore_done(live, markers, archives).first()["restored"] is expected


def test_two_jobs_share_one_table(spark, dest, tables):
    def save(name):
        rows, _ = tables([progress_row(name=name)])
        managed = rows.select("dest_cluster", "dest_topic")
        dest.progress.update(lambda current: state.upsert_state(current, rows, managed))

    threads = [threading.Thread(target=save, args=(n,)) for n in ("a", "b", "c")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert {r["dest_topic"] for r in dest.progress.read().collect()} == {"a", "b", "c"}


def test_upsert_removes_what_the_job_no_longer_holds(tables):
    table, _ = tables([progress_row(name="a"), progress_row(name="b"), progress_row(name="c")])
    snapshot, _ = tables([progress_row(name="a", offset=99), progress_row(name="c", offset=1)])
    managed = table.where("dest_topic in ('a', 'b')").select("dest_cluster", "dest_topic")
    got = state.upsert_state(table, snapshot, managed).collect()
    assert {(r["dest_topic"], r["next_offset"]) for r in got} == {("a", 99), ("c", 42)}


def test_reset(spark, tables):
    table, _ = tables([progress_row(name="a"), progress_row(name="b"), progress_row(name="c")])
    declared = spark.createDataFrame([("a",), ("b",)], "name STRING")
    left = state.reset_state(table, DEST[0], declared, ["a"])
    assert {r["dest_topic"] for r in left.collect()} == {"b", "c"}
    left = state.reset_state(table, DEST[0], declared)
    assert {r["dest_topic"] for r in left.collect()} == {"c"}
    with pytest.raises(state.UndeclaredTopic):
        state.reset_state(table, DEST[0], declared, ["c"])


@pytest.mark.parametrize(
    "exists, reason, expected",
    [
        (False, "stale state", "create"),
        (True, "config drift", "recreate"),
        (True, None, "none"),
        (True, "configured empty topic must be recreated", "recreate"),
    ],
)
def test_decisions(spark, exists, reason, expected):
    row = spark.createDataFrame([(exists, reason)], "e BOOLEAN, r STRING")
    assert row.select(catalog.decide(F.col("e"), F.col("r"))).first()[0] == expected


@pytest.mark.parametrize(
    "run_force, topic_force, blocked",
    [(False, False, 1), (True, False, 0), (False, True, 0), (True, True, 0), (False, None, 1)],
)
def test_force(spark, run_force, topic_force, blocked):
    rows = spark.createDataFrame(
        [("t", topic_force, "recreate", "why"), ("u", False, "create", None), ("v", False, "none", None)],
        "name STRING, force BOOLEAN, action STRING, reason STRING",
    )
    assert catalog.preflight(rows, run_force).count() == blocked


def declared(spark, *rows):
    return spark.createDataFrame([dict(zip(FIELDS, r)) for r in rows], DECLARED)


FIELDS = ["name", "modes", "source_ref", "archive", "partitions", "replication_factor", "config"]
DECLARED = (
    "name STRING, modes ARRAY<STRING>, source_ref STRING, archive STRING, partitions INT, "
    "replication_factor INT, config MAP<STRING, STRING>"
)
MODES = ["manage", "empty", "clone", "stream", "restore"]


def audit(spark, *rows):
    known = spark.createDataFrame([("primary",)], "instance STRING")
    got = mappings.audit_mappings(declared(spark, *rows), known).collect()
    return sorted((r["name"], r["violation"]) for r in got)


def test_exactly_one_mode(spark):
    pairs = [[a, b] for i, a in enumerate(MODES) for b in MODES[i + 1 :]] + [[]]
    rows = [(f"t{i}", modes, "primary:x", "a", 1, 1, {}) for i, modes in enumerate(pairs)]
    found = audit(spark, *rows)
    assert found == sorted((f"t{i}", "not exactly one mode") for i in range(len(pairs)))


def test_valid_declarations(spark):
    assert audit(
        spark,
        ("orders.v1.backup", ["clone"], "primary:orders.v1", None, None, 3, {"cleanup.policy": "compact"}),
        ("payments.v1.live", ["stream"], "primary:payments:v1", None, None, None, {}),
        ("orders.v1.restored", ["restore"], None, "orders", None, None, {}),
        ("again.restored", ["restore"], None, "orders", None, None, {}),
        ("supplier.notes", ["manage"], None, None, 3, None, None),
        ("part.counts", ["empty"], None, None, 3, None, {}),
    ) == []


def test_faults(spark):
    found = audit(
        spark,
        ("a", ["clone"], "primary:x", None, None, 0, {}),
        ("b", ["stream"], "primary:x", None, None, None, {}),
        ("c", ["clone"], "no-colon", None, None, None, {}),
        ("d", ["clone"], ":x", None, None, None, {}),
        ("e", ["clone"], "primary:", None, None, None, {}),
        ("f", ["clone"], "other:x", None, None, None, {}),
        ("g", ["manage"], None, None, 0, None, {"message.timestamp.type": "x"}),
        ("h", ["empty"], None, None, None, None, {}),
        ("h", ["restore"], None, "", None, None, {}),
        (" ", ["manage"], None, None, 1, None, {}),
    )
    assert found == sorted([
        ("a", "replication not positive"),
        ("a", "source feeds several destinations"),
        ("b", "source feeds several destinations"),
        ("c", "malformed source"),
        ("d", "malformed source"),
        ("e", "malformed source"),
        ("f", "unknown source"),
        ("g", "partitions not positive"),
        ("g", "reserved setting"),
        ("h", "duplicate destination"),
        ("h", "missing archive"),
        ("h", "partitions not positive"),
        (" ", "blank name"),
    ])


def test_drift_order(spark):
    stamp = {"message.timestamp.type": "CreateTime"}
    wanted = spark.createDataFrame(
        [
            ("shape", 2, 3, {"a": "1"}),
            ("replication", 1, 3, {"a": "1"}),
            ("undeclared replication", 1, None, {}),
            ("stamp", 1, None, {}),
            ("settings", 1, None, {"b": "1", "a": "1"}),
            ("null config", 1, None, None),
        ],
        "name STRING, desired_partitions INT, replication_factor INT, config MAP<STRING, STRING>",
    )
    now = spark.createDataFrame(
        [
            ("shape", "", 1, 1, 1, {}),
            ("replication", "", 1, 1, 1, {}),
            ("undeclared replication", "", 1, 1, 9, {**stamp, "other": "x"}),
            ("stamp", "", 1, 1, 1, {"message.timestamp.type": "LogAppendTime"}),
            ("settings", "", 1, 1, 1, stamp),
            ("null config", "", 1, 1, 1, stamp),
        ],
        CATALOG,
    )
    got = {r["name"]: r["reason"] for r in catalog.drift(wanted, now).collect()}
    assert got == {
        "shape": "partition count is 1 but expected 2",
        "replication": "replication factor is 1 but expected 3",
        "undeclared replication": None,
        "stamp": "config message.timestamp.type is LogAppendTime but expected CreateTime",
        "settings": "config a is not set but expected 1",
        "null config": None,
    }


def topic_rows(spark, *rows):
    return spark.createDataFrame(list(rows), MAPPINGS)


def test_blocked_run_changes_nothing(spark, source, dest, make_log, tmp_path):
    source.import_topic("in", make_log((0, 0, b"a")), 1)
    dest.create_topic("busy", 2).append(make_log((0, 0, b"keep")))
    before = dest.catalog.read().collect()
    declared = topic_rows(
        spark,
        ("new", "clone", "primary:in", None, None, None, {}, False),
        ("busy", "manage", None, None, 5, None, {}, False),
    )
    with pytest.raises(catalog.RecreationRefused, match="busy: partition count is 2 but expected 5"):
        restore_all(dest, {"primary": source}, declared)
    assert dest.catalog.read().collect() == before
    assert dest.topic("busy").scan().count() == 1
    restore_all(dest, {"primary": source}, declared, force=True)
    assert dest.topic("busy").partitions == 5
    assert dest.topic("busy").scan().count() == 0
    assert dest.topic("new").scan().count() == 1


def test_restore_all_modes(spark, source, dest, make_log, tmp_path):
    source.import_topic("in", make_log((0, 0, b"a"), (1, 3, b"b")), 2)
    source.import_topic("live", make_log((0, 0, b"x")), 1)
    archive = str(tmp_path / "archive")
    dump(source.topic("in"), archive)
    declared = topic_rows(
        spark,
        ("cloned", "clone", "primary:in", None, None, None, {"cleanup.policy": "compact"}, False),
        ("streamed", "stream", "primary:live", None, None, None, {}, False),
        ("restored", "restore", None, archive, None, None, {}, False),
        ("managed", "manage", None, None, 3, 2, {}, False),
        ("emptied", "empty", None, None, 3, None, {}, True),
    )
    restore_all(dest, {"primary": source}, declared)
    dest.topic("managed").append(make_log((0, 0, b"mine")))
    dest.topic("emptied").append(make_log((0, 0, b"mine")))
    first = {r["name"]: r for r in dest.catalog.read().collect()}
    restore_all(dest, {"primary": source}, declared)
    second = {r["name"]: r for r in dest.catalog.read().collect()}
    held = {n: dest.topic(n).scan().count() for n in second}
    assert held == {"cloned": 2, "streamed": 0, "restored": 2, "managed": 1, "emptied": 0}
    changed = {n for n in second if first[n]["topic_id"] != second[n]["topic_id"]}
    assert changed == {"emptied"}
    assert second["emptied"]["generation"] == 2
    assert second["managed"]["replication_factor"] == 2
    assert {r["dest_topic"] for r in dest.progress.read().collect()} == {"cloned"}
    assert {r["dest_topic"] for r in dest.markers.read().collect()} == {"restored"}


def test_every_recreation_has_a_new_identity(spark, source, dest):
    declared = topic_rows(spark, ("t", "empty", None, None, 6, None, {}, True))
    seen = set()
    for _ in range(4):
        reconcile(dest, {}, declared)
        seen.add(dest.describe("t")["topic_id"])
    assert len(seen) == 4


def test_reset_state_needs_force_afterwards(spark, source, dest, make_log):
    source.import_topic("in", make_log((0, 0, b"a")), 1)
    declared = topic_rows(spark, ("copy", "clone", "primary:in", None, None, None, {}, False))
    restore_all(dest, {"primary": source}, declared)
    dest.progress.update(lambda t: state.reset_state(t, dest.cluster_id, declared))
    with pytest.raises(catalog.RecreationRefused, match="no trusted state"):
        restore_all(dest, {"primary": source}, declared)
    restore_all(dest, {"primary": source}, declared, force=True)
    assert dest.topic("copy").scan().count() == 1


def test_run_needs_something_to_copy(spark, source, dest, tmp_path):
    declared = topic_rows(spark, ("t", "manage", None, None, 1, None, {}, False))
    with pytest.raises(BadMappings):
        run(dest, {"primary": source}, declared, str(tmp_path / "c"))


def test_missing_source_topic(spark, source, dest):
    declared = topic_rows(spark, ("t", "stream", "primary:gone", None, None, None, {}, False))
    with pytest.raises(BadMappings, match="does not exist"):
        reconcile(dest, {"primary": source}, declared)


def test_run_copies_both_kinds(spark, source, dest, make_log, tmp_path):
    source.import_topic("in", make_log((0, 0, b"a")), 1)
    live = source.import_topic("live", make_log((0, 0, b"old")), 1)
    declared = topic_rows(
        spark,
        ("cloned", "clone", "primary:in", None, None, None, {}, False),
        ("streamed", "stream", "primary:live", None, None, None, {}, False),
    )
    started = run(dest, {"primary": source}, declared, str(tmp_path / "c"))
    try:
        live.ingest(make_log((0, 1, b"new")))
        for copy in started:
            copy.query.processAllAvailable()
        lines = [tuple(r) for r in status(dest, started).collect()]
    finally:
        for copy in started:
            copy.query.stop()
    assert lines == [("cloned", 0, 1, "ok", None), ("streamed", 0, 2, "ok", None)]
    assert [r["value"] for r in dest.topic("cloned").scan().collect()] == [b"a"]
    assert [r["value"] for r in dest.topic("streamed").scan().collect()] == [b"new"]


def test_first_failure_stops_all(spark, source, dest, make_log, tmp_path):
    source.import_topic("in", make_log((0, 0, b"a")), 1)
    other = source.import_topic("other", make_log((0, 0, b"b")), 1)
    declared = topic_rows(
        spark,
        ("good", "clone", "primary:in", None, None, None, {}, False),
        ("bad", "clone", "primary:other", None, None, None, {}, False),
    )
    started = run(dest, {"primary": source}, declared, str(tmp_path / "c"))
    for copy in started:
        copy.query.processAllAvailable()
    # Somebody else writes to the destination; the next batch must not be appended.
    dest.topic("bad").append(make_log((0, 0, b"intruder")), copied=("elsewhere", {0: 1}))
    other.ingest(make_log((0, 1, b"c")))
    with pytest.raises(Exception, match="source identity"):
        finish_copies(started)
    assert not any(c.query.isActive for c in started)
    lines = {r["topic"]: r for r in status(dest, started).collect()}
    assert (lines["bad"]["status"], lines["good"]["status"]) == ("error", "ok")
    assert "source identity" in lines["bad"]["last_error"]


def test_changed_topics_and_undeclared_ones(spark):
    shape = "name STRING, action STRING, desired_partitions INT, replication_factor INT, config MAP<STRING, STRING>"
    before = spark.createDataFrame(
        [("kept", "a", 2, 1, 1, {"x": "1"}), ("rebuilt", "b", 4, 2, 2, {"y": "2"}), ("undeclared", "c", 1, 1, 1, None)], CATALOG
    )
    actions = spark.createDataFrame(
        [("kept", "none", 9, 9, {}), ("rebuilt", "recreate", 3, None, None), ("new", "create", 5, 6, {"z": "3"})], shape
    )
    after = {r["name"]: r for r in catalog.apply_to_catalog(before, actions, "c").collect()}
    stamp = {"message.timestamp.type": "CreateTime"}
    assert set(after) == {"kept", "rebuilt", "undeclared", "new"}
    assert tuple(after["kept"]) == ("kept", "a", 2, 1, 1, {"x": "1"})
    assert tuple(after["undeclared"]) == ("undeclared", "c", 1, 1, 1, None)
    assert tuple(after["rebuilt"])[2:] == (5, 3, 1, stamp) and len({after[n]["topic_id"] for n in after}) == 4
    assert tuple(after["new"])[2:] == (1, 5, 6, {"z": "3"} | stamp)


def test_decisions_are_made_once(spark):
    # Each join holds rows of both sides until its task ends: decisions made again for each use add up in one stage.
    plan = QUERIES["apply_actions"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") < 12


def test_stored_decisions_are_not_broadcast(spark, tmp_path):
    live_rows = spark.range(100).selectExpr(
        "cast(id AS STRING) AS name", "'i' AS topic_id", "1 AS generation", "1 AS partitions", "1 AS replication_factor",
        "cast(map() AS map<string,string>) AS config",
    )
    shapes = live_rows.selectExpr("name", "'create' AS action", "1 AS desired_partitions", "replication_factor", "config")
    shapes.write.parquet(str(tmp_path / "actions"))
    actions = spark.read.parquet(str(tmp_path / "actions"))
    state_rows = live_rows.selectExpr("'c' AS dest_cluster", "name AS dest_topic")
    for after in (catalog.apply_to_catalog(live_rows, actions, "c"), catalog.apply_to_state(state_rows, actions, "c")):
        assert "Broadcast" not in after._jdf.queryExecution().sparkPlan().toString()
