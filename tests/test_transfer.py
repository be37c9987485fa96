"""Logs, dumps, restores, clones and streams, including crashes in between."""

import os

import pytest
from pyspark.sql import functions as F

from logferry.operators import scans
from logferry.operators.digest import roundtrip_check
from logferry.operators.progress import finish_progress
from logferry.plans import transfer
from logferry.plans.run import finish
from logferry.plans.transfer import clone, dump, restore
from logferry.sources import kafka
from logferry.sources.archive import read_archive
from logferry.sources.files import AlreadyPublished, Files
from logferry.sources.topic_log import TopicLog
from logferry.streaming.jobs import clone_stream, forward


def rows_of(log):
    return [
        (r["partition"], r["offset"], r["value"])
        for r in log.scan().orderBy("partition", "offset").collect()
    ]


def test_dump_restore_dump(spark, source, dest, tmp_path):
    headers = [("duplicate", b"one"), ("duplicate", None)]
    schema = "`partition` INT, `offset` BIGINT, timestamp_ms BIGINT, key BINARY, value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
    rows = spark.createDataFrame([(1, 5, 1234, b"key", b"payload", headers)], schema)
    log = source.import_topic("orders", rows, 2)
    first = dump(log, str(tmp_path / "one"))
    dest.create_topic("copy", 2)
    assert restore(dest, "copy", str(tmp_path / "one")) is True
    second = dump(dest.topic("copy"), str(tmp_path / "two"))
    assert first == second
    a, b = (read_archive(spark, str(tmp_path / n)) for n in ("one", "two"))
    assert roundtrip_check(a, b).count() == 0
    kept = dest.topic("copy").scan().first()
    assert (kept["timestamp_ms"], kept["key"], kept["value"]) == (1234, b"key", b"payload")
    assert [tuple(h) for h in kept["headers"]] == headers


def test_dump_of_dense_and_gappy_logs_agree(spark, source, make_log, tmp_path):
    dense = source.import_topic("dense", make_log(*[(0, i, b"%d" % i) for i in range(20)]), 1)
    gappy = source.import_topic("gappy", make_log(*[(0, 9 * i, b"%d" % i) for i in range(20)]), 1)
    assert dump(dense, str(tmp_path / "d")) == dump(gappy, str(tmp_path / "g"))


def test_dump_refuses_an_existing_archive_before_reading(source, make_log, tmp_path):
    log = source.import_topic("t", make_log((0, 0, b"a")), 1)
    dump(log, str(tmp_path / "one"))
    with pytest.raises(AlreadyPublished):
        dump(log, str(tmp_path / "one"))
    dump(log, str(tmp_path / "one"), force=True)


def test_restore_is_done_once(source, dest, make_log, tmp_path):
    log = source.import_topic("t", make_log((0, 0, b"a"), (0, 1, b"b")), 1)
    dump(log, str(tmp_path / "one"))
    dest.create_topic("copy", 1)
    assert restore(dest, "copy", str(tmp_path / "one"))
    # What an application writes afterwards is no drift.
    dest.topic("copy").append(make_log((0, 0, b"later")))
    assert not restore(dest, "copy", str(tmp_path / "one"))
    assert [v for _, _, v in rows_of(dest.topic("copy"))] == [b"a", b"b", b"later"]


def test_interrupted_restore_is_not_trusted(source, dest, make_log, tmp_path, monkeypatch):
    log = source.import_topic("t", make_log((0, 0, b"a")), 1)
    dump(log, str(tmp_path / "one"))
    dest.create_topic("copy", 1)
    real = transfer.mark

    def crash(cluster, topic, digest, status):
        if status == "complete":
            raise RuntimeError("crash")
        real(cluster, topic, digest, status)

    monkeypatch.setattr(transfer, "mark", crash)
    with pytest.raises(RuntimeError, match="crash"):
        restore(dest, "copy", str(tmp_path / "one"))
    monkeypatch.undo()
    assert dest.markers.read().first()["status"] == "in_progress"
    with pytest.raises(ValueError, match="not restored completely"):
        restore(dest, "copy", str(tmp_path / "one"))


def test_restore_needs_the_same_number_of_partitions(source, dest, make_log, tmp_path):
    dump(source.import_topic("t", make_log((0, 0, b"a")), 1), str(tmp_path / "one"))
    dest.create_topic("copy", 2)
    with pytest.raises(ValueError, match="partitions"):
        restore(dest, "copy", str(tmp_path / "one"))


def test_appends_continue_offsets_and_drop_repeated_batches(dest, make_log):
    log = dest.create_topic("t", 2)
    log.append(make_log((0, 10, b"a"), (0, 30, b"b"), (1, 5, b"x")), batch=("q", 0))
    log.append(make_log((0, 10, b"a"), (0, 30, b"b"), (1, 5, b"x")), batch=("q", 0))
    log.append(make_log((0, 7, b"c")), batch=("q", 1))
    assert rows_of(log) == [(0, 0, b"a"), (0, 1, b"b"), (0, 2, b"c"), (1, 0, b"x")]
    assert [tuple(r) for r in log.bounds().orderBy("partition").collect()] == [(0, 0, 3), (1, 0, 1)]


def test_unknown_partitions_are_refused(dest, make_log):
    log = dest.create_topic("t", 1)
    with pytest.raises(ValueError, match="partition 3"):
        log.append(make_log((3, 0, b"a")))
    assert rows_of(log) == []


def test_second_claim_of_a_commit_fails(spark, dest, make_log, monkeypatch):
    log = dest.create_topic("t", 1)
    stale = log.head()
    log.append(make_log((0, 0, b"first")))
    late = TopicLog(spark, log.path, 1)
    monkeypatch.setattr(late, "head", lambda: stale)
    with pytest.raises(AlreadyPublished):
        late.append(make_log((0, 0, b"second")))
    assert rows_of(log) == [(0, 0, b"first")]
    assert os.listdir(f"{log.path}/staging") == []


def test_crash_before_publishing_is_invisible(dest, make_log, monkeypatch):
    log = dest.create_topic("t", 1)
    log.append(make_log((0, 0, b"a")))

    def crash(staged, new):
        raise RuntimeError("crash")

    monkeypatch.setattr(log, "_publish", crash)
    with pytest.raises(RuntimeError):
        log.append(make_log((0, 0, b"b")))
    monkeypatch.undo()
    assert rows_of(log) == [(0, 0, b"a")]
    log.append(make_log((0, 0, b"c")))
    assert rows_of(log) == [(0, 0, b"a"), (0, 1, b"c")]


def test_ingest_refuses_taken_offsets(source, make_log):
    log = source.import_topic("t", make_log((0, 0, b"a"), (0, 9, b"b")), 1)
    with pytest.raises(ValueError, match="already taken"):
        log.ingest(make_log((0, 9, b"c")))


def test_clone_in_pieces_equals_clone_in_one(source, dest, make_log):
    log = source.import_topic("t", make_log((0, 3, b"a"), (1, 4, None)), 2)
    dest.create_topic("pieces", 2)
    clone(source, "t", dest, "pieces")
    log.ingest(make_log((0, 11, b"b"), (1, 6, b"d")))
    clone(source, "t", dest, "pieces")
    clone(source, "t", dest, "pieces")
    dest.create_topic("whole", 2)
    clone(source, "t", dest, "whole")
    assert rows_of(dest.topic("pieces")) == rows_of(dest.topic("whole"))
    saved = dest.progress.read().where("dest_topic = 'pieces'").orderBy("partition").collect()
    assert [r["next_offset"] for r in saved] == [12, 7]


def test_progress_reaches_an_end_without_records(source, dest, make_log):
    source.import_topic("t", make_log((0, 3, b"a")), 2, high={0: 9, 1: 5})
    dest.create_topic("copy", 2)
    head = clone(source, "t", dest, "copy")
    assert head.copied[source.describe("t")["topic_id"]] == {0: 9, 1: 5}
    again = clone(source, "t", dest, "copy")
    assert again.commit == head.commit


def test_crash_between_commit_and_progress_table(source, dest, make_log, monkeypatch):
    source.import_topic("t", make_log((0, 0, b"a"), (0, 1, b"b")), 1)
    dest.create_topic("copy", 1)

    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(transfer, "save_progress", crash)
    with pytest.raises(RuntimeError):
        clone(source, "t", dest, "copy")
    monkeypatch.undo()
    assert dest.progress.read().count() == 0
    clone(source, "t", dest, "copy")
    assert [v for _, _, v in rows_of(dest.topic("copy"))] == [b"a", b"b"]
    assert dest.progress.read().first()["next_offset"] == 2


def test_clone_refuses_a_topic_filled_from_elsewhere(source, dest, make_log):
    source.import_topic("t", make_log((0, 0, b"a")), 1)
    dest.create_topic("copy", 1).append(make_log((0, 0, b"other")))
    with pytest.raises(transfer.Untrusted):
        clone(source, "t", dest, "copy")


def test_saved_offset_beyond_the_captured_end(spark, make_log):
    log = make_log((0, 0, b"a"))
    saved = spark.createDataFrame([(0, 5)], "`partition` INT, next_offset BIGINT")
    with pytest.raises(scans.BeyondEnd, match="saved offset 5 .* 1 for partition 0"):
        scans.resume_scan(log, saved, scans.watermarks(log, 1))


def test_start_offsets(spark, make_log):
    log = make_log(*[(p, o, b"v") for p in (0, 1) for o in range(5)])
    saved = spark.createDataFrame([(0, 3), (1, None)], "`partition` INT, next_offset BIGINT")
    got = scans.resume_scan(log, saved, scans.watermarks(log, 2)).groupBy("partition").count()
    assert {r["partition"]: r["count"] for r in got.collect()} == {0: 2, 1: 5}


@pytest.mark.parametrize("partitions", [4, 100])
def test_bounded_scan_by_predicate_and_by_join(spark, partitions):
    rows = spark.range(3_000).select(
        (F.col("id") % partitions).cast("int").alias("partition"),
        F.expr(f"id div {partitions}").alias("offset"),
        *[F.lit(None).cast(t).alias(n) for n, t in (
            ("timestamp_ms", "long"), ("key", "binary"), ("value", "binary"))],
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
    bounds = spark.range(partitions).select(
        F.col("id").cast("int").alias("partition"), F.lit(2).cast("long").alias("low"),
        (F.col("id") % 3 * 4).alias("high"),
    )
    got = scans.bounded_scan(rows, bounds).collect()
    full = -(-3_000 // partitions)
    expected = {
        (p, o) for p in range(partitions) for o in range(2, min(p % 3 * 4, full))
        if o * partitions + p < 3_000
    }
    assert {(r["partition"], r["offset"]) for r in got} == expected
    assert len(got) == len(expected)


def test_more_ranges_than_the_driver_takes(spark, make_log, monkeypatch):
    log = make_log((0, 0, b"a"), (0, 5, b"b"), (1, 0, b"c"))
    bounds = spark.createDataFrame([(0, 0, 5), (1, 0, 1)], "`partition` INT, low BIGINT, high BIGINT")
    monkeypatch.setattr(scans, "local_rows", lambda df: None)
    assert {r["value"] for r in scans.bounded_scan(log, bounds).collect()} == {b"a", b"c"}


def test_bounds_reach_the_parquet_scan(spark, source, make_log):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    log = source.import_topic("t", make_log(*[(0, i, b"v") for i in range(10)]), 1)
    plan = scans.bounded_scan(log.scan(upto=1), log.bounds())._jdf.queryExecution().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][-1]
    assert "GreaterThanOrEqual(offset,0)" in pushed and "LessThan(offset,10)" in pushed
    assert "PartitionFilters: [isnotnull(commit" in pushed
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_covered_commits_are_left_out(source, dest, make_log):
    log = source.import_topic("t", make_log((0, 0, b"a"), (1, 0, b"b")), 2)
    for step in range(1, 6):
        log.ingest(make_log((step % 2, step * 10, b"c")))
    assert log.head().commit == 6
    assert log.covered({}) == 0
    assert log.covered({0: 1, 1: 1}) == 1
    assert log.covered({0: 21, 1: 10}) == 1
    assert log.covered({0: 21, 1: 12}) == 3
    assert log.covered({0: 1_000, 1: 1_000}) == 6
    assert log.scan(after=3).count() == 3
    assert log.scan(after=3, upto=4).count() == 1
    assert log.stream(after=3)._jdf.queryExecution().toString().count("commit") > 1


def test_last_number(spark, tmp_path):
    files = Files(spark)
    for n in range(1, 12):
        assert files.last(str(tmp_path), "commit") == n - 1
        (tmp_path / f"commit={n}").mkdir()


def test_finish_never_lowers(spark):
    saved = spark.createDataFrame([(0, 9), (1, None)], "`partition` INT, next_offset BIGINT")
    ends = spark.createDataFrame([(0, 0, 5), (1, 0, 5), (2, 0, 0)], "`partition` INT, low BIGINT, high BIGINT")
    got = finish_progress(saved, ends).orderBy("partition").collect()
    assert [r["next_offset"] for r in got] == [9, 5, 0]


def test_forward_skips_what_exists(spark, source, dest, make_log, tmp_path):
    log = source.import_topic("t", make_log((0, 0, b"before")), 1)
    dest.create_topic("copy", 1)
    ends = log.bounds()
    log.ingest(make_log((0, 1, b"after")))
    for _ in range(2):
        finish([forward(source, "t", dest, "copy", str(tmp_path / "c"), ends, available_now=True)])
    assert rows_of(dest.topic("copy")) == [(0, 0, b"after")]
    # Started again with the same folder, the run goes on from the end it captured first.
    log.ingest(make_log((0, 2, b"more")))
    finish([forward(source, "t", dest, "copy", str(tmp_path / "c"), available_now=True)])
    assert [v for _, _, v in rows_of(dest.topic("copy"))] == [b"after", b"more"]
    # A new run starts at the end it finds.
    finish([forward(source, "t", dest, "copy", str(tmp_path / "new"), available_now=True)])
    assert len(rows_of(dest.topic("copy"))) == 2


def test_stream_clone_survives_a_crash_after_the_commit(source, dest, make_log, tmp_path, monkeypatch):
    from logferry.streaming import jobs

    source.import_topic("t", make_log((0, 0, b"a"), (0, 1, b"b")), 1)
    dest.create_topic("copy", 1)

    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(jobs, "save_progress", crash)
    place = str(tmp_path / "c")
    with pytest.raises(Exception, match="crash"):
        finish([clone_stream(source, "t", dest, "copy", place, available_now=True)])
    monkeypatch.undo()
    finish([clone_stream(source, "t", dest, "copy", place, available_now=True)])
    assert [v for _, _, v in rows_of(dest.topic("copy"))] == [b"a", b"b"]
    assert dest.progress.read().first()["next_offset"] == 2


def test_batch_clone_and_stream_clone_continue_each_other(source, dest, make_log, tmp_path):
    log = source.import_topic("t", make_log((0, 0, b"a")), 1)
    dest.create_topic("copy", 1)
    clone(source, "t", dest, "copy")
    log.ingest(make_log((0, 4, b"b")))
    finish([clone_stream(source, "t", dest, "copy", str(tmp_path / "c"), available_now=True)])
    log.ingest(make_log((0, 8, b"c")))
    clone(source, "t", dest, "copy")
    finish([clone_stream(source, "t", dest, "copy", str(tmp_path / "c"), available_now=True)])
    assert [v for _, _, v in rows_of(dest.topic("copy"))] == [b"a", b"b", b"c"]


def test_kafka_adapter_without_a_broker(make_log):
    log = make_log((0, 0, b"a"))
    with pytest.raises(ValueError, match="timestamp_policy"):
        kafka.sink_rows(log, "t")
    assert kafka.sink_rows(log, "t", "broker").columns == ["topic", "partition", "key", "value", "headers"]
    text = kafka.offsets_json("t", [{"partition": 1, "high": 7}], "high")
    assert text == '{"t": {"1": 7}}'
