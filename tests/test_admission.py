"""Backlogs in pieces, outages, sources of another kind, and runs that continue."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from logferry.operators.scans import BeyondEnd, bounded_scan
from logferry.plans import transfer
from logferry.plans.run import finish, run, status
from logferry.plans.transfer import Untrusted, clone, dump
from logferry.schemas import MAPPINGS
from logferry.sources import kafka, topic_log
from logferry.sources.archive import read_archive
from logferry.sources.kafka import KafkaCluster
from logferry.sources.source import cut_evenly, ranges
from logferry.sources.topic_log import TopicLog
from logferry.streaming import jobs
from logferry.streaming.jobs import clone_stream, forward
from logferry.streaming.scans import stream_from_progress
from tests.test_transfer import rows_of


@pytest.fixture
def backlog(source, make_log):
    """Twelve commits of two partitions, of which the last is larger than the others together."""
    log = source.import_topic("t", make_log((0, 0, b"v0"), (1, 0, b"w0")), 2)
    for n in range(1, 11):
        log.ingest(make_log((n % 2, 10 * n, b"v%d" % n)))
    log.ingest(make_log(*[(p, 200 + k, b"%04d" % (k * 7919 % 10_007) * 40) for p in (0, 1) for k in range(300)]))
    return log


def sizes(log):
    totals = [log.at(n).total_bytes for n in range(log.head().commit + 1)]
    return [b - a for a, b in zip(totals, totals[1:])]


def test_ranges_of_commits_go_by_bytes(backlog):
    each = sizes(backlog)
    assert all(s > 0 for s in each) and each[-1] > 2 * max(each[:-1])
    most = 3 * max(each[:-1])
    found = list(backlog.commit_ranges(0, 12, most))
    assert found[0][0] == 0 and found[-1][1] == 12 and all(a[1] == b[0] for a, b in zip(found, found[1:]))
    assert all(held == sum(each[after:upto]) for after, upto, held in found)
    assert all(held <= most or upto - after == 1 for after, upto, held in found) and 4 <= len(found) <= 6
    assert list(backlog.commit_ranges(4, 4, 1)) == [] and len(list(backlog.commit_ranges(0, 12, 1))) == 12


def test_offsets_are_cut_evenly():
    assert list(cut_evenly({0: 3}, {0: 9, 1: 4}, 2)) == [({0: 3, 1: 0}, {0: 6, 1: 2}), ({0: 6, 1: 2}, {0: 9, 1: 4})]
    assert list(cut_evenly({0: 9}, {0: 9}, 3)) == [({0: 9}, {0: 9})]
    # Progress beyond an end is not taken back.
    assert list(cut_evenly({0: 9}, {0: 5}, 1)) == [({0: 5}, {0: 5})]


@pytest.mark.parametrize("most_bytes", [6_000, 1 << 40])
def test_a_backlog_is_cloned_in_pieces(backlog, source, dest, most_bytes):
    dest.create_topic("copy", 2)
    head = clone(source, "t", dest, "copy", most_bytes=most_bytes)
    assert [r[2] for r in rows_of(dest.topic("copy"))] == [r[2] for r in rows_of(backlog)]
    assert head.copied[backlog_id(source)] == {0: 500, 1: 500}
    assert head.commit == 1 if most_bytes > 1 << 30 else head.commit > 4
    assert clone(source, "t", dest, "copy", most_bytes=most_bytes).commit == head.commit


def backlog_id(source):
    return source.describe("t")["topic_id"]


def failing_appends(monkeypatch, failures):
    """Appends of which the numbered ones fail: before they publish, or right after."""
    real, calls = TopicLog.append, []

    def append(self, rows, **more):
        calls.append(1)
        if failures.get(len(calls)) == "before":
            raise OSError("no space")
        out = real(self, rows, **more)
        if failures.get(len(calls)) == "after":
            raise OSError("connection lost")
        return out

    monkeypatch.setattr(TopicLog, "append", append)
    return calls


def test_a_failure_redoes_one_piece(backlog, source, dest, tmp_path, monkeypatch):
    dest.create_topic("copy", 2)
    calls = failing_appends(monkeypatch, {3: "before"})
    place = str(tmp_path / "c")
    with pytest.raises(Exception, match="no space"):
        finish([clone_stream(source, "t", dest, "copy", place, available_now=True, most_bytes=6_000)])
    done = dest.topic("copy").head()
    assert done.commit == 2 and dest.progress.read().where("next_offset > 0").count() > 0
    finish([clone_stream(source, "t", dest, "copy", place, available_now=True, most_bytes=6_000)])
    monkeypatch.undo()
    assert [r[2] for r in rows_of(dest.topic("copy"))] == [r[2] for r in rows_of(backlog)]
    assert len(calls) == dest.topic("copy").head().commit + 1


@pytest.mark.parametrize("failures", [{1: "before", 2: "before"}, {2: "after", 3: "after"}])
def test_an_outage_is_waited_through(backlog, source, dest, tmp_path, monkeypatch, failures):
    monkeypatch.setattr(jobs, "FIRST_WAIT", 0.01)
    ends = backlog.bounds().withColumn("high", F.lit(0).cast("long"))
    for name, start in (("cloned", clone_stream), ("sent", forward)):
        dest.create_topic(name, 2)
        more = {"bounds": ends} if start is forward else {}
        failing_appends(monkeypatch, failures)
        finish([start(source, "t", dest, name, str(tmp_path / name), available_now=True, most_bytes=6_000, patience=60, **more)])
        monkeypatch.undo()
        monkeypatch.setattr(jobs, "FIRST_WAIT", 0.01)
        assert [r[2] for r in rows_of(dest.topic(name))] == [r[2] for r in rows_of(backlog)]


def test_status_of_a_copy_that_goes_on(spark, source, dest, make_log, tmp_path, monkeypatch):
    """One partition's piece fails: its error shows while the copy waits, and goes when it succeeds."""
    monkeypatch.setattr(jobs, "FIRST_WAIT", 0.2)
    log = source.import_topic("t", make_log((0, 0, b"a")), 2)
    config = spark.createDataFrame([("copy", "clone", "one:t", None, None, None, None, False)], MAPPINGS)
    failing, real = [True], TopicLog.append

    def append(self, rows, **more):
        if failing[0] and self.head().commit:
            raise OSError("broker away")
        return real(self, rows, **more)

    monkeypatch.setattr(TopicLog, "append", append)
    copies = run(dest, {"one": source}, config, str(tmp_path / "c"), patience=120)
    try:
        copies[0].query.processAllAvailable()
        log.ingest(make_log((1, 0, b"b"), (1, 1, b"c")))
        until = time.monotonic() + 60
        while not copies[0].figures.last_error and time.monotonic() < until:
            time.sleep(0.1)
        lines = [tuple(r) for r in status(dest, copies).collect()]
        assert lines[0] == ("copy", 0, 1, "ok", None) and lines[1][:4] == ("copy", 1, 0, "error") and "broker away" in lines[1][4]
        assert copies[0].query.isActive
        failing[0] = False
        copies[0].query.processAllAvailable()
        assert [tuple(r)[1:4] for r in status(dest, copies).collect()] == [(0, 1, "ok"), (1, 2, "ok")]
        assert copies[0].figures.next_offset == {0: 1, 1: 2} and copies[0].figures.records == 3 and copies[0].figures.pieces == 2
    finally:
        copies[0].query.stop()


def test_patience_ends(backlog, source, dest, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "FIRST_WAIT", 0.01)
    dest.create_topic("copy", 2)
    failing_appends(monkeypatch, {n: "before" for n in range(1, 1_000)})
    with pytest.raises(Exception, match="no space"):
        finish([clone_stream(source, "t", dest, "copy", str(tmp_path / "c"), available_now=True, patience=0.3)])


def test_a_stream_reads_no_record_of_what_it_has(backlog, source, dest, tmp_path):
    dest.create_topic("copy", 2)
    clone(source, "t", dest, "copy")
    assert backlog.commits(12).columns == ["commit"]
    before = dest.topic("copy").head().commit
    finish([clone_stream(source, "t", dest, "copy", str(tmp_path / "lost"), available_now=True)])
    assert dest.topic("copy").head().commit == before


def test_a_record_stream_with_a_limit(spark, backlog, tmp_path):
    place = str(tmp_path / "rows")
    saved = spark.createDataFrame([(0, 5), (1, None)], "`partition` INT, next_offset BIGINT")
    stream = stream_from_progress(backlog, saved, most_bytes=6_000)
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(place)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 3
    got = spark.read.parquet(place).orderBy("partition", "offset").collect()
    assert [r["value"] for r in got] == [r[2] for r in rows_of(backlog) if r[0] or r[1] >= 5]


def test_offsets_of_old_runs_are_forgotten(source, dest, make_log, tmp_path, monkeypatch):
    monkeypatch.setattr(topic_log, "KEPT_RUNS", 2)
    log = source.import_topic("t", make_log((0, 0, b"a")), 1)
    dest.create_topic("copy", 1)
    for n in range(4):
        ends = log.bounds()
        log.ingest(make_log((0, n + 1, b"%d" % n)))
        finish([forward(source, "t", dest, "copy", str(tmp_path / f"c{n}"), ends, available_now=True)])
    head = dest.topic("copy").head()
    assert [r[2] for r in rows_of(dest.topic("copy"))] == [b"0", b"1", b"2", b"3"]
    assert len(head.copied) == 2 and head.forgotten
    # What a forgotten run has sent is not known any more, so it may not go on.
    log.ingest(make_log((0, 9, b"new")))
    with pytest.raises(Exception, match="too long ago"):
        finish([forward(source, "t", dest, "copy", str(tmp_path / "c0"), available_now=True, patience=60)])
    finish([forward(source, "t", dest, "copy", str(tmp_path / "c3"), available_now=True)])
    assert rows_of(dest.topic("copy"))[-1][2] == b"new"


def test_a_forwarded_topic_is_no_clone(source, dest, make_log, tmp_path):
    log = source.import_topic("t", make_log((0, 0, b"a")), 1)
    dest.create_topic("copy", 1)
    finish([forward(source, "t", dest, "copy", str(tmp_path / "c"), log.bounds().withColumn("high", F.lit(0).cast("long")), available_now=True)])
    with pytest.raises(Untrusted, match="no trusted state"):
        clone(source, "t", dest, "copy")


class Growing:
    """A broker whose topic grows whenever it is asked."""

    def __init__(self):
        self.asked = 0

    def topics(self):
        return {"t": ("kafka-id", 2)}

    def offsets(self, topic, partitions):
        self.asked += 1
        return [(1, 0, 3 + self.asked), (0, 2, 5 + self.asked)]


@pytest.fixture
def rows_behind(spark, make_log, monkeypatch):
    """Lets ``KafkaSource`` read a table in place of the connector, by the options it would pass on."""
    rows = make_log(*[(p, o, b"%d-%d" % (p, o)) for p in (0, 1) for o in range(2 if p == 0 else 0, 40)])
    reads = []

    def slice(self, bounds):
        options = self.read_options(bounds)
        reads.append(options)
        low, high = (json.loads(options[k])["t"] for k in ("startingOffsets", "endingOffsets"))
        return bounded_scan(rows, ranges(spark, {int(p): v for p, v in low.items()}, {int(p): v for p, v in high.items()}))

    monkeypatch.setattr(kafka.KafkaSource, "slice", slice)
    return reads


def test_kafka_options(spark):
    made = KafkaCluster(spark, "host:9092", "k", {"kafka.isolation.level": "read_committed", "minPartitions": "9"}, Growing()).source("t")
    options = made.read_options(made.bounds())
    assert json.loads(options["assign"]) == {"t": [0, 1]} and "subscribe" not in options
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 2, "1": 0}} and json.loads(options["endingOffsets"]) == {"t": {"0": 6, "1": 4}}
    assert options["kafka.isolation.level"] == "read_committed" and options["minPartitions"] == "9" and options["failOnDataLoss"] == "true"
    streamed = made.stream_options({0: 7}, most_bytes=10_240)
    assert json.loads(streamed["startingOffsets"]) == {"t": {"0": 7, "1": 0}} and streamed["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(KeyError):
        KafkaCluster(spark, "host:9092", "k", broker=Growing()).source("absent")


def test_a_growing_topic_is_dumped_up_to_one_end(spark, rows_behind, tmp_path):
    broker = Growing()
    manifest = dump(KafkaCluster(spark, "host:9092", "k", broker=broker).source("t"), str(tmp_path / "a"))
    assert broker.asked == 1 and [p["records"] for p in manifest["partitions"]] == [4, 4]
    assert {r["endingOffsets"] for r in rows_behind} == {'{"t": {"0": 6, "1": 4}}'}
    assert read_archive(spark, str(tmp_path / "a")).count() == 8


def test_a_kafka_topic_is_cloned_and_resumed(spark, dest, rows_behind):
    cluster = KafkaCluster(spark, "host:9092", "k", broker=Growing())
    dest.create_topic("copy", 2)
    # One offset of each partition at a time, then the rest at once.
    clone(cluster, "t", dest, "copy", most_bytes=1_024)
    head = clone(cluster, "t", dest, "copy")
    assert head.copied == {"kafka-id": {0: 7, 1: 5}} and head.commit == 5
    assert json.loads(rows_behind[1]["startingOffsets"]) == {"t": {"0": 3, "1": 1}}
    assert json.loads(rows_behind[-1]["startingOffsets"]) == {"t": {"0": 6, "1": 4}}
    assert [r[2] for r in rows_of(dest.topic("copy"))] == [b"0-%d" % n for n in range(2, 7)] + [b"1-%d" % n for n in range(5)]
    saved = dest.progress.read().orderBy("partition").collect()
    assert [(r["source_cluster"], r["source_topic_id"], r["next_offset"]) for r in saved] == [("k", "kafka-id", 7), ("k", "kafka-id", 5)]


def test_saved_progress_beyond_the_end_is_refused(spark, backlog, source, dest):
    dest.create_topic("copy", 2)
    ends = backlog.bounds()
    clone(source, "t", dest, "copy")
    with pytest.raises(BeyondEnd, match="saved offset 500 .* 9 for partition 0"):
        clone(source, "t", dest, "copy", ends.withColumn("high", F.lit(9).cast("long")))


def test_micro_batches_of_records(spark, make_log, dest):
    """What a record stream hands over: only what follows on the committed offsets."""
    from logferry.sources.source import arrived_rows

    batch = make_log((0, 4, b"a"), (0, 5, b"b"), (1, 1, b"c"), (2, 0, b"new partition"))
    piece = arrived_rows(batch, {0: 5, 1: 0})
    assert piece.ends == {0: 6, 1: 2} and sorted(r["value"] for r in piece.rows.collect()) == [b"b", b"c"]
    assert arrived_rows(batch, {0: 6, 1: 2}) is None
    assert transfer.take_over(dest.create_topic("x", 2), "k", piece, dest.topic("x").head()).copied == {"k": {0: 6, 1: 2}}
