"""Identity of records, ordering, fingerprints and archives."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logferry.functions import normalize, with_digest
from logferry.operators import digest, ranking, records
from logferry.schemas import ARCHIVE, LOG
from logferry.sources.archive import (
    BrokenArchive,
    read_archive,
    read_manifest,
    verify_archive,
    write_archive,
)
from logferry.sources.files import AlreadyPublished

HEADERS = [("x", None), ("x", b"\x00\x01\x02")]


@pytest.fixture
def archived(spark):
    """One record with an empty key, no value and a repeated header; partition 1 is empty."""
    return spark.createDataFrame([(0, 0, 42, b"", None, HEADERS)], ARCHIVE)


def digests(df):
    return [r[0] for r in with_digest(df).orderBy("partition", "offset").select("record_digest").collect()]


def test_every_detail_changes_the_digest(spark):
    variants = [
        (0, 0, 42, b"", None, HEADERS),
        (0, 1, 42, None, None, HEADERS),
        (0, 2, 42, b"", b"", HEADERS),
        (0, 3, None, b"", None, HEADERS),
        (0, 4, 42, b"", None, HEADERS[::-1]),
        (0, 5, 42, b"", None, HEADERS[:1]),
        (0, 6, 42, b"ab", b"c", []),
        (0, 7, 42, b"a", b"bc", []),
        (0, 8, 42, b"", None, [("x", b""), ("x", b"\x00\x01\x02")]),
    ]
    found = digests(spark.createDataFrame(variants, LOG))
    assert len(set(found)) == len(variants)


def test_absent_and_empty_headers_are_the_same(spark):
    rows = normalize(spark.createDataFrame([(0, 0, 1, b"k", b"v", None), (0, 1, 1, b"k", b"v", [])], LOG))
    assert len(set(digests(rows))) == 1


def test_sequence_over_gaps_skew_and_chunks(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 2 + 1).otherwise(0).cast("int").alias("partition"),
        (F.col("id") * F.col("id") + 2**53).alias("offset"),
    )
    got = ranking.partition_sequence(rows, 1_000).orderBy("partition", "offset").collect()
    counters = {}
    for row in got:
        assert row["seq"] == counters.get(row["partition"], 0)
        counters[row["partition"]] = row["seq"] + 1
    assert sum(counters.values()) == 3_000


@pytest.mark.parametrize("step", [1, 3])
def test_renumber_dense_and_gappy(spark, step):
    rows = spark.range(100).select(
        (F.col("id") % 2).cast("int").alias("partition"),
        (F.expr("id div 2") * step + 7).alias("offset"),
    )
    stats = ranking.offset_stats(rows).collect()
    assert ranking.is_dense(stats) == (step == 1)
    moved = ranking.renumber(rows, stats, {1: 1_000}, "seq")
    seen = {(r["partition"], r["seq"]) for r in moved.collect()}
    assert seen == {(0, i) for i in range(50)} | {(1, 1_000 + i) for i in range(50)}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.sets(st.tuples(st.integers(0, 3), st.integers(0, 2**62)), min_size=1, max_size=40),
    chunk=st.sampled_from([1, 7, 65_536, 2**40]),
)
def test_sequence_equals_brute_force(spark, rows, chunk):
    frame = spark.createDataFrame(list(rows), "`partition` INT, `offset` BIGINT")
    got = {(r["partition"], r["offset"]): r["seq"] for r in ranking.partition_sequence(frame, chunk).collect()}
    assert got == {
        (p, o): sum(1 for q, x in rows if q == p and x < o) for p, o in rows
    }


def test_dense_log_is_renumbered_without_a_shuffle(spark):
    rows = spark.range(100).select(F.lit(0).alias("partition"), F.col("id").alias("offset"))
    stats = ranking.offset_stats(rows).collect()
    plan = ranking.renumber(rows, stats, {0: 5}, "offset")._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan


def test_hot_partition_is_ranked_by_many_tasks(inputs, spark):
    """All rows in one log partition: the shuffle key is (partition, chunk)."""
    rows = inputs.events_log().withColumn("partition", F.lit(0))
    numbered = ranking.partition_sequence(rows, 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = numbered.groupBy(F.spark_partition_id()).agg(F.max("seq")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1
    assert numbered.agg(F.max("seq"), F.countDistinct("seq")).first()[:] == (999, 1000)


def test_fingerprint_does_not_depend_on_layout(inputs):
    rows = records.to_archive(inputs.events_log())
    first = digest.fingerprint(rows, 5, 16).orderBy("partition").collect()
    again = digest.fingerprint(rows.repartition(7, "seq"), 5, 16).orderBy("partition").collect()
    assert first == again
    assert first[4]["records"] == 0 and first[4]["digest"] == digest.NO_RECORDS


def test_fingerprint_depends_on_order(spark):
    one = spark.createDataFrame([(0, 0, 1, b"a", b"", []), (0, 1, 1, b"b", b"", [])], ARCHIVE)
    two = spark.createDataFrame([(0, 1, 1, b"a", b"", []), (0, 0, 1, b"b", b"", [])], ARCHIVE)
    assert digest.fingerprint(one, 1).collect() != digest.fingerprint(two, 1).collect()


def test_fingerprint_matches_hashlib(inputs):
    """The whole tree recomputed by hand with small fans."""
    import hashlib

    rows = records.to_archive(inputs.events_log())
    fan = 8
    single = with_digest(rows).where("partition = 1").orderBy("seq").select("record_digest").collect()

    def level(children):
        groups = [children[i : i + fan] for i in range(0, len(children), fan)]
        return [hashlib.sha256(b"".join(g)).digest() for g in groups]

    blocks = level(level([bytes.fromhex(r[0]) for r in single]))
    expected = hashlib.sha256(b"".join(blocks)).hexdigest()
    got = digest.fingerprint(rows, 4, fan).where("partition = 1").first()
    assert (got["records"], got["digest"]) == (len(single), expected)


def test_archive_round_trip(spark, tmp_path, archived):
    path = str(tmp_path / "a" / "one")
    manifest = write_archive(archived, path, 2)
    assert [p["partition"] for p in manifest["partitions"]] == [0, 1]
    assert [p["records"] for p in manifest["partitions"]] == [1, 0]
    assert read_archive(spark, path).collect() == archived.collect()
    again = write_archive(archived.repartition(3), str(tmp_path / "a" / "two"), 2)
    assert again == manifest
    verify_archive(spark, path)


def test_archive_without_records(spark, tmp_path):
    path = str(tmp_path / "a" / "none")
    write_archive(spark.createDataFrame([], ARCHIVE), path, 3)
    assert read_archive(spark, path).count() == 0
    assert len(read_manifest(spark, path)["partitions"]) == 3


def test_existing_archive_needs_force(spark, tmp_path, archived):
    path = str(tmp_path / "a" / "one")
    write_archive(archived, path, 2)
    with pytest.raises(AlreadyPublished):
        write_archive(archived, path, 2)
    other = archived.withColumn("value", F.lit(b"new"))
    write_archive(other, path, 2, force=True)
    assert read_archive(spark, path).first()["value"] == b"new"
    assert os.listdir(tmp_path / "a") == ["one"]


def test_records_outside_the_declared_partitions_are_refused(tmp_path, archived):
    with pytest.raises(BrokenArchive):
        write_archive(archived.withColumn("partition", F.lit(2)), str(tmp_path / "x"), 2)
    assert os.listdir(tmp_path) == []


def edit_manifest(path, change):
    name = os.path.join(path, "_manifest.json")
    with open(name) as f:
        manifest = json.load(f)
    change(manifest)
    crc = os.path.join(path, "._manifest.json.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with open(name, "w") as f:
        json.dump(manifest, f)


@pytest.mark.parametrize(
    "change",
    [
        lambda m: m.update(format_version=2),
        lambda m: m["partitions"].pop(0),
        lambda m: m["partitions"][0].update(records=2),
        lambda m: m["partitions"][1].update(records=1),
    ],
)
def test_broken_archives_are_refused(spark, tmp_path, archived, change):
    path = str(tmp_path / "one")
    write_archive(archived, path, 2)
    edit_manifest(path, change)
    with pytest.raises(BrokenArchive):
        read_archive(spark, path)


def test_changed_contents_fail_verification(spark, tmp_path, archived):
    path = str(tmp_path / "one")
    write_archive(archived, path, 2)
    edit_manifest(path, lambda m: m["partitions"][0].update(digest="0" * 64))
    read_archive(spark, path)
    with pytest.raises(BrokenArchive):
        verify_archive(spark, path)


def test_roundtrip_check_reports_missing_and_changed(spark):
    left = spark.createDataFrame([(0, i, 1, b"k", b"%d" % i, []) for i in range(50)], ARCHIVE)
    right = left.where("seq <> 49").withColumn(
        "value", F.when(F.col("seq") == 7, F.lit(b"other")).otherwise(F.col("value"))
    )
    assert digest.roundtrip_check(left, left, 8).count() == 0
    found = digest.roundtrip_check(left, right, 8).orderBy("seq").collect()
    assert [r["seq"] for r in found] == [7, 49]
    assert found[1]["right_digest"] is None


def test_contiguity(make_log):
    assert ranking.check_partitions(make_log((0, 0, b""), (1, 0, b""))).collect() == []
    first = ranking.check_partitions(make_log((0, 0, b""), (2, 0, b""), (4, 0, b""))).collect()
    assert [(r["partition"], r["expected"]) for r in first] == [(2, 1)]
