"""Restores that prove their contents, safe replacement, refused repeats, and state under contention."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from logferry.operators import records
from logferry.operators.digest import fingerprint
from logferry.plans.run import Copy, EndedEarly, finish_copies
from logferry.plans.transfer import dump, restore
from logferry.schemas import ARCHIVE, ARCHIVE_COLUMNS
from logferry.sources.archive import BrokenArchive, data_folder, read_archive, verify_archive, write_archive
from logferry.sources.files import Files
from logferry.sources.tables import SmallTable


@pytest.fixture
def archive(source, make_log, tmp_path):
    log = source.create_topic("t", 1)
    log.ingest(make_log((0, 0, b"a"), (0, 1, b"b"), (0, 5, b"c")))
    path = str(tmp_path / "archive")
    dump(log, path)
    return path


def tampered(spark, path, change):
    """Replace the data files by others that ``change`` makes, with the same counts and positions."""
    folder = f"{data_folder(spark, path)}/partition=0"
    change(spark.read.parquet(folder)).write.parquet(f"{path}-new")
    files = Files(spark)
    files.delete(folder)
    files.publish(f"{path}-new", folder)


@pytest.mark.parametrize("change", [lambda r: r.withColumn("value", F.lit(b"x")), lambda r: r.withColumn("seq", F.when(F.col("seq") == 1, 0).otherwise(F.col("seq")).cast("long"))])
def test_restore_refuses_changed_contents(spark, dest, archive, change):
    tampered(spark, archive, change)
    dest.create_topic("copy", 1)
    with pytest.raises(BrokenArchive):
        restore(dest, "copy", archive)
    assert not dest.markers.read().where("status = 'complete'").count()


@pytest.mark.parametrize("step", ["write_json", "publish", "delete", "read_json"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_writer_killed_at_any_step_leaves_an_archive(spark, archive, monkeypatch, step, when):
    held = lambda: read_archive(spark, archive).orderBy("seq").collect()
    old = held()
    new = read_archive(spark, archive).withColumn("value", F.lit(b"new"))
    real = getattr(Files, step)

    class Killed(BaseException):
        pass

    dead = []

    def killed(self, *args):
        # Nothing at all happens after a kill, not even cleaning up.
        if dead:
            raise Killed
        if when == "after":
            real(self, *args)
        dead.append(1)
        raise Killed

    for name in ("delete", "delete_empty"):
        kept = getattr(Files, name)
        monkeypatch.setattr(Files, name, lambda self, *a, kept=kept: None if dead else kept(self, *a))
    monkeypatch.setattr(Files, step, killed)
    with pytest.raises(Killed):
        write_archive(new, archive, 1, force=True)
    monkeypatch.undo()
    found = held()
    published = step in ("delete", "read_json") or (step, when) == ("publish", "after")
    assert [r["value"] for r in found] == ([b"new"] * 3 if published else [r["value"] for r in old])
    verify_archive(spark, archive)
    # And the next writer goes on from there.
    write_archive(read_archive(spark, archive), f"{archive}-copy", 1)
    write_archive(read_archive(spark, f"{archive}-copy"), archive, 1, force=True)
    assert held() == found


def test_a_source_that_changed_is_not_published(spark, archive, tmp_path):
    with pytest.raises(BrokenArchive):
        write_archive(read_archive(spark, archive), str(tmp_path / "other"), 1, expected=4)
    assert not Files(spark).exists(str(tmp_path / "other"))


def test_repeated_offsets_are_refused(source, make_log):
    log = source.create_topic("t", 1)
    rows = make_log((0, 0, b"a"), (0, 0, b"b"), (0, 2, b"c"))
    for put in (log.ingest, log.append):
        with pytest.raises(ValueError, match="occurs 2 times"):
            put(rows)
    assert log.head().commit == 0


def test_state_under_contention_and_for_slow_readers(spark, tmp_path):
    table = SmallTable(spark, str(tmp_path / "state"), "name STRING")
    table.update(lambda t: t.union(spark.createDataFrame([("first",)], "name STRING")))
    reader = table.read()
    for k in range(25):
        table.update(lambda t, k=k: spark.createDataFrame([(f"n{k}",)], "name STRING"))

    def add(name):
        table.update(lambda t: t.union(spark.createDataFrame([(name,)], "name STRING")))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, [f"p{k}" for k in range(8)]))
    assert [r.name for r in reader.collect()] == ["first"]
    assert table.read().count() == 9


def test_fingerprints_shuffle_no_payload(spark, inputs):
    prints = fingerprint(records.ranked_digests(inputs.events_log()), 4)
    plan = prints._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[: plan.index("Window")]
    assert not any(name in ranked for name in ("headers#", "value#", "timestamp_ms#"))
    assert prints.collect() == fingerprint(records.to_archive(inputs.events_log()), 4).collect()


def test_every_archive_file_covers_one_run_of_positions(spark, tmp_path):
    rows = spark.range(20_000).selectExpr(
        "cast(id % 3 as int) AS partition", "id div 3 AS seq", "cast(null as bigint) AS timestamp_ms",
        "cast(null as binary) AS key", "encode(cast(id as string), 'UTF-8') AS value",
    )
    for name, kind in ((f.name, f.dataType.simpleString()) for f in spark.createDataFrame([], ARCHIVE).schema):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.expr(f"cast(null as {kind})"))
    path = str(tmp_path / "ranges")
    write_archive(rows.select(*ARCHIVE_COLUMNS).repartition(7), path, 3)
    files = spark.read.parquet(path).groupBy("partition", F.input_file_name().alias("file"))
    runs = files.agg(F.min("seq").alias("low"), F.max("seq").alias("top"), F.count("*").alias("n")).collect()
    assert all(r["top"] - r["low"] + 1 == r["n"] for r in runs)
    assert len(runs) <= 3 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_clean_end_of_an_endless_copy_is_a_failure():
    class Ended:
        id, name, isActive = "q", "clone t", False

        def awaitTermination(self):
            return True

    with pytest.raises(EndedEarly):
        finish_copies([Copy("t", Ended(), {})])
    finish_copies([Copy("t", Ended(), {}, bounded=True)])
