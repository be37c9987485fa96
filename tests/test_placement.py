"""Work cut by bytes, files of one run, positions proved from files, and archives compared by their digests."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logferry.operators import placement
from logferry.operators.placement import arranged, layout, placed, record_bytes
from logferry.operators.ranking import offset_stats
from logferry.plans.transfer import dump, dump_rows
from logferry.schemas import ARCHIVE, LOG
from logferry.sources import archive
from logferry.sources.archive import BrokenArchive, archive_differences, data_folder, intervals, read_archive, write_archive


@pytest.fixture
def uneven(spark):
    """A log whose first partition is dense and small, and whose second has gaps and a few huge records."""
    draw = random.Random(5)
    rows = [(0, n, None, b"k", b"x" * draw.randrange(60), []) for n in range(400)]
    at = 0
    for n in range(300):
        at += draw.choice([1, 1, 2, 50])
        rows.append((1, at, 7, None, b"y" * (20_000 if n in (7, 8, 150) else 30), [("h", None), ("h", b"z" * 9)]))
    draw.shuffle(rows)
    return spark.createDataFrame(rows, LOG).repartition(5)


def test_bytes_of_a_record(spark):
    rows = spark.createDataFrame([(0, 0, None, b"ab", None, [("é", b"123"), ("", None)]), (0, 1, 1, None, b"", None)], LOG)
    assert [r[0] for r in rows.select(record_bytes()).collect()] == [24 + 2 + 2 + 3, 24]


def test_layout_by_definition():
    draw = np.random.default_rng(3)
    partition = np.repeat([0, 2, 5], [40, 1, 60])
    fine = np.concatenate([np.sort(draw.choice(500, n, replace=False)) for n in (40, 1, 60)])
    records, size = draw.integers(1, 9, 101), draw.integers(1, 1_000, 101)
    mixed = draw.permutation(101)
    found = pa.table({"partition": pa.array(partition[mixed], pa.int32()), "fine": fine[mixed], "records": records[mixed], "bytes": size[mixed]})
    plan = arranged(found, 10, 3_000)
    task, base = plan.table["task"].to_numpy(), plan.table["base"].to_numpy()
    assert plan.tasks == task[-1] + 1 and set(np.diff(task)) <= {0, 1}
    for t in range(plan.tasks):
        rows = np.flatnonzero(task == t)
        assert len(set(partition[rows])) == 1 and size[rows].sum() <= 3_000 + size[rows].max()
        earlier = (partition == partition[rows[0]]) & (np.arange(101) < rows[0])
        assert set(base[rows]) == {records[earlier].sum()}
    assert plan.most_bytes == max(size[task == t].sum() for t in range(plan.tasks))
    assert arranged(found.slice(0, 0), 10, 1).tasks == 1


def test_no_task_gets_more_than_its_bytes(uneven):
    stats = offset_stats(uneven).collect()
    plan = layout(uneven, stats, task_bytes=5_000)
    got = placed(uneven.withColumn("size", record_bytes()).withColumn("at", F.col("offset")), plan).withColumn("task", F.spark_partition_id()).collect()
    seqs = {p: sorted(r["at"] for r in got if r["partition"] == p) for p in (0, 1)}
    assert len(got) == 700 and all(seqs[r["partition"]][r["seq"]] == r["at"] for r in got)
    by_task = {}
    for r in got:
        by_task.setdefault(r["task"], []).append(r)
    largest_range = 20_100
    assert max(sum(r["size"] for r in rows) for rows in by_task.values()) == plan.most_bytes <= 5_000 + largest_range + 5_000
    for rows in by_task.values():
        assert len({r["partition"] for r in rows}) == 1
        assert [r["seq"] for r in rows] == list(range(rows[0]["seq"], rows[0]["seq"] + len(rows)))


def test_ranges_are_made_finer_where_records_are_large(spark, uneven, monkeypatch):
    monkeypatch.setattr(placement, "RANGES_PER_TASK", 1)
    stats = offset_stats(uneven).collect()
    coarse = placement.choose_width(stats, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert layout(uneven, stats, task_bytes=5_000).width < coarse
    assert layout(uneven, stats).width == coarse


def test_a_dump_shuffles_records_once_and_samples_nothing(spark, uneven):
    rows = placed(uneven, layout(uneven, offset_stats(uneven).collect()))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    shuffles = plan.count("Exchange ") - plan.count("BroadcastExchange ") - plan.count("Exchange RoundRobin")
    assert shuffles == 1 and "shufflepartitionidpassthrough" in plan and "rangepartitioning" not in plan


def test_every_file_of_a_dump_is_one_run(spark, uneven, tmp_path):
    path = str(tmp_path / "a")
    manifest = dump_rows(uneven, path, 2, task_bytes=2_000)
    runs = intervals(spark, data_folder(spark, path)).collect()
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert len(runs) == files > 10 and all(r["top"] - r["low"] + 1 == r["records"] for r in runs)
    want = [(r["partition"], r["offset"], r["value"]) for r in uneven.orderBy("partition", "offset").collect()]
    got = read_archive(spark, path).orderBy("partition", "seq").collect()
    assert [(r["partition"], r["value"]) for r in got] == [(p, v) for p, _, v in want]
    assert manifest == dump_rows(uneven.repartition(2), str(tmp_path / "b"), 2)
    plan = intervals(spark, data_folder(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert "value#" not in plan.split("Relation")[0]


def test_dumps_of_empty_and_partly_empty_logs(spark, uneven, source, tmp_path):
    assert dump(source.create_topic("none", 3), str(tmp_path / "none"))["records"] == 0
    assert [p["records"] for p in dump_rows(uneven, str(tmp_path / "more"), 4)["partitions"]] == [400, 300, 0, 0]
    assert read_archive(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("positions", [[0, 1, 1, 3], [0, 1, 2, 2, 3], [1, 2, 3, 4], [0, 1, 3, 4], [0, 0, 2, 3], [0, 1, 2, None]])
def test_positions_are_proved_from_files(spark, tmp_path, monkeypatch, positions):
    rows = spark.createDataFrame([(0, n, 1, b"k", b"v", []) for n in positions], ARCHIVE)
    folder = str(tmp_path / "data")
    rows.repartition(2).write.partitionBy("partition").parquet(folder)
    manifest = {"partitions": [{"partition": 0, "records": len(positions)}]}
    with pytest.raises(BrokenArchive):
        archive._prove_positions(spark, "x", folder, manifest)
    fine = spark.createDataFrame([(0, n, 1, b"k", b"v", []) for n in (3, 0, 2, 1)], ARCHIVE)
    fine.repartition(2).write.mode("overwrite").partitionBy("partition").parquet(folder)
    archive._prove_positions(spark, "x", folder, {"partitions": [{"partition": 0, "records": 4}]})


@pytest.fixture
def two(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FAN_IN", 4_096)
    rows = spark.range(20_000).selectExpr(
        "cast(id % 2 as int) AS partition", "id div 2 AS seq", "id AS timestamp_ms", "cast('k' as binary) AS key",
        "cast(cast(id as string) as binary) AS value", "cast(array() as array<struct<key:string,value:binary>>) AS headers",
    )
    write_archive(rows, str(tmp_path / "a"), 2)

    def other(change):
        path = str(tmp_path / "b")
        write_archive(change(rows), path, 2, force=True)
        return archive_differences(spark, str(tmp_path / "a"), path)

    return other


def test_differences_of_archives(two):
    assert two(lambda r: r.repartition(3)).collect() == []
    changed = two(lambda r: r.withColumn("key", F.when(F.expr("partition = 1 AND seq IN (5, 9000)"), F.lit(b"x")).otherwise(F.col("key"))))
    assert sorted((r["partition"], r["seq"]) for r in changed.collect()) == [(1, 5), (1, 9000)]
    shorter = two(lambda r: r.where("partition = 1 OR seq < 9998")).collect()
    assert [(r["partition"], r["seq"], r["right_digest"]) for r in sorted(shorter)] == [(0, 9998, None), (0, 9999, None)]


def test_equal_archives_read_no_record(two):
    plan = two(lambda r: r)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan


def test_only_differing_leaves_are_read(two):
    found = two(lambda r: r.withColumn("key", F.when(F.expr("partition = 1 AND seq = 5000"), F.lit(b"x")).otherwise(F.col("key"))))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "seq" in plan and ">= 4096" in plan and "<= 8191" in plan and found.count() == 1
