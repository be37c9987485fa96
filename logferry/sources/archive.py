"""Ordered archives: zstd Parquet per log partition, the leaves of the digest tree, and a manifest.

    <path>/_manifest.json                         format_version, records and digest per partition, root
                                                  digest, and the data folder that it vouches for
    <path>/_manifest-<n>.json                     the same of the n-th replacement; the highest one counts
    <path>/data-<id>/partition=<p>/*.parquet      each file one run of positions of one partition
    <path>/data-<id>/_leaves/*.parquet            (partition, leaf, records, digest)

Data are written where no reader looks, and published by the exclusive rename of a manifest that names
them. So at every moment, also when a writer is killed, readers see the whole old archive or the whole new
one. An archive knows neither the topic it came from nor its offsets. Equal contents give an equal manifest,
but for the folder's name; Parquet bytes may differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logferry.functions import normalize, record_digest
from logferry.operators.digest import FAN_IN, NO_RECORDS, fold_found, leaf_digests, root_of
from logferry.operators.placement import by_position
from logferry.schemas import ARCHIVE, ARCHIVE_COLUMNS, ARCHIVE_FORMAT
from logferry.sources.files import AlreadyPublished, Files, fresh_name

MANIFEST = "_manifest"
LEAVES = "`partition` INT, leaf BIGINT, records BIGINT, digest STRING"


class BrokenArchive(ValueError):
    """The archive is incomplete, damaged or of another format."""


def _rows(spark: SparkSession, data: str) -> DataFrame:
    return normalize(spark.read.schema(ARCHIVE).parquet(data), "seq")


def _generation(name: str) -> int:
    """Which replacement a manifest file describes: 1 for the first, 0 for files that are no manifest."""
    stem = name.removesuffix(".json")
    if stem == name or not stem.startswith(MANIFEST):
        return 0
    number = stem.removeprefix(MANIFEST)
    return 1 if not number else int(number[1:]) if number[1:].isdigit() else 0


def _manifest_name(generation: int) -> str:
    return f"{MANIFEST}.json" if generation == 1 else f"{MANIFEST}-{generation}.json"


def _latest(files: Files, path: str) -> int:
    return max(map(_generation, files.names(path)), default=0)


def is_archive(spark: SparkSession, path: str) -> bool:
    return _latest(Files(spark), path) > 0


def _located(spark: SparkSession, path: str) -> tuple[dict, str]:
    """The manifest and the folder of the data that it names."""
    files = Files(spark)
    generation = _latest(files, path)
    if not generation:
        raise BrokenArchive(f"{path} is not an archive")
    manifest = files.read_json(f"{path}/{_manifest_name(generation)}")
    if manifest.get("format_version") != ARCHIVE_FORMAT:
        raise BrokenArchive(
            f"unsupported archive format version {manifest.get('format_version')} in {path}"
        )
    for expected, entry in enumerate(manifest["partitions"]):
        if entry["partition"] != expected:
            raise BrokenArchive(
                f"archive partition {entry['partition']} found where {expected} was expected"
            )
    return manifest, f"{path}/{manifest.pop('data')}"


def read_manifest(spark: SparkSession, path: str) -> dict:
    return _located(spark, path)[0]


def data_folder(spark: SparkSession, path: str) -> str:
    return _located(spark, path)[1]


def read_archive(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """Archive rows. ``verify`` proves from the ``seq`` column that each partition holds every position that
    the manifest declares exactly once; ``matches_manifest`` compares the contents."""
    manifest, data = _located(spark, path)
    if verify:
        _prove_positions(spark, path, data, manifest)
    return _rows(spark, data)


def intervals(spark: SparkSession, data: str) -> DataFrame:
    """(partition, low, top, records): the runs of positions that lie one after the other in a file.

    Rows of a file are numbered, so rows with one difference of position and number are a run, which holds
    each of its positions once. Runs are found where the files are read; about one row a file is shuffled.
    """
    rows = spark.read.schema(ARCHIVE).parquet(data)
    place = rows.select("partition", "seq", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return (
        place.groupBy("partition", "file", (F.col("seq") - F.col("row")).alias("run"))
        .agg(F.min("seq").alias("low"), F.max("seq").alias("top"), F.count(F.lit(1)).alias("records"))
        .select("partition", "low", "top", "records")
    )


def _prove_positions(spark: SparkSession, path: str, data: str, manifest: dict) -> None:
    before = W.partitionBy("partition").orderBy("low", "top")
    checked = intervals(spark, data).withColumn("expected", F.coalesce(F.lag("top").over(before) + 1, F.lit(0)))
    whole = (F.col("low") == F.col("expected")) & (F.col("top") - F.col("low") + 1 == F.col("records"))
    # A missing position is in no run and comes first.
    faulty = F.when(~F.coalesce(whole, F.lit(False)), F.coalesce("low", F.lit(-1)))
    sums = checked.groupBy("partition").agg(F.sum("records").alias("records"), F.min(faulty).alias("fault"))
    found = {r["partition"]: r for r in sums.collect()}
    declared = {p["partition"]: p["records"] for p in manifest["partitions"]}
    extra = sorted(set(found) - set(declared), key=str)
    if extra:
        raise BrokenArchive(f"undeclared partition {extra[0]} in archive {path}")
    for partition, records in declared.items():
        row = found.get(partition)
        if (row["records"] if row else 0) != records:
            raise BrokenArchive(
                f"partition {partition} of archive {path} has "
                f"{row['records'] if row else 0} records but declares {records}"
            )
        if row and row["fault"] is not None:
            raise BrokenArchive(f"positions of partition {partition} of archive {path} repeat or are missing near {row['fault']}")


def write_archive(
    archive: DataFrame,
    path: str,
    partitions: int,
    force: bool = False,
    placed: bool = False,
    expected: int | None = None,
) -> dict:
    """Write ``archive`` in order and publish it at once; returns the manifest.

    Rows go to tasks by their positions, so each file covers one run of positions of one partition and a
    large partition is written by many tasks. ``placed`` says that the rows already come in such runs, in
    order, and need neither a shuffle nor a sort. ``expected`` is the number of records that the source was
    counted to hold: another number is not published. The data of a replaced archive are deleted once the
    new one is published.
    """
    spark = archive.sparkSession
    files = Files(spark)
    before = _latest(files, path)
    if before and not force:
        raise AlreadyPublished(f"archive {path} already exists; pass force to replace it")
    rows = normalize(archive, "seq").select(*ARCHIVE_COLUMNS)
    if not placed:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = by_position(rows, _position_stats(rows), tasks)
    name = f"data-{fresh_name()}"
    data = f"{path}/{name}"
    try:
        rows.write.partitionBy("partition").option("compression", "zstd").parquet(data)
        manifest = _describe(spark, data, partitions)
        if expected is not None and manifest["records"] != expected:
            raise BrokenArchive(f"{manifest['records']} records were staged but {expected} counted")
        files.write_json(f"{data}/{MANIFEST}.json", {**manifest, "data": name})
        files.publish(f"{data}/{MANIFEST}.json", f"{path}/{_manifest_name(before + 1)}")
    except BaseException:
        files.delete(data)
        files.delete_empty(path)
        raise
    _forget(files, path, before)
    return manifest


def _position_stats(rows: DataFrame) -> Sequence[Row]:
    span = rows.groupBy("partition").agg(F.min("seq").alias("low"), (F.max("seq") + 1).alias("high"))
    return span.where("low IS NOT NULL").collect()


def _forget(files: Files, path: str, upto: int) -> None:
    """Delete the manifests of earlier generations and then what they name, so that none names missing data."""
    for generation in sorted(g for g in map(_generation, files.names(path)) if 0 < g <= upto):
        manifest = f"{path}/{_manifest_name(generation)}"
        data = files.read_json(manifest).get("data")
        files.delete(manifest)
        if data:
            files.delete(f"{path}/{data}")


def _describe(spark: SparkSession, data: str, partitions: int) -> dict:
    """Digests of what was really written, read back from its files; their leaves are kept beside it."""
    leaf_digests(_rows(spark, data)).select("partition", "leaf", "records", "digest").write.parquet(f"{data}/_leaves")
    found = _prints(_leaves(spark, data))
    if not found.keys() <= set(range(partitions)):
        raise BrokenArchive(f"records lie outside the {partitions} declared partitions")
    entries = [(p, *found.get(p, (0, NO_RECORDS))) for p in range(partitions)]
    return {
        "format_version": ARCHIVE_FORMAT,
        "fan_in": FAN_IN,
        "partitions": [{"partition": p, "records": n, "digest": d} for p, n, d in entries],
        "records": sum(n for _, n, _ in entries),
        "digest": root_of([d for *_, d in entries]),
    }


def _prints(leaves: DataFrame, fan_in: int = FAN_IN) -> dict[int, tuple[int, str]]:
    """Records and digest by partition, of those that hold records. One row per log partition."""
    return {r["partition"]: (r["records"], r["digest"]) for r in fold_found(leaves, fan_in).collect()}


def _leaves(spark: SparkSession, data: str) -> DataFrame:
    return spark.read.schema(LEAVES).parquet(f"{data}/_leaves")


def _damaged(rows: DataFrame, manifest: dict) -> list[int]:
    """Partitions whose records are not those that the manifest vouches for."""
    declared = {p["partition"]: (p["records"], p["digest"]) for p in manifest["partitions"]}
    fan_in = manifest["fan_in"]
    found = _prints(leaf_digests(rows, fan_in), fan_in)
    nothing = (0, NO_RECORDS)
    return sorted(p for p in declared.keys() | found.keys() if found.get(p, nothing) != declared.get(p, nothing))


def matches_manifest(rows: DataFrame, manifest: dict) -> bool:
    """Whether ``rows`` (ARCHIVE) are the contents that the manifest vouches for, record by record."""
    return not _damaged(rows, manifest)


def verify_archive(spark: SparkSession, path: str) -> None:
    """Recompute every digest of an archive from its records; raises where one differs."""
    manifest, data = _located(spark, path)
    damaged = _damaged(_rows(spark, data), manifest)
    if damaged:
        raise BrokenArchive(f"partition {damaged[0]} of archive {path} is damaged")
    if manifest["digest"] != root_of([p["digest"] for p in manifest["partitions"]]):
        raise BrokenArchive(f"archive {path} does not match its digest")


def archive_differences(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Positions at which two archives differ: (partition, seq, left_digest, right_digest).

    The stored digests are compared from the top: roots and partitions in the manifests, then the leaves of
    the partitions that differ; records are read and hashed only in leaves that differ. Digests are those of
    when the archives were written: ``verify_archive`` finds later damage.
    """
    (a, data_a), (b, data_b) = _located(spark, left), _located(spark, right)
    result = "`partition` INT, seq BIGINT, left_digest STRING, right_digest STRING"
    prints = [{p["partition"]: (p["records"], p["digest"]) for p in m["partitions"]} for m in (a, b)]
    different = sorted(p for p in prints[0].keys() | prints[1].keys() if prints[0].get(p) != prints[1].get(p))
    if a["digest"] == b["digest"] or not different:
        return spark.createDataFrame([], result)
    sides = [_leaves(spark, d).where(F.col("partition").isin(different)) for d in (data_a, data_b)]
    joined = sides[0].select("partition", "leaf", F.col("digest").alias("a")).join(sides[1].select("partition", "leaf", F.col("digest").alias("b")), ["partition", "leaf"], "full")
    suspects = joined.where(~F.col("a").eqNullSafe(F.col("b"))).select("partition", "leaf")
    # The extent of what differs reaches the scans as a predicate on positions.
    extent = suspects.agg(F.min("leaf").alias("low"), F.max("leaf").alias("top")).first()

    def records(data: str, name: str) -> DataFrame:
        inside = F.col("partition").isin(different) & F.col("seq").between(extent["low"] * FAN_IN, (extent["top"] + 1) * FAN_IN - 1)
        rows = _rows(spark, data).where(inside).withColumn("leaf", F.expr(f"seq div {FAN_IN}"))
        return rows.join(suspects, ["partition", "leaf"], "left_semi").select("partition", "seq", record_digest().alias(name))

    both = records(data_a, "left_digest").join(records(data_b, "right_digest"), ["partition", "seq"], "full")
    return both.where(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
