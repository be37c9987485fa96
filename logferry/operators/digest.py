"""Content fingerprints that do not depend on file layout.

Record digests are joined in sequence order into leaves, leaves into blocks, blocks into one digest
per partition, and those into a root. Leaves and blocks have at most ``fan_in`` children, so no task
holds a partition: with the default a partition of 10^11 records ends in about 6,000 block digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logferry.functions import record_digest
from logferry.operators.small import checked_broadcast, partition_ids
from logferry.schemas import ARCHIVE_COLUMNS, ARCHIVE_FORMAT
from logferry.sources.files import written

FAN_IN = 4_096
NO_RECORDS = hashlib.sha256(b"").hexdigest()


def _joined(digest: str, order: str) -> Column:
    """SHA-256 over the 32-byte digests of a group, in order."""
    return F.sha2(F.expr(f"listagg({digest}) within group (order by {order})"), 256)


def leaf_digests(archive: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(partition, leaf, records, digest): the only step that shuffles one small row per record.

    ``archive`` has records, or their digests in a column ``d``.
    """
    digest = F.col("d") if "d" in archive.columns else F.unhex(record_digest()).alias("d")
    records = archive.select("partition", "seq", digest)
    return records.groupBy("partition", F.expr(f"seq div {int(fan_in)}").alias("leaf")).agg(
        F.count(F.lit(1)).alias("records"), _joined("d", "seq").alias("digest")
    )


def fingerprint(
    archive: DataFrame, partitions: int | DataFrame, fan_in: int = FAN_IN
) -> DataFrame:
    """(partition, records, digest) for every declared partition, empty ones included."""
    return fold_leaves(leaf_digests(archive, fan_in), partitions, fan_in)


def fold_leaves(leaves: DataFrame, partitions: int | DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(partition, records, digest) of every declared partition from the rows of ``leaf_digests``."""
    declared = partition_ids(leaves.sparkSession, partitions)
    return declared.join(fold_found(leaves, fan_in), "partition", "left").select(
        "partition",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("digest", F.lit(NO_RECORDS)).alias("digest"),
    )


def fold_found(leaves: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(partition, records, digest) of the partitions that hold records, declared or not."""
    blocks = leaves.withColumn("d", F.unhex("digest")).groupBy("partition", F.expr(f"leaf div {int(fan_in)}").alias("block")).agg(
        F.sum("records").alias("records"), F.unhex(_joined("d", "leaf")).alias("d")
    )
    return blocks.groupBy("partition").agg(
        F.sum("records").alias("records"), _joined("d", "block").alias("digest")
    )


def root_of(digests: Sequence[str]) -> str:
    """The root over the digests of all declared partitions, in order: what ``root_digest`` gives."""
    return hashlib.sha256("|".join([str(ARCHIVE_FORMAT), str(len(digests)), "".join(digests)]).encode()).hexdigest()


def root_digest(partition_digests: DataFrame) -> DataFrame:
    """One row (partitions, records, digest) over one row per log partition."""
    ordered = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("partition", "digest"))), lambda x: x["digest"]
        ),
        "",
    )
    count = F.count(F.lit(1))
    text = F.concat_ws("|", F.lit(str(ARCHIVE_FORMAT)), count.cast("string"), ordered)
    return partition_digests.agg(
        count.alias("partitions"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )


def roundtrip_check(left: DataFrame, right: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Positions at which two archives differ: (partition, seq, left_digest, right_digest).

    Leaf digests are compared first; only leaves that differ are compared record by record. A
    position that one side lacks has a null digest there.
    """
    a = leaf_digests(left, fan_in).select("partition", "leaf", F.col("digest").alias("a"))
    b = leaf_digests(right, fan_in).select("partition", "leaf", F.col("digest").alias("b"))
    suspects = (
        a.join(b, ["partition", "leaf"], "full")
        .where(~F.col("a").eqNullSafe(F.col("b")))
        .select("partition", F.col("leaf").alias("low"))
    )
    # Usually no leaf or few differ. However many do, they are found only once.
    suspects = checked_broadcast(written(suspects)).withColumnRenamed("low", "leaf")

    def records(side: DataFrame, name: str) -> DataFrame:
        leaf = F.expr(f"seq div {int(fan_in)}")
        return (
            side.select(*ARCHIVE_COLUMNS)
            .withColumn("leaf", leaf)
            .join(suspects, ["partition", "leaf"], "left_semi")
            .select("partition", "seq", record_digest().alias(name))
        )

    both = records(left, "left_digest").join(
        records(right, "right_digest"), ["partition", "seq"], "full"
    )
    return both.where(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
