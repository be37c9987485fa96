"""Checks of declared topics before anything is touched.

A declaration is a MAPPINGS row, except that it lists ``modes`` (an array), because declaring none
or several is one of the faults to report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.schemas import TIMESTAMP_SETTING

# Rows of one key that many declarations share are joined in so many tasks.
SALTS = 32


def declarations(mappings: DataFrame) -> DataFrame:
    """MAPPINGS rows in the shape that ``audit_mappings`` reads."""
    modes = F.array_compact(F.array("mode"))
    return mappings.withColumn("modes", modes).drop("mode")


def split_source(source_ref):
    """(instance, topic) of ``instance:topic``, split at the first colon; null when malformed."""
    at = F.instr(source_ref, ":")
    well_formed = (at > 1) & (at < F.length(source_ref))
    return (
        F.when(well_formed, F.substring(source_ref, F.lit(1), at - 1)),
        F.when(well_formed, F.substring(source_ref, at + 1, F.length(source_ref))),
    )


def audit_mappings(declared: DataFrame, sources: DataFrame) -> DataFrame:
    """Every fault of every declaration: (name, violation, detail).

    ``sources`` has one ``instance`` per known source.
    """
    instance, topic = split_source(F.col("source_ref"))
    mode = F.when(F.size("modes") == 1, F.element_at("modes", 1))
    reads = F.coalesce(mode.isin("clone", "stream"), F.lit(False))
    known = sources.select(F.col("instance").alias("known_instance")).distinct()
    rows = _salted(
        declared.withColumn("mode", mode)
        .withColumn("reads", reads)
        .withColumn("instance", F.when(F.col("reads"), instance))
        .withColumn("topic", F.when(F.col("reads"), topic))
    )
    # Rows without a source take part in the join under a key of their own, spread over tasks.
    rows = rows.withColumn(
        "wanted", F.coalesce("instance", F.concat(F.lit("\0"), F.coalesce("name", F.lit(""))))
    )
    rows = rows.join(
        _per_salt(known.withColumn("wanted", F.col("known_instance"))), ["wanted", "salt"], "left"
    )
    faults = [
        ("blank name", F.trim(F.coalesce("name", F.lit(""))) == "", F.lit("")),
        ("not exactly one mode", F.size("modes") != 1, F.array_join(F.array_sort("modes"), ",")),
        (
            "malformed source",
            F.col("reads") & F.col("instance").isNull(),
            F.coalesce("source_ref", F.lit("")),
        ),
        (
            "unknown source",
            F.col("instance").isNotNull() & F.col("known_instance").isNull(),
            F.col("instance"),
        ),
        (
            "missing archive",
            (F.col("mode") == "restore") & (F.coalesce("archive", F.lit("")) == ""),
            F.lit(""),
        ),
        (
            "partitions not positive",
            F.col("mode").isin("manage", "empty") & (F.coalesce("partitions", F.lit(0)) <= 0),
            F.coalesce(F.col("partitions").cast("string"), F.lit("")),
        ),
        (
            "replication not positive",
            F.col("replication_factor") <= 0,
            F.col("replication_factor").cast("string"),
        ),
        (
            "reserved setting",
            F.array_contains(F.map_keys("config"), TIMESTAMP_SETTING),
            F.lit(TIMESTAMP_SETTING),
        ),
    ]
    found = F.array_compact(
        F.array(
            *[
                F.when(hit, F.struct(F.lit(text).alias("violation"), detail.alias("detail")))
                for text, hit, detail in faults
            ]
        )
    )
    own = rows.select("name", F.inline(found))
    duplicates = _repeated(rows.where(F.col("name").isNotNull()), "name").select(
        "name",
        F.lit("duplicate destination").alias("violation"),
        F.col("n").cast("string").alias("detail"),
    )
    # One row per source after combining; a source that many topics share stays one counter.
    reading = rows.where(F.col("instance").isNotNull()).select("name", "source_ref", "salt")
    shared = (
        reading.join(_per_salt(_repeated(reading, "source_ref")), ["source_ref", "salt"])
        .select(
            "name",
            F.lit("source feeds several destinations").alias("violation"),
            F.col("source_ref").alias("detail"),
        )
    )
    return own.unionByName(duplicates).unionByName(shared)


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _salted(rows: DataFrame) -> DataFrame:
    salt = F.pmod(F.xxhash64("name", "source_ref"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt)


def _per_salt(small: DataFrame) -> DataFrame:
    """Every row once for each salt: one row per source times ``SALTS``."""
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
