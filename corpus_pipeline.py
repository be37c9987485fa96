"""A training corpus from raw documents, in five stages, each one operator on all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logferry.llm import mixing
from logferry.llm.decontamination import contaminated, row_key
from logferry.llm.near_duplicates import near_duplicates
from logferry.llm.quality import scored
from logferry.llm.store import table, written
from logferry.llm.surrogates import replaced


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; null and empty texts are judged as empty bags."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    return scored(rows, table(spark, sf_dir, "labels")).where("predicted = 1").select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest doc_id. A null doc_id stays.

    Null, empty and wordless texts are linked with nothing, so they stay. Rows that share a doc_id stay together.
    """
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs.doc_id.eqNullSafe(kept["_kept"]), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no test item; the others go as a whole.

    Null and empty texts cover nothing, so they stay; equal rows stay or go together.
    """
    found = contaminated(docs, table(spark, sf_dir, "benchmark"), shortest=1).select("row_key").distinct()
    rows = row_key(docs.select("doc_id", "text", F.struct("*").alias("row")))
    return rows.join(found, "row_key", "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the changed text.

    Null and empty texts stay as they are, equal rows stay equal, and an empty table stays empty.
    """
    out = replaced(docs, counted=None)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every copy that a shard takes, in the order of shards and shuffled inside them.

    Adds shard, words (taken from this copy) and copy to the columns, in place of columns of these names.
    Rows of equal doc_id, source and size stand for each other. Documents without words, as of null or
    empty text, are in no mix; a null source is a source of its own. An empty table gives an empty mix.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).cast("long")
    same = Window.partitionBy("_id", "_source", "_size").orderBy(F.lit(0))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"), size.alias("_size")).withColumn("_nth", F.row_number().over(same))
    plan = mixing.mixture(docs).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "row_hash", "copies")
    plan = written(plan.withColumn("_nth", F.row_number().over(same)), "mix")
    keys = ["_id", "_source", "_size", "_nth"]
    plan = plan.withColumnsRenamed({c: f"p{c}" for c in keys})
    joined = rows.join(plan, [F.col(c).eqNullSafe(F.col(f"p{c}")) for c in keys])
    copies = joined.select("row", "row_hash", F.posexplode("copies").alias("copy", "part"))
    order = F.md5(F.concat_ws("|", "row_hash", "copy", F.col("part.shard").cast("string")))
    own = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("shard", "words", "copy")]
    return (
        copies.select("row", F.col("part.shard").alias("shard"), F.col("part.words").alias("words"), "copy", order.alias("order"))
        .repartitionByRange("shard", "order")
        .sortWithinPartitions("shard", "order")
        .select(*own, "shard", "words", "copy")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicate_groups),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("mixing", mixture),
]

#: SQL cannot express the classifier, the signatures or the keyed surrogates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
