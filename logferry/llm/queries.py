"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logferry.llm import alignment, conversations, language_model, languages, mixing, pages, quality, secrets, token_counts
from logferry.llm.decontamination import contaminated
from logferry.llm.fingerprints import fingerprints
from logferry.llm.near_duplicates import near_duplicates
from logferry.llm.store import table
from logferry.llm.surrogates import replaced


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1).drop("row_key")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality.held_out(4, 2).alias("held_out"), "score", "predicted")


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.languages(table(spark, sf_dir, "documents"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(rows), rows)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))[0]


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_fingerprints, op3_quality, op4_pages, op5_mixing, op6_near_duplicates, op7_surrogates,
        op8_languages, op9_language_model, op10_token_counts, op11_secrets, op12_conversations, op13_alignment,
    )
}
ORACLES = {
    "op5_mixing": mixing.ORACLE, "op10_token_counts": token_counts.ORACLE,
    "op11_secrets": secrets.ORACLE, "op12_conversations": conversations.ORACLE,
}
