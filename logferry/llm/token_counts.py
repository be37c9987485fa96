"""Token counts of documents in flat token files, which have no index, by a scan for separators.

A token file is a run of 16-bit little-endian token ids; id 0 ends a document. ``write_tokens`` lays out
documents as such files. ``scan`` reads files in blocks, looks for separators in a whole block at once,
and stitches documents that run over block ends with a prefix scan: running sums give a document's
number, a running maximum gives where the one before it ended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logferry.llm.arrays import WordHashes, column, pieces, texts
from logferry.llm.store import scratch

SEPARATOR = 0
BLOCK_TOKENS = 1 << 20
#: Bytes of a token file, about; a task reads one file at a time.
FILE_BYTES = 128 << 20


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (runs without white space) as ids 1 to 65535 of a hashed vocabulary."""
    hashes = WordHashes()
    for piece in pieces(batches, "text"):
        found = []
        for text in texts(piece):
            words = text.split()
            ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)) % np.uint64(65535) + np.uint64(1)
            found.append(ids.astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays([column(piece, c) for c in ("doc_id", "tie", "file")] + [pa.array(found, pa.binary())], ["doc_id", "tie", "file", "tokens"])


def _placed(docs: DataFrame, files: int) -> DataFrame:
    tie = F.xxhash64("text")
    return docs.select("doc_id", "text", tie.alias("tie"), F.pmod(F.xxhash64("doc_id", tie), F.lit(files)).cast("int").alias("file"))


def write_tokens(docs: DataFrame, files: int) -> tuple[str, DataFrame]:
    """Token files under a new folder, ``file=<n>/``, and ``(file, document, doc_id)``: who lies where.

    Documents lie in the order of doc_id, then of a hash of the text. Each document ends with a separator,
    an empty or null text is the separator alone.
    """
    path = scratch(docs.sparkSession, "tokens")
    placed = _placed(docs, files)
    (
        placed.mapInArrow(_encoded, "doc_id long, tie long, file int, tokens binary")
        .repartition(files, "file")
        .sortWithinPartitions("file", "doc_id", "tie")
        .select("file", F.col("tokens").cast("string").alias("value"))
        .write.partitionBy("file")
        .option("lineSep", "\u0000\u0000")
        .text(path)
    )
    order = Window.partitionBy("file").orderBy("doc_id", "tie")
    return path, placed.select("file", "doc_id", (F.row_number().over(order) - 1).cast("long").alias("document"))


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(column(batch, "file").to_pylist(), column(batch, "content"), strict=True):
                tokens = np.frombuffer(content.as_buffer(), "<u2")
                for start in range(0, len(tokens), block_tokens):
                    block = tokens[start : start + block_tokens]
                    ends = np.flatnonzero(block == SEPARATOR) + start
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], pa.string()), pa.array([start // block_tokens], pa.int64()), pa.array([len(block)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                        ["file", "block", "tokens", "ends"],
                    )

    return run


def scan(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(file, document, n_tokens, ended)`` for every document of the token files under ``path``.

    ``file`` is the file's path and ``document`` its number in it. Tokens after the last separator are a
    document that has not ended. Separators are not counted; an empty file has no document.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select(F.col("path").alias("file"), "content")
    blocks = files.mapInArrow(_blocks(block_tokens), "file string, block long, tokens long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    stitched = (
        blocks.withColumn("number", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
        .withColumn("last_end", F.coalesce(F.max(F.array_max("ends")).over(before), F.lit(-1)))
        .withColumn("is_last", F.col("block") == F.max("block").over(whole))
        .withColumn("size", F.sum("tokens").over(whole))
    )
    spans = F.expr(
        "concat(transform(ends, (e, i) -> named_struct('n', e - IF(i = 0, last_end, ends[i - 1]) - 1, 'ended', true)),"
        " IF(is_last AND size - 1 > coalesce(array_max(ends), last_end),"
        " array(named_struct('n', size - 1 - coalesce(array_max(ends), last_end), 'ended', false)), array()))"
    )
    return stitched.select("file", "number", F.posexplode(spans).alias("i", "d")).select("file", (F.col("number") + F.col("i")).alias("document"), F.col("d.n").alias("n_tokens"), F.col("d.ended").alias("ended"))


def token_counts(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens)`` of every row of ``docs`` (doc_id, text), through token files and their scan.

    Null and empty texts have 0 tokens. Rows that share a doc_id are counted apart. Other columns are
    ignored.
    """
    # A text of n bytes has at most (n + 1) / 2 words, so its tokens and separator take at most n + 3 bytes.
    most = docs.select(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(3)).alias("bytes")).first()["bytes"] or 0
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-most // FILE_BYTES))
    path, order = write_tokens(docs, files)
    found = scan(docs.sparkSession, path).withColumn("file", F.regexp_extract("file", "/file=(\\d+)/[^/]*$", 1).cast("int"))
    return order.join(found, ["file", "document"]).select("doc_id", "n_tokens")


ORACLE = "SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents"
