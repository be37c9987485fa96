"""Mixing sources to target weights with exact quotas, through a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a hash of its documents; the number of blocks is about the square
root of the number of rows, so neither the blocks of a source nor the documents of a block are many. A
source that gets more words than it has gives whole passes over its blocks first; the rest is a prefix
of its blocks in permuted order, the last one in part. A binary tree over the output shards splits the
numbers of drawn blocks: at each node the left half draws its share from all sources' blocks without
replacement, so quotas add up exactly and every shard has the mixture in expectation. A shard then
takes disjoint runs of each source's permuted blocks and orders its documents by a hash.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logferry.llm.store import written

WEIGHTS = (3, 1, 2)
SHARDS = 16
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: its size, its target, and the words that it gives (the target, rounded).

    Sources in order of code points, null last, weigh 3, 1, 2 and so on, and share 150 % of all words. A
    target stops at twice its source's size. Going up by size over weight, the capped sources are a
    prefix; the others share what is left by weight. One row per source meets in one task.
    """
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("place")).rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("due", 3 * F.sum("source_size").over(every) - 4 * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", F.expr("4 * source_size * left <= weight * due"))
    )
    level = F.max(F.when(~F.col("capped"), F.struct("left", "due"))).over(every)
    return (
        ranked.withColumn("level", level)
        .withColumn("target", F.expr("CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(weight * level.due AS DOUBLE) / (2 * level.left) END"))
        .withColumn("goal", F.least(F.round("target").cast("long"), 2 * F.col("source_size")))
        .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0)))
        .withColumn("rest", F.col("goal") - F.col("passes") * F.col("source_size"))
        .select("source", "source_size", "target", "goal", "passes", "rest")
    )


def splitting_tree(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """``shards`` rows of quotas that add up to ``counts``: each split draws without replacement."""
    quotas = np.zeros((shards, len(counts)), np.int64)

    def split(low: int, high: int, left: np.ndarray) -> None:
        if high - low == 1:
            quotas[low] = left
            return
        middle = (low + high) // 2
        total = int(left.sum())
        draw = np.random.default_rng([seed, low, high])
        part = np.zeros(len(left), np.int64)
        need, rest = total * (middle - low) // (high - low), total
        # One source after the other: its share of what is still to be drawn is hypergeometric.
        for k, n in enumerate(left):
            rest -= int(n)
            if need and n:
                part[k] = _hypergeometric(draw, int(n), rest, need)
                need -= int(part[k])
        split(low, middle, part)
        split(middle, high, left - part)

    split(0, shards, counts.astype(np.int64))
    return quotas


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, sample: int) -> int:
    if good + bad < 10**9:
        return int(draw.hypergeometric(good, bad, sample))
    return _inverted(draw.random(), good, bad, sample)


def _inverted(u: float, good: int, bad: int, sample: int) -> int:
    """The hypergeometric number at the quantile ``u``, for urns beyond the generator's range.

    Log probabilities are summed up from the ratios of neighbours around the mode. Twelve standard deviations
    leave out less than a double can tell from zero; how many numbers they hold grows with the urn's root.
    """
    n = good + bad
    least, most = max(0, sample - bad), min(good, sample)
    mode = min(most, max(least, (good + 1) * (sample + 1) // (n + 2)))
    spread = math.sqrt(sample * (good / n) * (bad / n) * (n - sample) / (n - 1))
    reach = 12 * math.ceil(spread + 1)
    low, high = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(sample - k) - np.log(k + 1) - np.log(bad - sample + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    share = np.cumsum(np.exp(logs - logs.max()))
    return low + int(min(np.searchsorted(share, u * share[-1], side="right"), high - low))


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def _matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on equal keys, null being equal to null."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in on})
    condition = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return left.join(renamed, condition).drop(*[f"_{c}" for c in on])


def mixture(docs: DataFrame, shards: int = SHARDS, seed: int = 5) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with its part in the mix.

    Gives doc_id, source, row_hash, size, source_size, target, copies, an array of (shard, words) with one
    entry for each time that a shard takes words of the document, and taken, the words of its copies: what
    the tree's quotas give to no shard is not taken. Null text has size 0, null
    source is a source of its own, and rows with equal doc_id are told apart by size only; equal rows
    are interchangeable. An empty table gives no rows. Other columns are ignored.
    """
    text_hash = _hash(F.lit("doc"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    sizes = written(
        docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), text_hash.alias("row_hash")), "sizes"
    )
    rows = sizes.count()
    blocks_each = max(1, math.ceil(math.sqrt(rows)))
    sizes = sizes.withColumn("block", F.pmod(_number(F.col("row_hash")), F.lit(blocks_each)))
    by_source = written(targets(sizes), "targets")

    permuted = Window.partitionBy("source").orderBy("block_hash", "block")
    blocks = (
        sizes.groupBy("source", "block")
        .agg(F.sum("size").alias("block_size"))
        .withColumn("block_hash", _hash(F.lit("block"), F.col("block").cast("string"), F.coalesce("source", F.lit(""))))
        .withColumn("end", F.sum("block_size").over(permuted.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("place", F.row_number().over(permuted) - 1)
        .withColumn("blocks", F.count(F.lit(1)).over(Window.partitionBy("source")))
    )
    joined = written(
        _matched(blocks, by_source, ["source"])
        .withColumn("before", F.col("end") - F.col("block_size"))
        .withColumn("drawn", F.col("before") < F.col("rest")),
        "blocks",
    )
    # Instances of a source's blocks: whole passes first, then the drawn prefix.
    counts = joined.groupBy("source").agg((F.first("passes") * F.first("blocks") + F.sum(F.col("drawn").cast("long"))).alias("n")).orderBy("source").collect()
    quotas = splitting_tree(np.array([r.n for r in counts], np.int64), shards, seed)
    ends = docs.sparkSession.createDataFrame([(r.source, np.cumsum(quotas[:, k]).tolist()) for k, r in enumerate(counts)], "source string, ends array<long>")
    given = "cast(passes + IF(drawn, 1, 0) as int)"
    instance = F.expr(f"transform(sequence(0, {given}), p -> size(filter(ends, e -> e <= p * blocks + place)))")
    plan = (
        _matched(joined, ends, ["source"])
        .withColumn("shards", F.slice(instance, 1, F.expr(given)))
        .withColumn("edge", F.expr("drawn AND before + block_size > rest"))
        .select("source", "block", "source_size", "target", "passes", "rest", "before", "drawn", "edge", "shards")
    )
    placed = _matched(sizes, plan, ["source", "block"])
    # The last drawn block of a source is taken in part, document by document.
    own = Window.partitionBy("source", "block").orderBy("row_hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inner = placed.where("NOT edge").withColumn("part", F.when(F.col("drawn"), F.col("size")).otherwise(F.lit(0)))
    outer = placed.where("edge").withColumn(
        "part", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(own), F.lit(0))))
    )
    columns = ["doc_id", "source", "row_hash", "size", "source_size", "target", "passes", "part", "shards"]
    copies = F.expr(f"filter(transform(shards, (s, i) -> named_struct('shard', s, 'words', IF(i < passes, size, part))), c -> c.words > 0 AND c.shard < {int(shards)})")
    return (
        inner.select(*columns)
        .unionByName(outer.select(*columns))
        .withColumn("copies", copies)
        .withColumn("taken", F.expr("aggregate(copies, 0L, (n, c) -> n + c.words)"))
        .drop("passes", "part", "shards")
    )


ORACLE = """
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('doc|' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS row_hash FROM documents),
n AS (SELECT greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS b FROM sizes),
s AS (SELECT sizes.*, CAST('0x' || substr(row_hash, 1, 12) AS BIGINT) % b AS block FROM sizes, n),
src AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM src),
r AS (SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER o, 0) AS due,
             sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS remaining
      FROM w WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 4 * source_size * remaining <= weight * due AS capped FROM r),
l AS (SELECT max(remaining) AS remaining, max_by(due, remaining) AS due FROM c WHERE NOT capped),
t AS (SELECT c.source, c.source_size, CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
        ELSE CAST(weight * l.due AS DOUBLE) / (2 * l.remaining) END AS target FROM c, l),
g AS (SELECT *, CAST(least(round(target), 2 * source_size) AS BIGINT) AS goal FROM t),
p AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes FROM g),
bl AS (SELECT source, block, sum(size) AS block_size, md5('block|' || CAST(block AS VARCHAR) || '|' || coalesce(source, '')) AS bh FROM s GROUP BY 1, 2),
cum AS (SELECT source, block, block_size,
          sum(block_size) OVER (PARTITION BY source ORDER BY bh, block ROWS UNBOUNDED PRECEDING) - block_size AS before FROM bl),
d AS (SELECT s.doc_id, s.size, p.source_size, p.target, p.passes, p.goal - p.passes * p.source_size AS rest,
        cum.before + coalesce(sum(s.size) OVER (PARTITION BY s.source, s.block ORDER BY s.row_hash, s.doc_id, s.size
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at
      FROM s JOIN cum ON s.source IS NOT DISTINCT FROM cum.source AND s.block = cum.block
             JOIN p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(passes * size + greatest(0, least(size, rest - begin_at)) AS BIGINT) AS taken FROM d
"""
