"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is the weighted set of its words (runs without white space), each weighing as often as it
occurs. For every sample j and word, a hash gives r and c, Gamma(2, 1) each, and b, uniform in [0, 1).
With t = floor(ln(weight) / r + b), the word with the least ln(c) - r * (t - b + 1) is drawn, and (word,
t) is the sample. Two documents agree in a sample with probability sum(min) / sum(max) of their weights,
the generalised Jaccard similarity; the fingerprint is ``SAMPLES`` hashes of 32 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logferry.llm.store import written

SAMPLES = 32
#: Where a text has no word, every sample has this value, which no word gets.
NONE = "f" * 8
#: Ranges of doc_id per shuffle partition, for the order of documents.
RANGES = 4


def _sample(j: int, log_weight: str) -> Column:
    """The drawn word's score in the upper half of a long, its sample's hash in the lower half.

    Nothing is conditional, so that what both texts of a row need is computed once: a weight of zero has
    no logarithm, its score is null, and the minimum passes over it. Scores lie between -96 and 32.
    """
    h = f"xxhash64(term, {j}L)"
    g = f"xxhash64(term, {j}L, 1)"
    part = lambda x, at: f"((shiftrightunsigned({x}, {at}) & 2097151) + 0.5D) / 2097152D"
    r = f"(-ln({part(h, 0)} * {part(h, 21)}))"
    c = f"(-ln({part(h, 42)} * {part(g, 0)}))"
    b = f"({part(g, 21)})"
    t = f"floor({log_weight} / {r} + {b})"
    score = f"ln({c}) - {r} * ({t} - {b} + 1D)"
    return F.min(F.expr(f"shiftleft(cast(({score} + 96D) * 16777216D as long), 32) | (xxhash64(term, {t}) & 4294967294L)"))


def _digest(columns: list[str]) -> Column:
    return F.concat(*[F.coalesce(F.lower(F.lpad(F.hex(F.expr(f"{c} & 4294967295L")), 8, "0")), F.lit(NONE)) for c in columns])


def likeness(a: str, b: str) -> Column:
    """Share of equal samples of two fingerprints: an estimate of the generalised Jaccard similarity."""
    equal = [F.when(F.substring(a, 8 * j + 1, 8) == F.substring(b, 8 * j + 1, 8), 1).otherwise(0) for j in range(SAMPLES)]
    return sum(equal[1:], equal[0]) / F.lit(float(SAMPLES))


def signatures(texts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row per ``keys`` with a fingerprint column for each text column in ``names``.

    The texts of a row are counted word by word, together, so a word that they share is drawn for once.
    Keys should begin with columns by which ``texts`` is already partitioned; then nothing is shuffled.
    """
    def listed(name: str, own: int) -> Column:
        parts = F.split(F.trim(F.regexp_replace(F.col(name), "[\\x20\\x09-\\x0D]+", " ")), " ")
        return F.transform(parts, lambda w: F.struct(F.xxhash64(w).alias("term"), F.lit(own).alias("of"), (F.length(w) > 0).alias("is_word")))

    words = F.array(*[listed(n, k) for k, n in enumerate(names)])
    counted = (
        texts.select(*keys, F.explode(F.flatten(words)).alias("w"))
        .select(*keys, F.col("w.term").alias("term"), F.col("w.of").alias("of"), F.col("w.is_word").alias("is_word"))
        .groupBy(*keys, "term")
        .agg(*[F.sum(F.expr(f"CASE WHEN of = {k} AND is_word THEN 1 ELSE 0 END")).alias(f"n{k}") for k in range(len(names))])
        .select(*keys, "term", *[F.ln(f"n{k}").alias(f"w{k}") for k in range(len(names))])
    )
    samples = [(k, j, f"s{k}_{j}") for k in range(len(names)) for j in range(SAMPLES)]
    drawn = counted.groupBy(*keys).agg(*[_sample(j, f"w{k}").alias(c) for k, j, c in samples])
    return drawn.select(*keys, *[_digest([c for k, _, c in samples if k == own]).alias(n) for own, n in enumerate(names)])


def _ranges(docs: DataFrame) -> Column:
    """Number of the range of doc_id that a row lies in; the bounds are quantiles, null comes last."""
    spark: SparkSession = docs.sparkSession
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n)).first()
    bounds = sorted(set(row[0] or []), reverse=True)
    place = F.size(F.filter(F.lit(bounds) if bounds else F.array().cast("array<bigint>"), lambda b: b > F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(place)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text), of its edited text and their likeness.

    The edited text has its last third replaced by as many code points of the next document in
    descending doc_id (null last, equal ids by text); the last document is followed by the first. Null
    text is empty; a single row is followed by itself. One row per row of ``docs``; other columns are
    ignored. Documents are ordered inside ranges of doc_id, with one text per range carried over.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ranged = docs.withColumn("range", _ranges(docs))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    inside = Window.partitionBy("range").orderBy(*order)
    every = Window.partitionBy("range")
    # The first document of each range, for the last one of the range before.
    heads = ranged.groupBy("range").agg(F.min(F.struct((-F.col("doc_id")).alias("low"), F.xxhash64("text").alias("h"), F.col("text").alias("text"))).alias("head"))
    ring = Window.orderBy("range")
    heads = written(
        heads.select("range", F.col("head.text").alias("text"))
        .withColumn("before", F.coalesce(F.lag("range").over(ring), F.max("range").over(Window.partitionBy())))
        .select(F.col("before").alias("range"), F.col("range").alias("after"), F.col("text").alias("head_text")),
        "heads",
    )
    followed = (
        ranged.withColumn("place", F.row_number().over(inside))
        .withColumn("next_text", F.lead("text").over(inside))
        .withColumn("rows", F.count(F.lit(1)).over(every))
        .join(heads, "range")
        .withColumn("is_last", F.col("place") == F.col("rows"))
        .withColumn("next_text", F.when(F.col("is_last"), F.col("head_text")).otherwise(F.col("next_text")))
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("third", F.expr("cast(n_chars div 3 as int)"))
        .withColumn("edited", F.concat(F.expr("left(text, cast(n_chars as int) - third)"), F.expr("left(next_text, third)")))
    )
    facts = followed.select(
        "range", "place", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.when(F.col("is_last"), F.col("after")).otherwise(F.col("range")).alias("next_range"),
        F.when(F.col("is_last"), F.lit(1)).otherwise(F.col("place") + 1).alias("next_place"),
    )
    signed = signatures(followed.select("range", "place", F.col("text").alias("fingerprint"), F.col("edited").alias("edited_fingerprint")), ["range", "place"], ["fingerprint", "edited_fingerprint"])
    both = written(facts.join(signed, ["range", "place"]), "signed")
    following = both.select(F.col("range").alias("next_range"), F.col("place").alias("next_place"), F.col("fingerprint").alias("next_fingerprint"))
    return both.join(following, ["next_range", "next_place"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
