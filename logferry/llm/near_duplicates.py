"""Near-duplicate groups by a multi-index join of MinHash signatures under a Hamming threshold.

A document's set holds its distinct shingles of ``WORDS`` words. Its signature has ``CHUNKS * SPAN``
positions of 16 bits, cut into chunks. For each chunk, every way to leave out ``ERRORS`` positions gives
one key, so two signatures share a key exactly when some chunk differs in at most ``ERRORS`` positions.
By the pigeonhole principle that finds all pairs with at most ``CHUNKS * (ERRORS + 1) - 1`` differing
positions. Pairs beyond are found too when some chunk agrees: at similarity 0.75 exactly, a pair is
missed with probability 8e-7, and at 0.8 with 2e-8. Candidates are confirmed on the full sets.

Equal sets are one node from the start. In a bucket of equal keys, members are first compared with one
member drawn for that bucket. Where a bucket still spans several components, its commonest
component gives its family; nodes of a family outside that component are compared with all of the
family, tile against tile, and only links leave a tile. So a large group of copies costs a few
comparisons per member, a group just below the threshold is compared in blocks, no pairs are emitted
within a group, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.llm.arrays import WordHashes, column, mixed, pieces, texts, words_of
from logferry.llm.components import components
from logferry.llm.store import written

WORDS = 5
CHUNKS, SPAN, ERRORS = 14, 5, 1
POSITIONS = CHUNKS * SPAN
#: A pair of similarity 0.75 has more differing positions than this with probability below 1e-7.
MOST_DIFFERENT = 38
PERCENT = 75
#: Nodes of a family in a tile, about.
TILE = 128
#: Bits of the filter that is broadcast before texts are joined with the nodes that need them: 8 MB.
FILTER_BITS = 1 << 26
#: Orders by which buckets draw a member.
ORDERS = 4

_RNG = np.random.Generator(np.random.PCG64(20))
_FACTOR = _RNG.integers(0, 2**63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 2**63, POSITIONS, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingles; fewer words than ``WORDS`` are one shingle, none are no shingle."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, WORDS)
    x = h[: n - width + 1].copy()
    for k in range(1, width):
        x = x * _BASE + h[k : n - width + 1 + k]
    return np.unique(mixed(x + np.uint64(width)))


def signature(shingles: np.ndarray) -> bytes:
    low = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[at : at + 4096, None] * _FACTOR + _SHIFT).min(axis=0))
    return (mixed(low) >> np.uint64(48)).astype("<u2").tobytes()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for piece in pieces(batches, "text"):
        sizes, digests, signatures = [], [], []
        for text in texts(piece):
            shingles = shingle_set(words_of(text), hashes)
            sizes.append(len(shingles))
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            signatures.append(signature(shingles))
        yield pa.RecordBatch.from_arrays(
            [column(piece, "doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            ["doc_id", "n_shingles", "set_digest", "signature"],
        )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each node, chunk and choice of left-out positions.

    The slot is one hash of that choice and its key: equal keys always meet, and unequal ones that share a
    slot only give candidates, which are confirmed or not.
    """
    kept = list(combinations(range(SPAN), SPAN - ERRORS))
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            n = part.num_rows
            signs = np.frombuffer(b"".join(column(part, "signature").to_pylist()), "<u2").reshape(n, CHUNKS, SPAN)
            keys = [np.ascontiguousarray(signs[:, :, list(k)]).view("<i8").reshape(n, CHUNKS) for k in kept]
            keys = np.stack(keys, axis=2).reshape(n, -1)
            width = keys.shape[1]
            variants = mixed(np.arange(1, width + 1, dtype=np.uint64))
            slots = mixed(keys.view(np.uint64) * _BASE + variants).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots.ravel()), pa.array(np.repeat(column(part, "node").to_numpy(), width))], ["slot", "node"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by slot, those whose slot occurs more than once, and the first and the last slot.

    A slot may go on in the partitions beside this one, so what stands at an end is kept.
    """
    held: pa.RecordBatch | None = None  # the last row so far, which waits for the one after it
    before: int | None = None  # the slot of the row before it

    def kept(rows: pa.RecordBatch, following: int | None) -> pa.RecordBatch:
        slots = column(rows, "slot").to_numpy()
        same = slots[1:] == slots[:-1]
        left = np.concatenate([[before is None or before == slots[0]], same])
        right = np.concatenate([same, [following is None or following == slots[-1]]])
        return rows.filter(pa.array(left | right))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        held, ready = rows.slice(rows.num_rows - 1), rows.slice(0, rows.num_rows - 1)
        if ready.num_rows:
            yield kept(ready, column(held, "slot")[0].as_py())
            before = column(ready, "slot")[-1].as_py()
    if held is not None:
        yield kept(held, None)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures differ in at most ``MOST_DIFFERENT`` positions."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        a, b = (np.frombuffer(b"".join(column(batch, c).to_pylist()), "<u2").reshape(n, POSITIONS) for c in ("sign_a", "sign_b"))
        fit = (a != b).sum(axis=1) <= MOST_DIFFERENT
        yield pa.RecordBatch.from_arrays([column(batch, c).filter(pa.array(fit)) for c in ("a", "b")], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for piece in pieces(batches, "text"):
        found = [shingle_set(words_of(t), hashes).tobytes() for t in texts(piece)]
        yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(found, pa.binary())], ["node", "shingles"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fit = []
        for left, right in zip(column(batch, "set_a"), column(batch, "set_b"), strict=True):
            x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            fit.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
        yield pa.RecordBatch.from_arrays([column(batch, c).filter(pa.array(fit, pa.bool_())) for c in ("a", "b")], ["a", "b"])


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of tiles, the nodes that some signature of the other tile is near to."""
    for batch in batches:
        rows: list[tuple] = []
        for family, tile_x, tile_y, nodes in zip(*(column(batch, c) for c in ("family", "tile_x", "tile_y", "nodes")), strict=True):
            v = nodes.values
            is_x, node, size, component = (v.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            signs = np.frombuffer(b"".join(v.field(4).to_pylist()), "<u2").reshape(len(node), POSITIONS)
            x, y = np.flatnonzero(is_x), np.flatnonzero(~is_x)
            fit = component[x][:, None] != component[y][None, :]
            fit &= 100 * np.minimum.outer(size[x], size[y]) >= PERCENT * np.maximum.outer(size[x], size[y])
            for k in np.flatnonzero(fit.any(axis=1)):
                fit[k] &= (signs[x[k]] != signs[y]).sum(axis=1) <= MOST_DIFFERENT
            for side, found in ((True, x[fit.any(axis=1)]), (False, y[fit.any(axis=0)])):
                rows += [(family.as_py(), tile_x.as_py(), tile_y.as_py(), side, int(node[k]), int(component[k])) for k in found]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["family", "tile_x", "tile_y", "is_x", "node", "component"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links between nodes of different components in each pair of tiles, by full sets."""
    for batch in batches:
        links: list[tuple[int, int]] = []
        for nodes in column(batch, "nodes"):
            v = nodes.values
            is_x, node, component = (v.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            sets = [np.frombuffer(b, np.uint64) for b in v.field(3).to_pylist()]
            y = np.flatnonzero(~is_x)
            values, owner = np.concatenate([sets[k] for k in y]), np.repeat(np.arange(len(y)), [len(sets[k]) for k in y])
            sizes = np.array([len(sets[k]) for k in y])
            for k in np.flatnonzero(is_x):
                at = np.minimum(np.searchsorted(sets[k], values), len(sets[k]) - 1)
                shared = np.bincount(owner[sets[k][at] == values], minlength=len(y))
                fit = (100 * shared >= PERCENT * (len(sets[k]) + sizes - shared)) & (component[y] != component[k])
                links += [(int(node[k]), int(n)) for n in node[y[fit]]]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in links], pa.int64()) for k in range(2)], ["a", "b"])


def _perhaps_in(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id may be among ``nodes``, and all of those that are.

    The broadcast side is a bitmap of ``FILTER_BITS`` bits in pages of 4 KB, whatever the number of nodes.
    """
    filtered = nodes.select((F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)) + 1).alias("bit"))
    pages = filtered.groupBy(F.bitmap_bucket_number("bit").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    placed = docs.withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)) + 1)
    found = placed.join(F.broadcast(pages), F.bitmap_bucket_number("bit") == F.col("page"))
    place = found.withColumn("place", F.bitmap_bit_position("bit").cast("int"))
    byte = "CAST(conv(hex(substring(bits, place DIV 8 + 1, 1)), 16, 10) AS INT)"
    return place.where(f"shiftright({byte}, place % 8) & 1 = 1").select(*docs.columns)


def _sets_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, shingles)`` of the distinct ``nodes``, from their texts; few other texts are shuffled."""
    # An inner join, as Spark would move a semi join below the filter's join, to all the texts.
    nodes = nodes.select("node").distinct()
    return _perhaps_in(docs, nodes).join(nodes.withColumnRenamed("node", "doc_id"), "doc_id").select("doc_id", "text").mapInArrow(_sets, "node long, shingles binary")


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    signs = nodes.select("node", "n_shingles", "signature")
    fitting = f"100 * least(size_a, size_b) >= {PERCENT} * greatest(size_a, size_b)"
    both = pairs.join(signs.toDF("a", "size_a", "sign_a"), "a").join(signs.toDF("b", "size_b", "sign_b"), "b").where(fitting)
    likely = written(both.mapInArrow(_alike, "a long, b long"), "likely")
    sets = _sets_of(likely.select(F.col("a").alias("node")).union(likely.select("b")), docs)
    return written(
        likely.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").mapInArrow(_confirmed, "a long, b long").distinct(),
        "confirmed",
    )


def _links_across(placed: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components among nodes that share a bucket; ``placed`` has slot, node, component."""
    commonest = (
        placed.groupBy("slot", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("slot")
        .agg(F.max_by("component", F.expr("shiftleft(n, 32) | (xxhash64(component, slot) & 4294967295L)")).alias("family"), F.count(F.lit(1)).alias("components"))
        .where("components > 1")
        .drop("components")
    )
    families = written(placed.join(commonest, "slot").select("family", "node", "component").distinct(), "families")
    tiles = families.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    rows = (
        families.join(tiles, "family")
        .join(nodes.select("node", F.col("n_shingles").alias("size"), "signature"), "node")
        .withColumn("tile", F.pmod(F.xxhash64("node", "family"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    )
    entry = ["node", "size", "component", "signature"]
    sides = rows.where("component <> family").select("family", F.col("tile").alias("tile_x"), F.col("other").alias("tile_y"), F.lit(True).alias("is_x"), *entry).union(
        rows.select("family", F.col("other").alias("tile_x"), F.col("tile").alias("tile_y"), F.lit(False).alias("is_x"), *entry)
    )
    keys = ["family", "tile_x", "tile_y"]
    near = written(
        sides.groupBy(*keys)
        .agg(F.collect_list(F.struct("is_x", *entry)).alias("nodes"), F.max("is_x").alias("some_x"))
        .where("some_x")
        .select(*keys, "nodes")
        .mapInArrow(_plausible, "family long, tile_x int, tile_y int, is_x boolean, node long, component long"),
        "plausible",
    )
    return written(
        near.join(_sets_of(near, docs), "node")
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("is_x", "node", "component", "shingles")).alias("nodes"))
        .select("nodes")
        .mapInArrow(_linked, "a long, b long")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "across",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs`` (doc_id, text).

    Null or empty text, and text without words, has an empty set and is linked with nothing. Rows
    that share a doc_id are one document. A null doc_id takes no part in links: its component_id is
    null and it is kept. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    signed = written(docs.mapInArrow(_signed, "doc_id long, n_shingles long, set_digest binary, signature binary"), "signed")
    classes = written(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_digest")
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    # Most slots occur once. Ranges of (slot, node) bring the others together, and split a slot of many nodes.
    ranges = classes.select("node", "signature").mapInArrow(_keyed, "slot long, node long").repartitionByRange("slot", "node")
    keys = written(ranges.sortWithinPartitions("slot").mapInArrow(_shared, "slot long, node long"), "shared")
    # Few orders for all buckets: a node's buckets then mostly draw the same members, so fewer pairs are tried.
    rank = F.xxhash64("node", F.pmod("slot", F.lit(ORDERS)))
    buckets = (
        keys.groupBy("slot")
        .agg(F.count(F.lit(1)).alias("members"), F.min_by("node", rank).alias("drawn"))
        .where("members > 1")
        .drop("members")
    )
    members = written(keys.join(buckets, "slot"), "members")

    def ordered(a: str, b: str) -> list:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    first = members.where("node <> drawn").select(*ordered("node", "drawn")).distinct()
    links = _links(first, classes, docs)
    found = components(links)

    placed = written(members.join(found, "node", "left").select("slot", "node", F.coalesce("component", "node").alias("component")), "placed")
    links = links.union(_links_across(placed, classes, docs))
    labels = components(links)
    linked = classes.join(labels, "node", "left").select("set_digest", F.coalesce("component", "node").alias("component"))
    return (
        signed.join(linked, "set_digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.expr("doc_id <=> component_id"))
    )
