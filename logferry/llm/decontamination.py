"""Benchmark decontamination by greedy string tiling.

Texts become tokens: runs of letters and digits, folded in every script with cases, as 64-bit running
hashes; in scripts without spaces, single characters. A seed is ``SEED`` tokens in a row, or the whole
item if that is shorter. Documents keep only the stretches made of seeds that
some test item has too; every match of ``SEED`` or more tokens lies in such stretches, so tiling them
gives what tiling the whole text would give. A covered item shares at least one seed beside those whose
tokens, taken together, stay below the coverage: so an item's commonest seeds are left out of the index as
far as they do. The others are joined, and each (document, item) pair that shares one is tiled: the longest common stretch of tokens not yet marked is looked for with running
Karp-Rabin hashes and marked, again and again, until none of ``SEED`` tokens is left. Since tiles may lie
in any order, reordered passages are covered too.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.llm.arrays import buffer, column, mixed, pieces
from logferry.llm.store import written

SEED = 4
COVERAGE = 0.5
#: Bits of the filter of benchmark seeds that every task gets: 2 MB, whatever the benchmark's size.
FILTER_BITS = 24

_RNG = np.random.Generator(np.random.PCG64(1))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _folds() -> np.ndarray:
    """Every code point's folded one, where that is single and as long in UTF-8."""
    out = np.arange(0x110000, dtype=np.int32)
    for c in (*range(0xC0, 0xD800), *range(0xF900, 0x20000)):
        folded = chr(c).casefold()
        if len(folded) == 1 and ord(folded) != c and len(folded.encode()) == len(chr(c).encode()):
            out[c] = ord(folded)
    return out


_CASE = _folds()
#: Blocks of scripts that are written without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, Tai scripts, Chinese, Japanese, Yi.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x2E80, 0x312F), (0x3190, 0x9FFF), (0xA000, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFE30, 0xFE6F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))
_ALONE, _BETWEEN = 1, 2
_KIND = np.zeros(0x110000, np.uint8)
for _low, _high in (*UNSPACED, (0xFF00, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF9F)):
    _KIND[_low : _high + 1] = [_BETWEEN if unicodedata.category(chr(c))[0] in "PSZ" else _ALONE for c in range(_low, _high + 1)]
_KIND[0xFF10:0xFF1A] = 0
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with every letter folded in place."""
    out = _FOLD[data]
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    for least, below, width, mask in ((0xC3, 0xE0, 2, 31), (0xE0, 0xF0, 3, 15), (0xF0, 0xF5, 4, 7)):
        lead = np.flatnonzero((data >= least) & (data < below))
        lead = lead[lead + width <= len(data)]
        if not len(lead):
            continue
        code = padded[lead] & mask
        for k in range(1, width):
            code = code << 6 | padded[lead + k] & 63
        new = _CASE[np.minimum(code, 0x10FFFF)]
        changed = new != code
        lead, new = lead[changed], new[changed]
        for k in range(width - 1, 0, -1):
            out[lead + k] = 0x80 | new & 63
            new = new >> 6
        out[lead] = (0x100 - (1 << (8 - width))) | new
    return out


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash (never 0) and first byte of every token in UTF-8 bytes."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    folded = _folded(data)
    inside = _IN_WORD[folded]
    # General punctuation (E2 80 xx) and the Latin-1 signs (C2 xx) separate words.
    lead = np.flatnonzero((data == 0xE2) & (np.concatenate([data[1:], [np.uint8(0)]]) == 0x80))
    for k in range(3):
        inside[np.minimum(lead + k, len(data) - 1)] = False
    lead = np.flatnonzero(data == 0xC2)
    for k in range(2):
        inside[np.minimum(lead + k, len(data) - 1)] = False
    # Scripts without spaces: a character is a token, and their signs separate words.
    cut = np.zeros(len(data) + 5, bool)
    lead = np.flatnonzero(data >= 0xE0)
    if len(lead):
        b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) for k in range(4)]
        wide = b[0] >= 0xF0
        code = np.where(wide, (b[0] & 7) << 18 | (b[1] & 63) << 12 | (b[2] & 63) << 6 | b[3] & 63, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63)
        kind, width = _KIND[np.minimum(code, 0x10FFFF)], np.where(wide, 4, 3)
        alone = kind == _ALONE
        cut[lead[alone]] = cut[(lead + width)[alone]] = True
        for k in range(4):
            inside[np.minimum((lead + k)[(kind == _BETWEEN) & (width > k)], len(data) - 1)] = False
    here, back = np.append(inside, False), np.insert(inside, 0, False)
    first = np.flatnonzero(here & (~back | cut[: len(data) + 1]))
    last = np.flatnonzero(back & (~here | cut[: len(data) + 1]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[folded] * _powers(_STEP, len(data)), dtype=np.uint64)])
    value = mixed((total[last] - total[first]) * _powers(_BACK, len(data))[first])
    return np.maximum(value, np.uint64(1)), first


def _rolling(values: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every stretch of ``length`` values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(values * _powers(_STEP, len(values)), dtype=np.uint64)])
    return mixed((total[length:] - total[:-length]) * _powers(_BACK, n))


def _seeds(values: np.ndarray, length: int) -> np.ndarray:
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = values[:n].copy()
    for k in range(1, length):
        x = x * np.uint64(_STEP) + values[k : n + k]
    return mixed(x)


def _all_in(free: np.ndarray, length: int) -> np.ndarray:
    """Where stretches of ``length`` begin that are free all over."""
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[length:] - total[:-length] == length)


def _most_covered(item: np.ndarray, seeds: np.ndarray) -> int:
    """Tokens of ``item`` that lie in one of the given seeds, sorted: no tiling covers more."""
    length = max(1, min(SEED, len(item)))
    own = _seeds(item, length)
    if not len(own) or not len(seeds):
        return 0
    hit = seeds[np.minimum(np.searchsorted(seeds, own), len(seeds) - 1)] == own
    step = np.zeros(len(item) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(step, at, 1)
    np.add.at(step, at + length, -1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def left_out(seeds: np.ndarray, frequency: np.ndarray, size: int, least: int) -> np.ndarray:
    """Which of an item's seeds, one per position, the index can do without.

    From the commonest on, as long as they cover fewer than ``least`` of the item's ``size`` tokens together.
    """
    length = size - len(seeds) + 1
    out = np.zeros(len(seeds), bool)
    covered, total = np.zeros(size, bool), 0
    distinct, own = np.unique(seeds, return_inverse=True)
    places = np.split(np.argsort(own, kind="stable"), np.cumsum(np.bincount(own, minlength=len(distinct)))[:-1])
    often = np.zeros(len(distinct), np.int64)
    often[own] = frequency
    for k in np.argsort(-often, kind="stable"):
        under = np.unique((places[k][:, None] + np.arange(length)).ravel())
        more = int((~covered[under]).sum())
        if total + more < least:
            covered[under] = True
            out[places[k]] = True
            total += more
    return out


def tiled(text: np.ndarray, item: np.ndarray) -> int:
    """Tokens of ``item`` covered by greedy string tiling with ``text``; zeros in ``text`` match nothing."""
    free_text, free_item = text != 0, np.ones(len(item), bool)

    def matches(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        whole = [_all_in(f, length) for f in (free_text, free_item)]
        a, b = (_rolling(v, length)[w] for v, w in zip((text, item), whole, strict=True))
        return np.intersect1d(a, b), whole[0], whole[1]

    covered = 0
    longest = len(item)
    least = max(1, min(SEED, longest))
    while longest >= least:
        low, high = least - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(matches(middle)[0]) else (low, middle - 1)
        longest = low
        if longest < least:
            break
        shared, in_text, in_item = matches(longest)
        by_hash: dict[int, list[int]] = {}
        for at, value in zip(in_text, _rolling(text, longest)[in_text], strict=True):
            by_hash.setdefault(int(value), []).append(int(at))
        marked = False
        known = set(shared.tolist())
        for at, value in zip(in_item, _rolling(item, longest)[in_item], strict=True):
            if int(value) not in known or not free_item[at : at + longest].all():
                continue
            for there in by_hash[int(value)]:
                if free_text[there : there + longest].all() and (text[there : there + longest] == item[at : at + longest]).all():
                    free_text[there : there + longest] = False
                    free_item[at : at + longest] = False
                    covered += longest
                    marked = True
                    break
        if not marked:  # equal hashes of unequal stretches only
            longest -= 1
    return covered


def _item_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        rows, seeds = [], []
        data, at = buffer(piece)
        for k in range(piece.num_rows):
            rows.append(tokens(data[at[k] : at[k + 1]])[0].view(np.int64))
            seeds.append(_seeds(rows[-1].view(np.uint64), max(1, min(SEED, len(rows[-1])))).view(np.int64))
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([column(piece, "item_id"), pa.array(rows, kind), pa.array(seeds, kind)], ["item_id", "tokens", "seeds"])


def _stretches(bits: np.ndarray, lengths: list[int]):
    """Of each text that has seeds of the filter: key, doc_id, the stretches parted by zeros, and the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - FILTER_BITS)
        for piece in pieces(batches, "text"):
            data, at = buffer(piece)
            values, first = tokens(data)
            # A token may not run over the end of a text: texts are hashed apart where they would touch.
            owner = np.searchsorted(at, first, side="right") - 1
            glued = (at[1:-1] > 0) & (at[1:-1] < len(data))
            cuts = at[1:-1][glued]
            cuts = cuts[_touching(data, cuts)]
            if len(cuts):
                parts = [tokens(data[at[k] : at[k + 1]])[0] for k in range(piece.num_rows)]
                values = np.concatenate(parts) if parts else values
                owner = np.repeat(np.arange(piece.num_rows), [len(p) for p in parts])
            covered = np.zeros(len(values), bool)
            found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
            for length in lengths:
                seeds = _seeds(values, length)
                n = len(seeds)
                slot = seeds >> shift
                hit = (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                hit = np.flatnonzero(hit.astype(bool) & (owner[:n] == owner[length - 1 :][:n]))
                found.append((owner[hit], seeds[hit]))
                for k in range(length):
                    covered[hit + k] = True
            rows: tuple[list, list, list] = ([], [], [])
            under = np.flatnonzero(covered)
            if len(under):
                owners, seeds = (np.concatenate(v) for v in zip(*found, strict=True))
                order = np.argsort(owners, kind="stable")
                owners, seeds = owners[order], seeds[order]
                by_text = np.split(seeds, np.flatnonzero(np.diff(owners)) + 1)
                parts = np.split(under, np.flatnonzero(np.diff(owner[under])) + 1)
                for part, own in zip(parts, by_text, strict=True):
                    rows[0].append(int(owner[part[0]]))
                    rows[1].append(_joined(values, part).view(np.int64))
                    rows[2].append(np.unique(own).view(np.int64))
            kind = pa.list_(pa.int64())
            took = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column(piece, "key").take(took), column(piece, "doc_id").take(took), pa.array(rows[1], kind), pa.array(rows[2], kind)],
                ["key", "doc_id", "stretches", "seeds"],
            )

    return run


def _touching(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Which cuts have bytes of words (or of a sign's encoding) on both sides."""
    word = _IN_WORD[_FOLD[data]]
    return word[cuts - 1] & word[cuts]


def _joined(values: np.ndarray, under: np.ndarray) -> np.ndarray:
    """The tokens at the positions ``under``, with a zero between stretches that do not touch."""
    gaps = np.flatnonzero(np.diff(under) > 1) + 1
    return np.insert(values[under], gaps, np.uint64(0))


def _least(size: int, coverage: float) -> int:
    """Tokens of an item of ``size`` that must be covered."""
    return max(1, math.ceil(size * coverage - 1e-9))


def _indexed(coverage: float):
    """Items with the seeds that the index needs, given how often each of their seeds occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for size, entries in zip(column(batch, "size").to_pylist(), column(batch, "entries"), strict=True):
                place, seeds, often = (pc.struct_field(entries.values, name).to_numpy(zero_copy_only=False) for name in ("place", "seed", "often"))
                order = np.argsort(place)
                seeds = seeds[order]
                kept.append(np.unique(seeds[~left_out(seeds, often[order], size, _least(size, coverage))]))
            yield pa.RecordBatch.from_arrays([column(batch, "number"), pa.array(kept, pa.list_(pa.int64()))], ["number", "seeds"])

    return run


def _tiles(coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matched, sizes = [], []
            for text, item, own in zip(column(batch, "stretches"), column(batch, "tokens"), column(batch, "seeds"), strict=True):
                x, y, z = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (text, item, own))
                z = np.sort(z)
                matched.append(tiled(x, y) if _most_covered(y, z) >= _least(len(y), coverage) else 0)
                sizes.append(len(y))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "key"), column(batch, "doc_id"), column(batch, "item_id"), pa.array(matched, pa.int64()), pa.array(sizes, pa.int64())],
                ["key", "doc_id", "item_id", "matched", "item_tokens"],
            )

    return run


def row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``row_key`` that rows of equal doc_id and text share."""
    return docs.withColumn("row_key", F.md5(F.concat_ws("\u0000", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, shortest: int = SEED) -> DataFrame:
    """``(row_key, doc_id, item_id, matched, item_tokens, coverage)`` for pairs that cover enough of an item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Equal rows of either side give one
    row. Null and empty texts, and items without a letter or digit, match nothing. Items of fewer than
    ``shortest`` tokens match nothing; other items of fewer than ``SEED`` tokens match where all their
    tokens stand in a row. An empty
    benchmark gives no rows. Null ids are kept as they are. Of equally long common stretches the one that
    begins first in the item, then in the text, is marked. A very long text is one row of its task, whose
    stretches alone are shuffled. Other columns are ignored.
    """
    spark = docs.sparkSession
    given = benchmark.select("item_id", "text").distinct().mapInArrow(_item_tokens, "item_id long, tokens array<long>, seeds array<long>")
    number = F.md5(F.concat_ws("|", F.coalesce(F.col("item_id").cast("string"), F.lit("-")), F.col("tokens").cast("string")))
    items = written(given.where(F.size("tokens") >= max(1, shortest)).withColumn("number", number).dropDuplicates(["number"]), "items")
    by_seed = items.select("number", F.size("tokens").alias("size"), F.posexplode("seeds").alias("place", "seed"))
    slots = by_seed.select(F.shiftrightunsigned("seed", 64 - FILTER_BITS).alias("slot")).select((F.col("slot") / 8).cast("long").alias("byte"), F.expr("shiftleft(1, cast(slot % 8 as int))").alias("bit"))
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for byte, bit in slots.groupBy("byte").agg(F.bit_or("bit")).toLocalIterator():
        bits[byte] = bit
    shared = spark.sparkContext.broadcast(bits)
    lengths = sorted(r[0] for r in items.select(F.least(F.size("tokens"), F.lit(SEED))).distinct().collect())
    keyed = row_key(docs.select("doc_id", "text")).withColumnRenamed("row_key", "key")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stretches(shared.value, lengths)(batches)

    found = written(keyed.mapInArrow(stretches, "key string, doc_id long, stretches array<long>, seeds array<long>"), "stretches").dropDuplicates(["key"])
    in_docs = found.select("key", F.explode("seeds").alias("seed"))
    often = by_seed.join(in_docs.groupBy("seed").agg(F.count(F.lit(1)).alias("often")), "seed", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    entries = often.groupBy("number", "size").agg(F.collect_list(F.struct("place", "seed", "often")).alias("entries"))
    index = written(entries.mapInArrow(_indexed(coverage), "number string, seeds array<long>").select("number", F.explode("seeds").alias("seed")), "index")
    pairs = in_docs.join(index, "seed").select("key", "number").distinct()
    tiles = (
        pairs.join(items.select("number", "item_id", "tokens"), "number")
        .join(found.select("key", "doc_id", "stretches", "seeds"), "key")
        .select("key", "doc_id", "item_id", "stretches", "tokens", "seeds")
        .mapInArrow(_tiles(coverage), "key string, doc_id long, item_id long, matched long, item_tokens long")
    )
    return (
        tiles.withColumn("coverage", F.col("matched") / F.col("item_tokens"))
        .where(F.col("coverage") >= coverage)
        .distinct()
        .withColumnRenamed("key", "row_key")
    )
