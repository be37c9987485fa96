"""Arrow batches of texts as numpy arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 4 << 20


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that hold about ``limit`` bytes of ``column``; a longer text comes alone."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return pc.fill_null(column(batch, name).cast(pa.large_binary()), b"").to_pylist()


def buffer(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All texts of the batch as one array of bytes, and where each begins (one entry more than texts)."""
    values = pc.fill_null(column(batch, name).cast(pa.large_binary()), b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class WordHashes(dict):
    """64-bit hash of each word, remembered for frequent words; bounded by forgetting all now and then."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = value
        return value


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return text.lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: near inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
