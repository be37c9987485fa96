"""Alignment of two tokenizers over the same texts, and how often their tokens meet, in Arrow batches.

Tokenizer A is a byte-level BPE and reads a space and the text; B is a piece model, which adds that space
itself. Both cut the same bytes. Where a token of A and a token of B end at the same byte, the text is cut:
between two cuts lies a group, and every token of A in it is linked to every token of B in it.

Documents are taken in blocks of about ``BLOCK_BYTES`` of text. No token reaches over a space that follows
another sign, so a block's different words are encoded and aligned once each, and documents are lists of
words. Token lists are flattened, each token knows its word by its parent index, byte ends are running sums
that begin anew in each word, and cuts are an Acero hash join of both sides on (word, end). A block's
pairs are counted by ``Table.group_by``; Spark adds these partial counts up for the corpus, and each block
gets back the counts of its own pairs. Only pairs, a few per cent of the tokens, are shuffled by token; a
block's documents stay one packed row.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logferry.llm.arrays import column, pieces, texts
from logferry.llm.store import written

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Pairs that are held at once while a block's groups are multiplied out.
PAIRS = 1 << 22

# How byte-level BPE splits words, and the sign that stands for a space in pieces.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs are their own
    code, the other bytes follow from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


#: A space at the beginning or behind white space, where words may not be cut.
_INSIDE = "^ |[\\t-\\r\\x1c-\\x1f \\x{85}\\p{Z}] "


def words(text: str) -> list[str]:
    """``text`` cut at each space that follows a sign that is no white space; that space is left out.

    With a space put before each word, no token of either kind reaches over a cut: A's words end there, and
    no piece of B has a space behind another sign (``PieceTokens`` checks it).
    """
    first, *parts = text.split(" ")
    out = [first]
    for before, part in zip([first, *parts], parts, strict=False):
        if before and not before[-1].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


def _split(contents: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Order of the documents, their words in a row and how many words each has; no text, no word."""
    raw = pa.array(contents, pa.large_string())
    odd = pc.match_substring_regex(raw, _INSIDE).to_numpy(zero_copy_only=False)
    order = np.argsort(odd, kind="stable")
    plain = pc.split_pattern(raw.take(pa.array(order[: len(odd) - odd.sum()])), " ")
    n_plain = pc.list_value_length(plain).to_numpy(zero_copy_only=False) * (pc.binary_length(raw).to_numpy(zero_copy_only=False)[order[: len(plain)]] > 0)
    some = plain.filter(pa.array(n_plain > 0))
    rest = [words(contents[d].decode()) for d in order[len(plain) :].tolist()]
    flat = pa.concat_arrays([pc.list_flatten(some), pa.array(itertools.chain.from_iterable(rest), pa.large_string())])
    return order, flat, np.concatenate([n_plain, np.array(list(map(len, rest)), np.int64)]).astype(np.int64)


class ByteTokens:
    """Byte-level BPE from the JSON of its vocabulary. A merge's rank is its token's id, which is checked;
    names of special tokens are ordinary text."""

    def __init__(self, content: bytes):
        whole = json.loads(content)
        model = whole["model"]
        sign = byte_of_sign()
        spelled = {word: i for word, i in model["vocab"].items() if all(c in sign for c in word)}
        merges = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
        ids = [spelled[m.replace(" ", "")] for m in merges]
        if any(b <= a for a, b in zip(ids, ids[1:], strict=False)):
            raise ValueError("the vocabulary's ids do not follow its merges")
        self.bytes = [b""] * (max(model["vocab"].values()) + 1)
        for word, i in spelled.items():
            self.bytes[i] = bytes(sign[c] for c in word)
        special = {t["id"] for t in whole["added_tokens"] if t["special"]}
        ranks = {self.bytes[i]: i for i in spelled.values() if i not in special}
        self._encoding = tiktoken.Encoding("byte", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

        self.widths = np.array([len(w) for w in self.bytes], np.int64)

    def encode(self, words: list[str]) -> pa.Array:
        """The tokens of each word with a space before it. Words that end in no white space are encoded in
        one go, since A begins anew at the space between them."""
        one = [i for i, w in enumerate(words) if w and not w[-1].isspace()]
        alone = [i for i, w in enumerate(words) if not w or w[-1].isspace()]
        tokens = np.asarray(self._encoding.encode_to_numpy("".join([" " + words[i] for i in one]), disallowed_special=()), np.int32)
        ends = np.cumsum([1 + len(words[i].encode()) for i in one], dtype=np.int64)
        stops = np.searchsorted(np.cumsum(self.widths[tokens]), ends) + 1
        parts = [self._encoding.encode_ordinary(" " + words[i]) for i in alone]
        lists = pa.concat_arrays([
            pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], stops])), pa.array(tokens)), pa.array(parts, pa.large_list(pa.int32()))
        ])
        back = np.empty(len(words), np.int64)
        back[np.array(one + alone, np.int64)] = np.arange(len(words))
        return lists.take(pa.array(back))


class PieceTokens:
    """A piece model; pieces that stand for one byte are that byte. The model adds the leading space."""

    def __init__(self, content: bytes):
        self._model = model = sentencepiece.SentencePieceProcessor(model_proto=content)
        piece = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in piece):
            raise ValueError("a piece has a space behind another sign, so texts cannot be cut into words")
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(piece)]
        self._space = [model.piece_to_id(SPACE)]

        self.widths = np.array([len(w) for w in self.bytes], np.int64)

    def encode(self, words: list[str]) -> pa.Array:
        """The tokens of each word with a space before it."""
        # The model gives no piece for an empty text, not even for the space before it.
        return pa.array([ids or self._space for ids in self._model.encode(words, num_threads=1)], pa.large_list(pa.int32()))


def packed(values: np.ndarray) -> bytes:
    """Small numbers in few bytes: their four byte planes one after the other, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpacked(content: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(content, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n).astype(np.int64)


class Side:
    """The tokens of one tokenizer over the different words of a block."""

    def __init__(self, lists: pa.Array, vocabulary: pa.Array, widths: np.ndarray):
        self.tokens = pc.list_flatten(lists).to_numpy()
        self.parents = pc.list_parent_indices(lists).to_numpy()
        self.n = pc.list_value_length(lists).to_numpy()
        ends = np.concatenate([[0], np.cumsum(widths[self.tokens], dtype=np.int64)])
        last = np.cumsum(self.n)
        # Bytes before each word's first token and up to its last.
        self.starts, self.stops = ends[last - self.n], ends[last]
        self.ends = ends[1:] - self.starts[self.parents]
        joined = vocabulary.take(pa.array(self.tokens)).buffers()[2]
        self._raw = joined.to_pybytes() if joined else b""

    def spelled(self, word: int) -> bytes:
        return self._raw[self.starts[word] : self.stops[word]]

    def keep(self, good: np.ndarray) -> None:
        """Only the tokens of the good words."""
        inside = good[self.parents]
        self.ends, self.tokens, self.parents = self.ends[inside], self.tokens[inside], self.parents[inside]
        self.n = self.n * good

    def table(self, name: str) -> pa.Table:
        return pa.table({"word": self.parents, "end": self.ends, name: np.arange(len(self.tokens))})

    def cut(self, at: np.ndarray) -> None:
        """Number the groups, which the tokens at ``at`` end."""
        last = np.zeros(len(self.tokens), np.int64)
        last[at] = 1
        self.last = last.astype(bool)
        self.group = np.cumsum(last) - last
        self.sizes = np.bincount(self.group, minlength=len(at))
        self.first = np.cumsum(self.sizes) - self.sizes


def distinct(side: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, token, times) of the different tokens of every group, in the order of groups."""
    keys, times = np.unique((side.group << 32) | side.tokens, return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, times


def linked(a: Side, b: Side, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, pair, times) of a block, sorted: the different pairs of each word and how often it links them.

    Only different tokens of a group are multiplied, at most about ``PAIRS`` pairs at a time.
    """
    group, token, times = distinct(a)
    of_b, token_b, times_b = distinct(b)
    many = np.bincount(of_b, minlength=len(a.sizes))
    begin = np.cumsum(many) - many
    word = np.zeros(len(a.sizes), np.int64)
    word[a.group] = a.parents
    found = []
    for row, k in expanded(many[group]):
        partner = begin[group[row]] + k
        found.append(summed(word[group[row]], token[row] * width + token_b[partner], times[row] * times_b[partner]))
    return merged(found)


def expanded(many: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, k) for each k below ``many[row]``, in pieces of about ``PAIRS``."""
    ends, at = np.cumsum(many), 0
    while at < len(many):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        n = many[at:stop]
        yield np.repeat(np.arange(at, stop), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = stop


def summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per (owner, pair), sorted, with the sum of ``times``. Pairs are below 2^32."""
    keys = (owner << 32) | pair
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new] >> 32, keys[new] & 0xFFFFFFFF, np.add.reduceat(times, new) if len(new) else times


def merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(found) == 1:
        return found[0]
    none = np.zeros(0, np.int64)
    return summed(*(np.concatenate([none, *(f[c] for f in found)]) for c in range(3)))


def written_groups(a: Side, b: Side, n: int, signs_a: pa.Array, signs_b: pa.Array) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3;`` of each of ``n`` words, as bytes. ``signs_a`` has each id twice, with ``,`` and
    ``|`` behind it, ``signs_b`` with ``,`` and ``;``."""
    total = len(a.tokens) + len(b.tokens)
    # Each side's tokens come after those of the other side that lie in earlier (B: or the same) groups.
    sign = np.empty(total, np.int64)
    sign[np.arange(len(a.tokens)) + b.first[a.group]] = a.tokens.astype(np.int64) * 2 + a.last
    sign[np.arange(len(b.tokens)) + (a.first + a.sizes)[b.group]] = len(signs_a) + b.tokens.astype(np.int64) * 2 + b.last
    text = pa.concat_arrays([signs_a, signs_b]).take(pa.array(sign))
    ends = np.frombuffer(text.buffers()[1], np.int64)[: total + 1]
    offsets = ends[np.concatenate([[0], np.cumsum(a.n + b.n)])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), text.buffers()[2]])


_BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>,"
    " n_pairs array<long>, pair_at binary, times binary, first array<int>, second array<int>, documents array<long>"
)


class Aligner:
    """Aligns blocks of documents; made in each task from the contents of the two vocabularies."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        self.a, self.b = ByteTokens(byte_bpe), PieceTokens(piece_bpe)
        self.words_a, self.words_b = (pa.array(t.bytes, pa.large_binary()) for t in (self.a, self.b))
        listed = lambda n, signs: pa.array([f"{i}{s}" for i in range(n) for s in signs], pa.large_binary())
        self.signs_a, self.signs_b = listed(len(self.a.bytes), ",|"), listed(len(self.b.bytes), ",;")

    def sides(self, different: list[str]) -> tuple[Side, Side, np.ndarray]:
        """Both token sides of the words, cut into groups, and which words both tokenizers give back."""
        a = Side(self.a.encode(different), self.words_a, self.a.widths)
        b = Side(self.b.encode(different), self.words_b, self.b.widths)
        good = np.array([a.spelled(i) == b.spelled(i) == b" " + w.encode() for i, w in enumerate(different)], bool)
        a.keep(good)
        b.keep(good)
        both = a.table("at_a").join(b.table("at_b"), ["word", "end"], join_type="inner", use_threads=False)
        a.cut(both["at_a"].to_numpy())
        b.cut(both["at_b"].to_numpy())
        return a, b, good

    def block(self, number: int, doc_ids: pa.Array, contents: list[bytes]) -> list:
        """One row of ``_BLOCK``."""
        n, width = len(contents), len(self.b.bytes)
        order, flat, n_words = _split(contents)
        coded = flat.dictionary_encode()
        word, different = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        a, b, good = self.sides(different)
        owner = np.repeat(np.arange(n), n_words)
        lossless = np.ones(n, bool)
        lossless[owner[~good[word]]] = False
        word, owner = word[lossless[owner]], owner[lossless[owner]]
        n_words = n_words * lossless
        groups = np.bincount(a.parents[a.last], minlength=len(different))
        of_words = lambda values: np.bincount(owner, weights=values[word], minlength=n).astype(np.int64)
        text = written_groups(a, b, len(different), self.signs_a, self.signs_b).take(pa.array(word))
        raw, ends = memoryview(text.buffers()[2] or b""), np.frombuffer(text.buffers()[1], np.int64)[: len(word) + 1]
        stops = ends[np.cumsum(n_words)].tolist()
        # The last group of a document has no sign behind it.
        digests = [hashlib.sha256(raw[i : j - 1]).hexdigest() if j > i else "" for i, j in zip([0, *stops], stops, strict=False)]
        document, pair, times = self._of_documents(owner, word, linked(a, b, width), len(different))
        # Each document has a pair once here, so rows of a pair are documents that hold it.
        counted = pa.table({"pair": pair, "document": document}).group_by("pair", use_threads=False).aggregate([("document", "count")]).sort_by("pair")
        pairs = counted["pair"].to_numpy()
        place = np.searchsorted(pairs, pair)
        n_pairs = np.bincount(document, minlength=n)
        first = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
        # Places grow inside a document; their differences are small.
        steps = np.diff(place, prepend=0)
        steps[first] = place[first]
        return [
            [number], [doc_ids.take(pa.array(order)).to_pylist()], [of_words(a.n)], [of_words(b.n)], [of_words(groups)], [digests], [n_pairs],
            [packed(steps)], [packed(times)], [pairs // width], [pairs % width], [counted["document_count"].to_numpy()],
        ]

    @staticmethod
    def _of_documents(owner: np.ndarray, word: np.ndarray, links: tuple, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, times) from the words of documents and the links of words."""
        of_word, pair, times = links
        many = np.bincount(of_word, minlength=n_words)
        begin = np.cumsum(many) - many
        document, held, n = summed(owner, word, np.ones(len(word), np.int64))
        found = []
        for row, k in expanded(many[held]):
            at = begin[held[row]] + k
            found.append(summed(document[row], pair[at], times[at] * n[row]))
        return merged(found)


def _blocks(vocabularies, block_bytes: int):
    types = [pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    names = [f.split(" ")[0] for f in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*vocabularies.value)
        number = TaskContext.get().partitionId() << 32
        for ids, contents in _gathered(batches, block_bytes):
            row = aligner.block(number, ids, contents)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names)
            number += 1

    return run


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Documents in blocks of about ``limit`` bytes of text, across the borders of batches."""
    ids, contents, held = [], [], 0
    for piece in pieces(batches, "text", limit):
        some = texts(piece)
        size = sum(map(len, some))
        if contents and held + size > limit:
            yield pa.concat_arrays(ids), contents
            ids, contents, held = [], [], 0
        ids.append(column(piece, "doc_id"))
        contents += some
        held += size
    if contents:
        yield pa.concat_arrays(ids), contents


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks that have come together with the corpus counts of their pairs."""
    for batch in batches:
        for k in range(len(batch)):
            row = {c: column(batch, c)[k] for c in batch.schema.names}
            listed = {c: row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_pairs")}
            n_pairs = listed["n_pairs"].to_numpy()
            total = int(n_pairs.sum())
            first = np.cumsum(n_pairs) - n_pairs
            steps, times = unpacked(row["pair_at"].as_py(), total), unpacked(row["times"].as_py(), total)
            run = np.cumsum(steps)
            before = np.concatenate([[0], run])[first]
            place = run - np.repeat(before, n_pairs)
            found = row["counts"].values
            counts, best = np.zeros(max(1, len(found or [])), np.int64), np.zeros(max(1, len(found or [])), np.int64)
            if found is not None and len(found):
                at = found.field("place").to_numpy()
                counts[at], best[at] = found.field("n").to_numpy(), found.field("best").to_numpy(zero_copy_only=False)
            sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[np.concatenate([first, [total]])]) for v in (times, times * best[place], times * counts[place])]
            yield pa.RecordBatch.from_arrays(
                [listed["doc_id"], listed["n_a"], listed["n_b"], listed["n_groups"], *map(pa.array, sums), listed["groups_sha256"]],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def aligned(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Alignment of every row of ``docs`` (doc_id, text), and the links of the corpus.

    The first table has ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``. A pair's
    count is the number of rows whose text links it; ``n_best`` are the links whose count is the highest of
    their token of A, ties included, ``count_sum`` is the sum of the counts of all links. A text that is
    null or empty, or that one of the tokenizers does not give back byte for byte, has zeros and ''. Rows of
    equal doc_id are documents of their own; other columns are ignored; an empty table gives empty tables.
    A very long text is a block by itself. The second table is ``(token_a, token_b, documents, best)``.

    The vocabulary files are read once, by the driver, and are about 2 MB.
    """
    spark = docs.sparkSession
    contents = []
    for path in (byte_bpe, piece_bpe):
        with open(path, "rb") as file:
            contents.append(file.read())
    vocabularies = spark.sparkContext.broadcast(tuple(contents))
    blocks = written(docs.select("doc_id", "text").mapInArrow(_blocks(vocabularies, block_bytes), _BLOCK), "blocks")
    part = blocks.select("block", F.posexplode(F.arrays_zip("first", "second", "documents")).alias("place", "p")).select(
        "block", "place", F.col("p.first").alias("token_a"), F.col("p.second").alias("token_b"), F.col("p.documents").alias("part")
    )
    # One shuffle serves both windows. Rows of a token of A number its different partners in each block, so
    # no token has more than a small share of them.
    pairs = part.repartition("token_a").withColumn("n", F.sum("part").over(Window.partitionBy("token_a", "token_b")))
    pairs = pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("token_a")))
    counts = pairs.groupBy("block").agg(F.collect_list(F.struct("place", "n", "best")).alias("counts"))
    rows = blocks.drop("first", "second", "documents").join(counts.hint("merge"), "block", "left")
    documents = rows.mapInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    links = part.groupBy("token_a", "token_b").agg(F.sum("part").alias("documents"))
    links = links.withColumn("best", F.col("documents") == F.max("documents").over(Window.partitionBy("token_a")))
    return documents, links
