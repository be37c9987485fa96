"""Language identification of mixed text: script ranges, n-gram scores of words, Viterbi over words.

A word is a run of letters. Its score for a language is the log likelihood of its byte trigrams, with
word edges, under counts of all training documents of that language (hashed to ``2 ** SLOT_BITS`` slots,
so the model's size does not depend on the data). The script of its first letter narrows the candidates
to the languages that use it. Viterbi with a penalty for every switch labels the words, so that short
foreign words do not break a span and longer passages do.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.llm.arrays import buffer, column, pieces
from logferry.llm.quality import held_out

SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
PENALTY = 12.0
#: A language uses a script if this share of its training words begins with it.
SCRIPT_SHARE = 0.02
#: Code points from which a script's range begins, in order; a range ends where the next begins.
RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = sorted({s for _, s in RANGES})
UNDETERMINED = "und"


_KEPT: list = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point, whether it is a letter and whether it can be in a word; script ranges."""
    if _KEPT:
        return _KEPT[0]
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x33480)]
    letter = np.zeros(0x110000, bool)
    joins = np.zeros(0x110000, bool)
    letter[: len(kinds)] = [k == "L" for k in kinds]
    joins[: len(kinds)] = [k in "LM" for k in kinds]
    _KEPT.append((letter, joins, np.array([c for c, _ in RANGES]), np.array([SCRIPTS.index(s) for _, s in RANGES])))
    return _KEPT[0]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of UTF-8 texts: folded bytes (0 outside words), first and end byte, text, and script.

    Only runs that hold a letter are words.
    """
    letter, joins, starts, scripts = _tables()
    n = len(data)
    code = data.astype(np.int32)
    lead = np.flatnonzero(data >= 0xC2)
    b = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    x, y, z, w = b[lead], b[lead + 1] & 63, b[lead + 2] & 63, b[lead + 3] & 63
    wide = np.where(x < 0xE0, (x & 31) << 6 | y, np.where(x < 0xF0, (x & 15) << 12 | y << 6 | z, (x & 7) << 18 | y << 12 | z << 6 | w))
    code[lead] = np.minimum(wide, 0x10FFFF)
    mask, is_letter = joins[code], letter[code]
    follow = (data & 0xC0) == 0x80
    mask[follow] = is_letter[follow] = False
    for width, least in ((1, 0xC2), (2, 0xE0), (3, 0xF0)):
        at_lead = lead[x >= least]
        into = at_lead + width
        ok = into < n
        mask[into[ok]] = mask[at_lead[ok]]
    folded = data.copy()
    folded[(data >= 65) & (data <= 90)] += 32
    before = np.concatenate([[np.uint8(0)], data[:-1]])
    folded[(before == 0xC3) & (data >= 0x80) & (data <= 0x9E)] += 32
    folded[~mask] = 0
    edges = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    # Texts that touch inside a word are parted.
    inner = at[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < n)])
    if len(inner):
        inner = inner[mask[inner] & mask[inner - 1]]
        first, last = np.sort(np.concatenate([first, inner])), np.sort(np.concatenate([last, inner]))
    if len(first):
        some = np.add.reduceat(is_letter, first) > 0
        first, last = first[some], last[some]
    owner = np.searchsorted(at, first, side="right") - 1
    script = scripts[np.searchsorted(starts, code[first], side="right") - 1]
    return folded, first, last, owner, script


def grams(folded: np.ndarray) -> np.ndarray:
    """Slot of the trigram around every byte."""
    padded = np.concatenate([np.zeros(1, np.uint8), folded, np.zeros(1, np.uint8)]).astype(np.uint32)
    h = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA6B) + padded[2:] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    return (h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - SLOT_BITS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language; slots from ``SLOTS`` on count words by script."""
    total: dict[str, np.ndarray] = {}
    for piece in pieces(batches, "text"):
        data, at = buffer(piece)
        if not len(data):
            continue
        folded, first, last, owner, script = words(data, at)
        slot = grams(folded)
        langs = np.array(column(piece, "lang").to_pylist(), object)
        inside = folded != 0
        text_of = np.repeat(np.arange(piece.num_rows), np.diff(at))
        for lang in sorted(set(langs)):
            mine = langs == lang
            add = total.setdefault(lang, np.zeros(SLOTS + len(SCRIPTS), np.int64))
            add[:SLOTS] += np.bincount(slot[inside & mine[text_of]], minlength=SLOTS)
            add[SLOTS:] += np.bincount(script[mine[owner]], minlength=len(SCRIPTS))
    for lang, counts in total.items():
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found.astype(np.int32)), pa.array(counts[found])], ["lang", "slot", "n"])


#: Languages, log shares of slots (languages x slots), and penalties (languages x scripts). A plain
#: tuple, as it is broadcast.
Model = tuple[list[str], np.ndarray, np.ndarray]


def train(docs: DataFrame) -> Model | None:
    """From text and lang of all rows where crc32(doc_id) mod 5 is not 0; None without such rows.

    What reaches the driver is one count per language and slot: bounded by the number of languages.
    """
    rows = docs.where(~held_out(5, 0)).where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = rows.mapInArrow(_counted, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    if not len(counts):
        return None
    langs = sorted(counts.lang.unique())
    table = np.zeros((len(langs), SLOTS + len(SCRIPTS)))
    table[counts.lang.map({lang: k for k, lang in enumerate(langs)}), counts.slot] = counts.n
    gram, script = table[:, :SLOTS], table[:, SLOTS:]
    gram = np.log((gram + 0.1) / (gram.sum(axis=1, keepdims=True) + 0.1 * SLOTS)).astype(np.float32)
    used = script >= SCRIPT_SHARE * np.maximum(1, script.sum(axis=1, keepdims=True))
    used |= ~used.any(axis=0)
    return langs, gram, np.where(used, 0, -1e4).astype(np.float32)


def viterbi(emission: np.ndarray, at: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of every word. ``at`` has the first word of each text, one entry more than texts.

    All texts of the piece advance together; the shorter ones drop out at the end.
    """
    n, states = emission.shape
    kind = np.min_scalar_type(max(0, states - 1))
    path = np.zeros(n, kind)
    sizes = np.diff(at)
    order = np.argsort(-sizes, kind="stable")
    order = order[: int((sizes > 0).sum())]
    if not len(order) or states == 1:
        return path
    start, length = at[order], sizes[order]
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")
    back = np.zeros((n, states), kind)
    own = np.arange(states, dtype=kind)
    value = emission[start].copy()
    for t in range(1, length[0]):
        m = active[t]
        value = value[:m]
        best = value.argmax(axis=1)
        switch = value[np.arange(m), best] - penalty
        stay = value >= switch[:, None]
        here = start[:m] + t
        back[here] = np.where(stay, own, best[:, None])
        following = np.where(stay, value, switch[:, None]) + emission[here]
        ended = active[t + 1] if t + 1 < length[0] else 0
        if ended < m:
            path[here[ended:m]] = following[ended:m].argmax(axis=1)
        value = following
    short = length == 1
    path[start[short]] = emission[start[short]].argmax(axis=1)
    for t in range(length[0] - 1, 0, -1):
        m = active[t]
        here = start[:m] + t
        path[here - 1] = back[here, path[here]]
    return path


def _label(model: Model | None, piece: pa.RecordBatch, spans: bool) -> tuple[list[str], np.ndarray, list | None]:
    n = piece.num_rows
    names, score = np.full(n, UNDETERMINED, object), np.zeros(n)
    data, at = buffer(piece)
    found = [[] for _ in range(n)] if spans else None
    if model is None or not len(data):
        return names.tolist(), score, found
    langs, gram, penalty = model
    folded, first, last, owner, script = words(data, at)
    if not len(first):
        return names.tolist(), score, found
    slot = grams(folded)
    # Separators count nothing; a word's sum ends where the next word begins.
    emission = np.empty((len(first), len(langs)), np.float32)
    outside = folded == 0
    for k in range(len(langs)):
        value = gram[k][slot]
        value[outside] = 0
        emission[:, k] = np.add.reduceat(value, first)
    emission += penalty.T[script]
    path = viterbi(emission, np.searchsorted(owner, np.arange(n + 1)), PENALTY)
    size = last - first
    by = np.bincount(owner * len(langs) + path.astype(np.int64), size, n * len(langs)).reshape(n, -1)
    some = by.sum(axis=1) > 0
    names[some] = np.array(langs, object)[by.argmax(axis=1)[some]]
    score[some] = by.max(axis=1)[some] / by.sum(axis=1)[some]
    if found is not None:
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cut = np.flatnonzero((np.diff(owner) != 0) | (np.diff(path) != 0))
        for a, b in zip(np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(first) - 1]]), strict=True):
            base = chars[at[owner[a]]]
            found[owner[a]].append({"lang": langs[path[a]], "begin": int(chars[first[a]] - base), "end": int(chars[last[b]] - base)})
    return names.tolist(), score, found


def languages(docs: DataFrame, spans: bool = False) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``docs`` (doc_id, text, lang).

    Learns from the other rows than those with crc32(doc_id) mod 5 = 0. lang_pred is the language that
    labels most bytes of words, score its share; ``und`` and 0 if text is null or has no letter, or if
    nothing could be learnt. ``spans`` adds the labelled spans (lang, begin, end in code points). Other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 8 << 20):
            names, score, found = _label(shared.value, piece, spans)
            out = [column(piece, "doc_id"), column(piece, "held_out"), pa.array(names, pa.string()), pa.array(score)]
            if spans:
                kind = pa.list_(pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
                out.append(pa.array(found, kind))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "held_out", "lang_pred", "score", "spans"][: len(out)])

    schema = "doc_id long, held_out boolean, lang_pred string, score double" + (", spans array<struct<lang:string,begin:long,end:long>>" if spans else "")
    return docs.select("doc_id", held_out(5, 0).alias("held_out"), "text").mapInArrow(label, schema)
