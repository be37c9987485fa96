"""Quality classifier: gated-attention multiple-instance learning over the passages of a document.

A document is a bag of passages, pieces of ``PASSAGE`` bytes of its whole text. Each passage becomes
shares of character classes, of hashed pairs of classes, of hashed words and of repeated words; a learned
layer, which holds an embedding for each slot of the hashed words, encodes it as h. The gate
w . (tanh(V h) * sigmoid(U h)) gives attention weights over the bag by softmax, and a logistic layer scores
the weighted sum. Only document labels are known; the model learns by itself which passages tell. It is
fitted in one task on at most ``max_training`` labelled documents, drawn by a hash of doc_id, on all of
their passages; documents of any size are scored where they lie. Passages are encoded ``SLICE`` at a time,
so a very long text needs little more memory than its bytes, for scoring, and 1.5 times that for fitting.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logferry.llm.arrays import buffer, column, mixed, pieces

PASSAGE = 512
MAX_TRAINING = 4000
#: Passages encoded at once, and passages of a fitting step, about: a step takes whole bags.
SLICE = 8192
STEP_PASSAGES = 4096
#: Fitting steps and rounds over all bags, at least.
STEPS, ROUNDS = 400, 4
THRESHOLD = 0.7
HIDDEN, GATE = 16, 8
PAIRS = 64
WORDS = 256

# Classes of bytes: lower, upper, digit, space, line end, letters beyond ASCII, and each other sign.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[128:] = 0, 1, 2, 3, 4, 5
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_SIGNS] = np.arange(6, 6 + len(_SIGNS), dtype=np.uint8)
CLASSES = 6 + len(_SIGNS)
_PAIR = np.random.Generator(np.random.PCG64(3)).integers(0, PAIRS, CLASSES * CLASSES).astype(np.uint8)
_BYTE = np.random.Generator(np.random.PCG64(4)).integers(1, 2**62, 256, dtype=np.int64)
FEATURES = CLASSES + PAIRS + WORDS + 5
#: The least spread that a slot of words is scaled by: slots of rare words stay small.
RARE = 0.25
LEARNT = ("W", "V", "U", "w", "c", "b")


def _cut(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of every passage, and its number in it; an empty text has one passage."""
    counts = np.maximum(1, -(-sizes // PASSAGE))
    owner = np.repeat(np.arange(len(sizes)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def passages(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of all passages of the texts in ``data``, ``SLICE`` at a time, and the text of each.

    An empty text has one passage without any feature but the bias. A word ends where its passage does.
    """
    owner, nth = _cut(np.diff(at))
    start = at[owner] + nth * PASSAGE
    length = np.minimum(PASSAGE, at[owner + 1] - start).clip(0)
    for low in range(0, len(owner), SLICE):
        own = slice(low, low + SLICE)
        begin = start[own][0]
        yield _features(data[begin : begin + int(length[own].sum())], length[own]), owner[own]


def _features(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Features of passages that lie one after the other in ``data``."""
    n = len(length)
    out = np.zeros((n, FEATURES), np.float32)
    out[:, -1] = 1
    if not len(data):
        return out
    passage = np.repeat(np.arange(n), length)
    kind = _CLASS[data]
    size = np.maximum(1, length)[:, None]
    out[:, :CLASSES] = np.bincount(passage * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES) / size
    same = passage[1:] == passage[:-1]
    pair = _PAIR[kind[:-1].astype(np.int64) * CLASSES + kind[1:]][same]
    out[:, CLASSES : CLASSES + PAIRS] = np.bincount(passage[1:][same] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS) / size
    # Words: runs of other bytes than white space; equal neighbours are repeats.
    inside = (kind != 3) & (kind != 4)
    goes_on = np.zeros(len(data) + 1, bool)
    goes_on[1:-1] = inside[1:] & inside[:-1] & same
    first, last = np.flatnonzero(inside & ~goes_on[:-1]), np.flatnonzero(inside & ~goes_on[1:]) + 1
    rest = CLASSES + PAIRS + WORDS
    if len(first):
        # A word's hash is the sum of hashes of its bytes and of its pairs of neighbouring bytes.
        lower = np.where(kind == 1, data | 32, data)
        code = _BYTE[lower]
        code[1:] += np.where(goes_on[1:-1], _BYTE[lower[:-1]] * (2 * _BYTE[lower[1:]] + 1), 0)
        total = np.concatenate([[0], np.cumsum(code, dtype=np.int64)])
        value = mixed((total[last] - total[first]).view(np.uint64))
        where = passage[first]
        words = np.bincount(where, minlength=n)
        slot = (value >> np.uint64(40)).astype(np.int64) % WORDS
        counted = np.bincount(where * WORDS + slot, minlength=n * WORDS).reshape(n, WORDS)
        out[:, CLASSES + PAIRS : rest] = np.sqrt(counted / np.maximum(1, words)[:, None])
        for col, gap in ((0, 1), (1, 2)):
            equal = (value[gap:] == value[:-gap]) & (where[gap:] == where[:-gap])
            out[:, rest + col] = np.bincount(where[gap:][equal], minlength=n) / np.maximum(1, words)
        out[:, rest + 2] = words / size[:, 0] * 4
    out[:, rest + 3] = np.log1p(length) / np.log1p(PASSAGE)
    return out


def _softmax_by(owner: np.ndarray, gate: np.ndarray, bags: int) -> np.ndarray:
    top = np.full(bags, -np.inf, gate.dtype)
    np.maximum.at(top, owner, gate)
    e = np.exp(gate - top[owner])
    return e / np.bincount(owner, e, bags)[owner]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scaled(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.clip((x - p["mean"]) * p["scale"], -8, 8)


def _layers(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of passages with scaled features: their encoding, and both factors of the gate."""
    h = np.tanh(x @ p["W"])
    return h, np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])


def _looked(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gate of every passage and what it says of its bag."""
    h, tv, su = _layers(p, x)
    return (tv * su) @ p["w"], h @ p["c"]


def scores(model: dict[str, np.ndarray], slices: Iterable[tuple[np.ndarray, np.ndarray]], bags: int) -> np.ndarray:
    """The score of every bag, from slices of passages (features, bag)."""
    seen = [(*_looked(model, _scaled(model, x)), owner) for x, owner in slices]
    gate, said, owner = (np.concatenate(v) for v in zip(*seen, strict=True))
    a = _softmax_by(owner, gate, bags)
    return _sigmoid(np.bincount(owner, a * said, bags) + model["b"])


def loss(p: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """Mean weighted cross entropy of the bags, whose passages have scaled features."""
    gate, said = _looked(p, x)
    z = _sigmoid(np.bincount(owner, _softmax_by(owner, gate, len(labels)) * said, len(labels)) + p["b"])
    return float(-(weight * (labels * np.log(z) + (1 - labels) * np.log(1 - z))).mean())


def gradient(p: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of ``loss``, summed over slices of passages."""
    bags = len(labels)
    cuts = [slice(k, k + SLICE) for k in range(0, len(x), SLICE)]
    gate, said = (np.concatenate(v) for v in zip(*(_looked(p, x[k]) for k in cuts), strict=True))
    a = _softmax_by(owner, gate, bags).astype(p["W"].dtype)
    pooled = np.bincount(owner, a * said, bags)
    dz = (weight * (_sigmoid(pooled + p["b"]) - labels) / bags).astype(a.dtype)
    weighed = dz[owner] * a
    dgate = weighed * (said - pooled[owner]).astype(a.dtype)
    grad = {k: np.zeros_like(p[k]) for k in LEARNT}
    grad["b"] = grad["b"] + dz.sum()
    for k in cuts:
        h, tv, su = _layers(p, x[k])
        dg = dgate[k, None] * p["w"]
        dv, du = dg * su * (1 - tv**2), dg * tv * su * (1 - su)
        dh = weighed[k, None] * p["c"] + dv @ p["V"].T + du @ p["U"].T
        grad["c"] += h.T @ weighed[k]
        grad["w"] += (tv * su).T @ dgate[k]
        grad["V"] += h.T @ dv
        grad["U"] += h.T @ du
        grad["W"] += x[k].T @ (dh * (1 - h**2))
    return grad


def _standard(x: np.ndarray) -> dict[str, np.ndarray]:
    """Mean and scale of every feature, over slices."""
    total, squares = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for k in range(0, len(x), SLICE):
        part = x[k : k + SLICE].astype(np.float64)
        total += part.sum(axis=0)
        squares += (part**2).sum(axis=0)
    mean = total / len(x)
    spread = np.sqrt(np.maximum(0, squares / len(x) - mean**2))
    least = np.full(len(mean), 1e-3)
    least[CLASSES + PAIRS : CLASSES + PAIRS + WORDS] = RARE
    mean[-1], spread[-1] = 0, 1
    return {"mean": mean.astype(np.float32), "scale": (1 / np.maximum(spread, least)).astype(np.float32)}


def _steps(counts: np.ndarray, draw: np.random.Generator) -> list[np.ndarray]:
    """All bags in a drawn order, cut into steps of about ``STEP_PASSAGES`` passages."""
    order = draw.permutation(len(counts))
    step = (np.cumsum(counts[order]) - counts[order]) // STEP_PASSAGES
    return np.split(order, np.flatnonzero(np.diff(step)) + 1)


def fitted(x: np.ndarray, owner: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = 0.02) -> dict[str, np.ndarray]:
    """The model after Adam steps on whole bags; both labels weigh the same in total.

    ``owner`` ascends. Every round takes all bags once; rounds go on for ``steps`` steps and ``ROUNDS`` rounds at least.
    """
    draw = np.random.default_rng(7)
    bags = len(labels)
    p = {
        "W": draw.normal(0, 0.15, (x.shape[1], HIDDEN)), "V": draw.normal(0, 0.3, (HIDDEN, GATE)), "U": draw.normal(0, 0.3, (HIDDEN, GATE)),
        "w": draw.normal(0, 0.3, GATE), "c": draw.normal(0, 0.3, HIDDEN), "b": np.zeros(()),
    }
    p["W"][CLASSES + PAIRS : CLASSES + PAIRS + WORDS] /= 5
    p = _standard(x) | {k: v.astype(np.float32) for k, v in p.items()}
    ones = max(1, int(labels.sum()))
    weight = np.where(labels == 1, bags / (2 * ones), bags / (2 * max(1, bags - ones))).astype(np.float32)
    xs = np.empty(x.shape, np.float16)
    for k in range(0, len(x), SLICE):
        xs[k : k + SLICE] = _scaled(p, x[k : k + SLICE])
    counts = np.bincount(owner, minlength=bags)
    first = np.cumsum(counts) - counts
    m, v = ({k: np.zeros_like(p[k]) for k in LEARNT} for _ in range(2))
    each = len(_steps(counts, draw))
    total = max(ROUNDS, -(-steps // each)) * each
    step = 0
    while step < total:
        for chosen in _steps(counts, draw):
            step += 1
            sizes = counts[chosen]
            at = np.repeat(first[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            grad = gradient(p, xs[at].astype(np.float32), np.repeat(np.arange(len(chosen)), sizes), labels[chosen], weight[chosen])
            # Steps get shorter, so that the last bags seen do not weigh more.
            now = rate * max(0.05, 1 - step / total)
            for k in LEARNT:
                g = grad[k] + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = (p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def _flat(model: dict[str, np.ndarray]) -> list[tuple[str, list[int], list[float]]]:
    return [(k, list(np.shape(v)), np.ravel(v).astype(float).tolist()) for k, v in model.items()]


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    labels: list[int] = []
    for piece in pieces(batches, "text"):
        for x, owner in passages(*buffer(piece)):
            parts.append(x.astype(np.float16))
            owners.append(owner + len(labels))
        labels += column(piece, "quality").to_pylist()
    if labels:
        x = np.concatenate(parts)
        parts.clear()
        names, shapes, values = zip(*_flat(fitted(x, np.concatenate(owners), np.array(labels, np.float32))), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(shapes, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], ["name", "shape", "value"])


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``remainder``; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def train(docs: DataFrame, labels: DataFrame, max_training: int = MAX_TRAINING) -> dict[str, np.ndarray] | None:
    """The model from labelled rows outside the held-out part; None where there is no label.

    The sample takes the ``max_training`` rows with the lowest hash of doc_id; of rows that share a doc_id
    the least text is learnt from.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.where(~held_out(4, 2)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_training)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    one = texts.repartition(1).sortWithinPartitions("doc_id").select("quality", "text")
    rows = one.mapInArrow(_fit, "name string, shape array<int>, value array<double>").collect()
    return {r.name: np.array(r.value, np.float32).reshape(r.shape) for r in rows} or None


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) after its own columns.

    ``labels`` has doc_id and quality; only rows whose crc32(doc_id) mod 4 is not 2 are learnt from. Null
    text counts as empty. Without any label every score is 0.5. Columns of ``docs`` named score or
    predicted are replaced. Of several labels of a doc_id the higher holds.
    """
    model = train(docs, labels)
    own = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in own]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            if model is None:
                found = np.full(piece.num_rows, 0.5)
            else:
                found = scores(model, passages(*buffer(piece)), piece.num_rows).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*(column(piece, n) for n in names), pa.array(found)], [*names, "score"])

    out = docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(score, StructType([*own, StructField("score", DoubleType())]))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
