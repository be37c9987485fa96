"""A hidden Markov language model, trained by Baum-Welch over the whole corpus.

States emit word classes, the hashes of words' last three bytes; a word's probability in its class comes
from the corpus counts. One pass cuts the corpus into pieces of bounded size: each is a row of word
numbers, with one row per distinct word beside it. Word counts are summed from those rows and joined
back to them, so what is shuffled is a piece's vocabulary and not its tokens. Every Baum-Welch step is a
pass over the pieces that adds up expected counts per state and class, exactly over whole texts. Steps
end when the likelihood of the training texts hardly grows. A text's score is its exact likelihood by
the scaled forward recursion over the whole text.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.llm.arrays import column, pieces
from logferry.llm.quality import held_out
from logferry.llm.store import written

STATES = 8
CLASSES = 4096
END = CLASSES
#: Baum-Welch ends after so many steps, or when a step's gain in log10 likelihood a token is below ``GAIN``.
STEPS = 6
GAIN = 1e-3
#: The windows of a text advance together in Baum-Welch; what passes from one to the next is carried exactly.
#: Longer ones need fewer matrices, shorter ones fewer steps and less memory.
WINDOW = 512
#: Windows whose shares are held at once.
TOGETHER = 1000
PIECE = 12 << 20
_PIECE_SCHEMA = "piece string, doc_ids array<long>, held_out array<boolean>, lengths array<int>, tokens binary, classes binary, number int, word binary, n long"


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def _numbered(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Tokens of all texts as numbers in order of first use, 0 after each text; tokens a text; the words, A-Z in lower case."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column(part, "text"), "")))
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
    codes = lists.flatten().dictionary_encode()
    words = codes.dictionary.cast(pa.binary())
    codes = codes.indices.to_numpy()
    # White space at an end of a text leaves an empty string there, which is no word.
    full = pc.binary_length(words).to_numpy() > 0
    is_word = full[codes]
    before = np.concatenate([[0], np.cumsum(is_word, dtype=np.int64)])
    lengths = np.diff(before[np.concatenate([[0], ends])]) + 1
    inside = np.ones(int(lengths.sum()), bool)
    inside[np.cumsum(lengths) - 1] = False
    tokens = np.zeros(len(inside), np.int32)
    tokens[inside] = np.cumsum(full, dtype=np.int32)[codes[is_word]]
    return tokens, lengths, pa.concat_arrays([pa.array([b""]), words.filter(pa.array(full))])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece as one row of tokens (numbers of words, 0 ends a text) and one row per word."""
    kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int64()]
    names = ["piece", "doc_ids", "held_out", "lengths", "tokens", "classes", "number", "word", "n"]
    for part in pieces(batches, "text", PIECE):
        name = uuid.uuid4().hex
        tokens, lengths, vocabulary = _numbered(part)
        held = column(part, "held_out").to_pylist()
        learnt = np.bincount(tokens[np.repeat(~np.array(held, bool), lengths)], minlength=len(vocabulary))
        endings = pc.binary_slice(vocabulary, -3).dictionary_encode()
        classes = np.array([word_class(w) for w in endings.dictionary.to_pylist()], np.uint16)[endings.indices.to_numpy()]
        classes[0] = END
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(([name], [column(part, "doc_id").to_pylist()], [held], [lengths], [tokens.tobytes()], [classes.tobytes()], [None], [None], [None]), kinds, strict=True)], names
        )
        for start in range(0, len(vocabulary), 50_000):
            w = vocabulary[start : start + 50_000]
            k = len(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * k), *(pa.nulls(k, t) for t in kinds[1:6]), pa.array(np.arange(start, start + k, dtype=np.int32)), w, pa.array(learnt[start : start + k])], names
            )


#: Start shares, transitions (states x states) and emissions (states x classes). A plain tuple, as it is broadcast.
Model = tuple[np.ndarray, np.ndarray, np.ndarray]


def first_model(share: np.ndarray) -> Model:
    """Class shares with a disturbance by state, which breaks the symmetry; states tend to stay."""
    draw = np.random.default_rng(9)
    emit = share * draw.gamma(2.0, 0.5, (STATES, len(share))) + 1e-9
    between = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
    return np.full(STATES, 1 / STATES), between, emit / emit.sum(axis=1, keepdims=True)


def _between_windows(model: Model, classes: np.ndarray, begin: np.ndarray, length: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every window, the shares of states at the token before it (0 in a text's first), and what follows its last token.

    A window's steps are one matrix. Carried through the matrices of a text's windows, forwards and
    backwards, these shares are those of the recursion over the whole text, up to their scale.
    """
    start, between64, emit = model
    between = between64.astype(np.float32)
    n, states = len(begin), len(start)
    before, after = np.zeros((n, states), np.float32), np.ones((n, states), np.float32)
    # Windows of one text lie in a row; only texts of two and more need matrices.
    text = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)
    count = np.bincount(text, minlength=len(first))
    many = np.flatnonzero(count[text] > 1)
    if not len(many):
        return before, after
    by_class = np.ascontiguousarray(emit.T).astype(np.float32)
    order = many[np.argsort(-length[many], kind="stable")]
    active = np.searchsorted(-length[order], -np.arange(int(length[order[0]])), side="left")
    # Windows lie along the last axis, so that every operation runs over many of them.
    forth = np.ascontiguousarray(between.T)
    through = np.tile(np.eye(states, dtype=np.float32)[:, :, None], (1, 1, len(order)))
    for t in range(1, len(active)):
        m = active[t]
        moved = np.matmul(forth, through[:, :, :m])
        moved *= np.ascontiguousarray(by_class.take(classes[begin[order[:m]] + t], axis=0).T)
        np.divide(moved, np.maximum(moved.reshape(states * states, m).sum(axis=0), 1e-30), out=through[:, :, :m])
    matrix = np.zeros((n, states, states), np.float32)
    matrix[order] = through.transpose(2, 0, 1)
    opening = by_class[classes[begin]]
    texts_ = np.argsort(-count, kind="stable")
    longest = int(count.max())
    still = np.searchsorted(-count[texts_], -np.arange(longest + 1), side="left")
    for k in range(1, longest):
        here = first[texts_[: still[k]]] + k
        entry = (start.astype(np.float32) if k == 1 else before[here - 1] @ between) * opening[here - 1]
        left = np.einsum("ni,nij->nj", entry, matrix[here - 1])
        before[here] = left / np.maximum(left.sum(axis=1, keepdims=True), 1e-30)
    for k in range(longest - 1, 0, -1):
        here = first[texts_[: still[k]]] + k
        right = np.einsum("nij,nj->ni", matrix[here], after[here]) * opening[here]
        right = right @ between.T
        after[here - 1] = right / np.maximum(right.max(axis=1, keepdims=True), 1e-30)
    return before, after


def expected(model: Model, classes: np.ndarray, lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts, transitions and emissions over whole texts, and their log10 likelihood.

    ``classes`` holds the texts, of ``lengths`` tokens, one after the other. The result does not depend on
    ``window``; time goes by its length and memory by ``TOGETHER`` windows.
    """
    begin, length, opens = _windows(lengths, window)
    started, moved, emitted, likelihood = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(model[2].shape), 0.0
    if not len(begin):
        return started, moved, emitted, likelihood
    before, after = _between_windows(model, classes, begin, length, opens)
    for part in range(0, len(begin), TOGETHER):
        cut = slice(part, part + TOGETHER)
        found = _expected_in(model, classes, begin[cut], length[cut], opens[cut], before[cut], after[cut])
        started, moved, emitted, likelihood = started + found[0], moved + found[1], emitted + found[2], likelihood + found[3]
    return started, moved, emitted, likelihood


def _expected_in(model: Model, classes: np.ndarray, begin: np.ndarray, length: np.ndarray, opens: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The same sums over some windows, by scaled forward-backward between their given ends.

    A window counts the transition to its first token, unless it opens a text.
    """
    start, between, emit = (x.astype(np.float32) for x in model)
    order = np.argsort(-length, kind="stable")
    begin, length, opens, before, after = begin[order], length[order], opens[order], before[order].T, after[order].T
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps + 1), side="left")
    # One column a token, step after step; windows are sorted by length, so a step's columns are the first of the step before.
    ends = np.cumsum(active[:-1])
    at = ends - active[:-1]
    step = np.repeat(np.arange(steps), active[:-1])
    here = classes[begin[np.arange(len(step)) - at[step]] + step].astype(np.intp)
    seen = np.ascontiguousarray(np.ascontiguousarray(emit.T).take(here, axis=0).T)
    alpha, scale = np.empty_like(seen), np.empty(len(here), np.float32)
    forth = np.ascontiguousarray(between.T)
    now = np.where(opens, start[:, None], forth @ before)
    for t in range(steps):
        own = slice(at[t], ends[t])
        if t:
            now = forth @ alpha[:, at[t - 1] : at[t - 1] + active[t]]
        now *= seen[:, own]
        total = np.maximum(now.sum(axis=0), 1e-30, out=scale[own])
        np.divide(now, total, out=alpha[:, own])
    moved = np.zeros(between.shape)
    for t in range(steps - 1, -1, -1):
        own, later = slice(at[t], ends[t]), active[t + 1]
        whole = after[:, : active[t]].copy()
        if later:
            moved += alpha[:, at[t] : at[t] + later] @ ahead.T
            whole[:, :later] = between @ ahead
        # The posteriors take the place of alpha, which no earlier step reads.
        gamma = alpha[:, own] * whole
        total = np.maximum(gamma.sum(axis=0), 1e-30)
        np.divide(gamma, total, out=alpha[:, own])
        whole *= seen[:, own]
        whole /= scale[own] * total
        ahead = whole
    started = alpha[:, : len(begin)][:, opens].sum(axis=1, dtype=np.float64)
    moved += before[:, ~opens] @ ahead[:, ~opens].T
    emitted = np.stack([np.bincount(here, row, emit.shape[1]) for row in alpha])
    return started, moved * model[1], emitted, float(np.log10(scale, dtype=np.float64).sum())


def _windows(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First token, length, and whether it opens a text, of every window of at most ``window`` tokens."""
    at = np.cumsum(lengths) - lengths
    counts = -(-lengths // window)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return at[text] + nth * window, np.minimum(window, lengths[text] - nth * window), nth == 0


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    tokens, classes = np.frombuffer(row["tokens"], np.int32), np.frombuffer(row["classes"], np.uint16)
    return tokens, classes, np.array(row["lengths"], np.int64), np.array(row["held_out"], bool)


def _expected(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(batch.num_rows):
                tokens, classes, lengths, held = _arrays(batch.slice(k, 1).to_pylist()[0])
                found = expected(model.value, classes[tokens[np.repeat(~held, lengths)]], lengths[~held])
                flat = np.concatenate([np.ravel(f) for f in found])
                total = flat if total is None else total + flat
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["slot", "value"])

    return run


def _step(pieces_: DataFrame, model: Model) -> tuple[Model, float]:
    """One Baum-Welch step, and the likelihood before it. One sum per parameter reaches the driver."""
    shared = pieces_.sparkSession.sparkContext.broadcast(model)
    sums = pieces_.mapInArrow(_expected(shared), "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
    flat = np.zeros(STATES + STATES * STATES + STATES * (CLASSES + 1) + 1)
    flat[sums.slot] = sums.value
    start, between, emit = np.split(flat[:-1], [STATES, STATES + STATES * STATES])
    start, between, emit = start + 0.1, between.reshape(STATES, STATES) + 0.1, emit.reshape(STATES, -1) + 1e-3
    return (start / start.sum(), between / between.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)), float(flat[-1])


def log_likelihood(model: Model, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each class sequence, by the scaled forward recursion; texts advance together."""
    start, between, emit = model
    at = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, length = at[order], lengths[order]
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")
    forth, by_class = np.ascontiguousarray(between.T), np.ascontiguousarray(emit.T)
    out = np.zeros(len(lengths))
    alpha = np.tile(start[:, None], len(lengths))
    for t in range(int(length[0])):
        m = active[t]
        alpha = alpha if t == 0 else forth @ alpha[:, :m]
        alpha *= by_class.take(classes[begin[:m] + t], axis=0).T
        scale = alpha.sum(axis=0)
        alpha /= scale
        out[:m] += np.log10(scale)
    result = np.empty(len(lengths))
    result[order] = out
    return result


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, class_n, class_v, total, distinct = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                known = column(one, "known")[0].values
                row = one.drop_columns(["known"]).to_pylist()[0]
                tokens, classes, lengths, held = _arrays(row)
                count = np.zeros(len(classes), np.int64)
                count[pc.struct_field(known, "number").to_numpy(zero_copy_only=False)] = pc.struct_field(known, "c").to_numpy(zero_copy_only=False)
                base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
                inside = np.log10((count + 0.5) / (class_n[classes] + 0.5 * (class_v[classes] + 1)))
                at = np.cumsum(lengths) - lengths
                sums = lambda v: np.add.reduceat(v[tokens], at)
                score = log_likelihood(model, classes[tokens], lengths) + sums(inside)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(held), pa.array(lengths), pa.array(sums((count > 0).astype(np.int64))), pa.array(np.full(len(lengths), total)), pa.array(sums(base)), pa.array(score)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def scored(docs: DataFrame, steps: int = STEPS, gain: float = GAIN) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    Learns from rows whose crc32(doc_id) mod 5 is not 1. Tokens are words with A-Z in lower case and one
    end per text; null text has only the end. base_score is by smoothed unigrams, score by the model,
    both log10. An unseen word has what its class keeps for one; without training rows all is unseen.
    Training takes ``steps`` steps at most and ends when one gains less than ``gain`` a token. Equal rows
    are scored apart; other columns are ignored. A text is scored in one task, whatever its length.
    """
    spark = docs.sparkSession
    cut = written(docs.select("doc_id", held_out(5, 1).alias("held_out"), "text").mapInArrow(_cut, _PIECE_SCHEMA), "pieces")
    rows = cut.where("number IS NULL").select("piece", "doc_ids", "held_out", "lengths", "tokens", "classes")
    entries = cut.where("number IS NOT NULL").select("piece", "number", "word", "n")
    counts = written(entries.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    of_class = F.when(F.length("word") == 0, F.lit(END)).otherwise((F.crc32(F.substring("word", -3, 3)) % CLASSES).cast("int"))
    classes = counts.groupBy(of_class.alias("class")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    class_n, class_v = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    class_n[classes["class"]], class_v[classes["class"]] = classes.n, classes.v
    total, distinct = int(class_n.sum()), int(class_v.sum())

    share = (class_n + 0.5) / (class_n + 0.5).sum()
    model, last = first_model(share), -np.inf
    for _ in range(steps if total else 0):
        model, likelihood = _step(rows, model)
        if likelihood - last < gain * total:
            break
        last = likelihood
    shared = spark.sparkContext.broadcast((model, class_n, class_v, total, distinct))
    known = entries.join(counts, "word").groupBy("piece").agg(F.collect_list(F.struct("number", "c")).alias("known"))
    none = F.array().cast("array<struct<number:int,c:bigint>>")
    return (
        rows.join(known, "piece", "left")
        .withColumn("known", F.coalesce("known", none))
        .mapInArrow(_scores(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
