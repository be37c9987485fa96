"""Mixing against its SQL, near duplicates, fingerprints and tiling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import database
from logferry.llm import decontamination, fingerprints, mixing, near_duplicates
from logferry.llm.arrays import column
from tests.conftest import FOLDER

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture
def odd(spark):
    rows = [
        (1, "a b c d e f g", "en", "s", 1, "x"), (1, "a b c d e f g", "en", "s", 1, "x"), (2, "A b c d e f g", "en", None, 1, "x"),
        (3, None, None, "s", None, "y"), (4, "", "en", "t", 0, None), (5, " \t\n", "en", "t", 3, "z"), (None, "a b c d e f g", "en", "s", 1, "x"),
        (6, "one two", "en", "", 1, "x"), (7, "One\ttwo", "en", "u", 1, "x"), (8, "w" * 100_000 + " " + "v " * 50_000, "en", "u", 1, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


def brute_components(rows):
    sets = {}
    for doc_id, text in rows:
        w = WORD.findall(lowered(text or ""))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in by_shingle.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, documents):
    rng = np.random.default_rng(3)
    base = [str(x) for x in rng.integers(0, 1000, 120)]
    near = []
    for k in range(120):  # a group around the threshold, so that some links are missing inside it
        w = list(base)
        for at in rng.choice(len(w), rng.integers(0, 6), replace=False):
            w[at] = f"new{rng.integers(0, 10**6)}"
        near.append((100_000 + k, " ".join(w)))
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    expected = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == expected


def test_near_duplicates_of_odd_rows(odd):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(odd).collect())
    assert got == [(0, 3, None, True), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (7, 1, 6, False), (8, 2, 8, True)]
    assert near_duplicates.near_duplicates(odd.limit(0)).count() == 0


def test_mixing_equals_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mixture(docs).select("doc_id", "size", "source_size", "target", "taken").toPandas().sort_values("doc_id").reset_index(drop=True)
    want = database("/root/testdata/sf0.01").sql(mixing.ORACLE).df().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == 1000
    assert (got == want[got.columns]).all().all()


def test_mixing_meets_its_targets(documents):
    rows = mixing.mixture(documents).toPandas()
    by = rows.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert ((by.taken - by.target).abs() <= 1).all()
    assert (by.target <= 2 * by["size"]).all() and abs(by.target.sum() - 1.5 * rows["size"].sum()) < 1e-3
    assert (rows.taken <= 2 * rows["size"]).all()
    assert [sum(c.words for c in copies) for copies in rows.copies] == list(rows.taken)


def test_mixing_of_odd_rows(odd):
    rows = mixing.mixture(odd).toPandas()
    assert len(rows) == 10 and rows.taken.sum() == round(1.5 * rows["size"].sum())
    assert mixing.mixture(odd.limit(0)).count() == 0


def test_splitting_tree_adds_up():
    counts = np.array([1000, 3, 0, 77, 10_000])
    quotas = mixing.splitting_tree(counts, 16, 1)
    assert (quotas.sum(axis=0) == counts).all() and (quotas >= 0).all()
    assert np.ptp(quotas.sum(axis=1)) <= 2
    assert (quotas == mixing.splitting_tree(counts, 16, 1)).all()


def test_mixing_goes_through_the_tree(monkeypatch, documents):
    seen, tree = [], mixing.splitting_tree

    def watched(counts, shards, seed):
        seen.append((counts, tree(counts, shards, seed)))
        return seen[-1][1]

    monkeypatch.setattr(mixing, "splitting_tree", watched)
    rows = mixing.mixture(documents).toPandas()
    counts, quotas = seen[0]
    blocks_each = max(1, math.ceil(math.sqrt(len(rows))))
    rows["block"] = [int(h[:12], 16) % blocks_each for h in rows.row_hash]
    drawn = {}
    for r in rows.itertuples():
        for nth, c in enumerate(r.copies):
            drawn.setdefault((r.source, r.block, nth), set()).add(c.shard)
    # An instance of a block lies in one shard only, and no shard has more instances of a source than its quota.
    assert all(len(shards) == 1 for shards in drawn.values())
    sources = sorted(rows.source.unique(), key=lambda s: (s is not None, s))
    held = Counter((source, next(iter(shards))) for (source, _, _), shards in drawn.items())
    for k, source in enumerate(sources):
        got = [held[source, shard] for shard in range(len(quotas))]
        assert all(a <= b for a, b in zip(got, quotas[:, k], strict=True)) and sum(got) >= 0.98 * counts[k]
    monkeypatch.setattr(mixing, "splitting_tree", lambda counts, shards, seed: np.zeros((shards, len(counts)), np.int64))
    assert mixing.mixture(documents).toPandas().taken.sum() == 0


def test_hypergeometric_of_large_urns():
    draw = np.random.default_rng(3)
    for good, bad, sample in ((50, 30, 20), (3, 400, 200), (7, 0, 4), (0, 9, 3), (500, 20, 515)):
        exact = [math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample) if 0 <= sample - k <= bad else 0 for k in range(good + 1)]
        for u in draw.random(50):
            assert mixing._inverted(u, good, bad, sample) == min(int(np.searchsorted(np.cumsum(exact), u, side="right")), min(good, sample))
    values = [mixing._hypergeometric(draw, 6 * 10**9, 4 * 10**9, 10**9) for _ in range(200)]
    assert abs(np.mean(values) - 6 * 10**8) < 5 * 14_700 / math.sqrt(200) and 0.8 < np.std(values) / 14_697 < 1.2


def jaccard(a, b):
    x, y = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints(documents):
    texts = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    rows = {r.doc_id: r for r in fingerprints.fingerprints(documents).collect()}
    assert len(rows) == len(texts)
    errors = []
    for k, (doc_id, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        row = rows[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [row.near_edited - jaccard(text, edited), row.near_next - jaccard(text, after)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1


def test_fingerprints_of_odd_rows(odd):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == 10
    same = {r.fingerprint for r in rows if r.doc_id in (1, None)}
    assert len(same) == 1
    assert {r.fingerprint for r in rows if r.doc_id in (3, 4, 5)} == {"f" * 8 * fingerprints.SAMPLES}
    assert fingerprints.fingerprints(odd.limit(0)).count() == 0
    alone = fingerprints.fingerprints(odd.where("doc_id = 6")).collect()
    assert [(r.near_next, r.n_chars) for r in alone] == [(1.0, 7)]


def brute_tiles(text, item, least=decontamination.SEED):
    text, item, covered = list(text), list(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and item[i + k] is not None:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return covered
        covered += k
        item[i : i + k] = [None] * k
        text[j : j + k] = [0] * k


def test_tiling_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        text = rng.integers(1, 6, rng.integers(4, 60)).astype(np.uint64)
        item = rng.integers(1, 6, rng.integers(4, 30)).astype(np.uint64)
        assert decontamination.tiled(text, item) == brute_tiles(text.tolist(), item.tolist())
    assert decontamination.tiled(np.arange(1, 41, dtype=np.uint64), np.arange(5, 30, dtype=np.uint64)) == 25


def test_contaminated(spark, documents):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    plain = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    want = set()
    for r in documents.collect():
        words = plain(r.text)
        grams = {tuple(words[i : i + 4]) for i in range(len(words) - 3)}
        for item, w in items.items():
            if any(tuple(w[i : i + 4]) in grams for i in range(len(w) - 3)) and brute_tiles(words, w) >= 0.5 * len(w):
                want.add((r.doc_id, item))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(documents, bench).collect()}
    assert got == want and want


def test_left_out_seeds_cover_less_than_asked():
    draw = np.random.default_rng(6)
    for _ in range(200):
        size = int(draw.integers(4, 40))
        seeds = draw.integers(0, 12, size - 3).astype(np.int64)
        often = draw.integers(0, 5, 12)[seeds]
        least = int(draw.integers(1, size + 1))
        out = decontamination.left_out(seeds, often, size, least)
        covered = {k + d for k in np.flatnonzero(out) for d in range(4)}
        assert len(covered) < least and not set(seeds[out]) & set(seeds[~out])
    assert decontamination.left_out(np.array([7, 8, 9]), np.array([1, 1, 1]), 6, 4).sum() == 0
    assert decontamination.left_out(np.array([7, 8, 9]), np.array([1, 1, 5]), 6, 5).tolist() == [False, False, True]


def test_common_phrase_gives_few_tilings(spark, monkeypatch):
    draw = np.random.default_rng(8)
    words = lambda n: " ".join(f"w{k}" for k in draw.integers(0, 3000, n))
    questions = [f"which of the following is true of {words(14)}" for _ in range(300)]
    docs = [f"{words(20)} which of the following is true of {words(20)}" for _ in range(290)] + [f"{words(9)} {q} {words(9)}" for q in questions[:10]]
    counted = spark.sparkContext.accumulator(0)
    tiled = decontamination.tiled

    def watched(text, item):
        counted.add(1)
        return tiled(text, item)

    monkeypatch.setattr(decontamination, "tiled", watched)
    rows = decontamination.contaminated(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(questions)), "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.item_id, r.matched) for r in rows) == [(290 + k, k, 21) for k in range(10)]
    assert 10 <= counted.value <= 0.01 * len(docs) * len(questions)


def test_folding_of_other_scripts(spark):
    items = ["Привет мир, как дела сегодня", "ΟΔΥΣΣΕΎΣ ο πολυμήχανος ήρωας της Ιθάκης", "Žluťoučký kůň úpěl ďábelské ódy", "ｆｕｌｌ ｗｉｄｔｈ ｌｅｔｔｅｒｓ ｈｅｒｅ", "𐐨𐐩 𐐪𐐫 𐐬𐐭 𐐮𐐯"]
    docs = [items[0].upper(), "Οδυσσεύς Ο ΠΟΛΥΜΉΧΑΝΟΣ ΉΡΩΑΣ ΤΗΣ ΙΘΆΚΗΣ", items[2].upper(), items[3].upper(), items[4].upper(), "İstanbul ß ŉ"]
    schema = "{} long, text string"
    rows = decontamination.contaminated(spark.createDataFrame(list(enumerate(docs)), schema.format("doc_id")), spark.createDataFrame(list(enumerate(items)), schema.format("item_id"))).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in rows) == [(k, k, 1.0) for k in range(5)]
    assert decontamination._folded(np.frombuffer(docs[5].encode(), np.uint8)).tobytes().decode() == "İstanbul ß ŉ"


def test_long_matches_take_linear_time():
    text = np.random.default_rng(1).integers(1, 2**60, 200_000).astype(np.uint64)
    assert decontamination.tiled(text, text[50:150_000]) == 149_950


def test_contaminated_reordered_and_odd(spark, odd):
    bench = spark.createDataFrame([(1, "Alpha beta gamma delta. Uno dos tres cuatro; É ß ça oui!"), (2, None), (3, "a b"), (4, ""), (1, "x y z w v")], "item_id long, text string")
    docs = odd.select("doc_id", "text").union(
        spark.createDataFrame([(50, "é SS é ß Ça OUI pad UNO, dos tres cuatro pad alpha beta gamma delta"), (51, "alpha beta gamma pad delta uno dos"), (None, "q x y Z w v q")], "doc_id long, text string")
    )
    got = sorted((r.doc_id or 0, r.item_id, r.matched, r.item_tokens) for r in decontamination.contaminated(docs, bench).collect())
    assert got == [(0, 1, 5, 5), (50, 1, 12, 12)]
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0


def test_contaminated_short_and_unspaced(spark):
    items = ["Paris is", "42", "法国的首都是哪一个城市？巴黎。", "ประเทศไทยมีกี่จังหวัด", "はい", "..."]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = ["so PARIS, is it", "is Paris", "a 42 b", "421", "他说：「法国的首都是哪一个城市」，我说巴黎，对吗", "เขาถามว่าประเทศไทยมีกี่จังหวัดครับ", "「はい。」", "は、い", "是", ""]
    got = {(r.doc_id, r.item_id, r.coverage) for r in decontamination.contaminated(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), bench, shortest=1).collect()}
    assert {(d, i) for d, i, _ in got} == {(0, 0), (2, 1), (4, 2), (5, 3), (6, 4), (7, 4)}
    assert {c for d, _, c in got if d in (0, 2, 5, 6)} == {1.0}


def test_shared_slots_of_sorted_rows_in_any_batches():
    rng = np.random.default_rng(3)
    for _ in range(50):
        slots = np.sort(rng.integers(0, 40, 30))
        table = pa.table({"slot": pa.array(slots, pa.int64()), "node": pa.array(np.arange(30), pa.int64())})
        batches = [b for k in range(0, 30, 4) for b in table.slice(k, 4).to_batches()]
        found = [n for b in near_duplicates._shared(iter(batches)) for n in column(b, "node").to_pylist()]
        wanted = [n for n, s in enumerate(slots) if (slots == s).sum() > 1 or s in (slots[0], slots[-1])]
        assert found == wanted
    assert not list(near_duplicates._shared(iter([])))


def test_filter_before_the_sets_loses_no_node(spark):
    docs = spark.range(-50, 5000).selectExpr("id AS doc_id", "'x' AS text").union(spark.sql("SELECT CAST(null AS BIGINT), 'x'"))
    nodes = spark.range(-50, 5000, 7).selectExpr("id AS node")
    found = near_duplicates._perhaps_in(docs, nodes)
    assert found.join(nodes, found.doc_id == nodes.node).count() == nodes.count()
    assert found.count() < 800
    assert near_duplicates._perhaps_in(docs, nodes.limit(0)).count() == 0
