"""Classifier, language ID, language model, token files, pages, surrogates and the pipeline."""

from __future__ import annotations

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from logferry.llm import language_model, languages, pages, quality, surrogates, token_counts
from tests.conftest import FOLDER
from tests.llm.test_planned import WORD, lowered, odd  # noqa: F401

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def remainder(doc_id, modulus):
    return zlib.crc32((b"" if doc_id is None else str(doc_id).encode())) % modulus


def test_quality_on_held_out_rows(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = {r.doc_id: r for r in quality.scored(documents, labels).collect()}
    held = [r for r in labels.collect() if remainder(r.doc_id, 4) == 2]
    right = [rows[r.doc_id].predicted == r.quality for r in held]
    assert len(rows) == 1000 and np.mean(right) > 0.95


def test_quality_of_odd_rows(spark, odd):  # noqa: F811
    labels = spark.createDataFrame([(1, 1, 5), (4, 0, 5), (4, 0, 5), (6, None, 5), (None, 1, 5)], "doc_id long, quality int, text int")
    rows = quality.scored(odd, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows) and rows[0].kept == "x"
    assert {r.score for r in quality.scored(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.scored(odd.limit(0), labels).count() == 0


def bags_of(texts):
    data = [t.encode() for t in texts]
    return list(quality.passages(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])))


@pytest.mark.parametrize("size", [4, 8192])
def test_attention_gradient(monkeypatch, size):
    monkeypatch.setattr(quality, "SLICE", size)
    draw = np.random.default_rng(1)
    x = draw.normal(size=(23, 9))
    owner = np.sort(np.concatenate([np.arange(6), draw.integers(0, 6, 17)]))
    labels, weight = draw.integers(0, 2, 6).astype(float), draw.uniform(0.5, 2, 6)
    shapes = {"W": (9, 5), "V": (5, 3), "U": (5, 3), "w": (3,), "c": (5,), "b": ()}
    p = {k: draw.normal(0, 0.4, n) if n else np.array(0.2) for k, n in shapes.items()}
    found = quality.gradient(p, x, owner, labels, weight)
    for k, n in shapes.items():
        for at in np.ndindex(*n):
            up, down = {**p, k: p[k].copy()}, {**p, k: p[k].copy()}
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            slope = (quality.loss(up, x, owner, labels, weight) - quality.loss(down, x, owner, labels, weight)) / 2e-5
            assert abs(slope - found[k][at]) < 1e-7


def test_features_do_not_depend_on_slices(monkeypatch):
    texts = ["", "Ein Text, der länger ist. " * 90, "x", "word " * 700, "", "é" * 3000]
    (x, owner), = bags_of(texts)
    monkeypatch.setattr(quality, "SLICE", 3)
    parts = bags_of(texts)
    assert len(parts) > 5 and np.array_equal(np.concatenate([o for _, o in parts]), owner)
    assert np.array_equal(np.concatenate([f for f, _ in parts]), x)


def test_one_passage_among_a_thousand_is_learnt():
    """Bags of 1,000 passages, one of which tells the label by a word: at any place, in held-out bags too."""
    draw = np.random.default_rng(2)
    usual = (" ".join(draw.choice("the of and with river stone paper light".split(), 5000)) * 2)[: 2 * quality.PASSAGE].ljust(2 * quality.PASSAGE)

    def bag(bad):
        parts = [usual[: quality.PASSAGE]] * 1000
        parts[int(draw.integers(1000))] = ("BUY!!! NOW!!! " * 40 if bad else usual[quality.PASSAGE :])[: quality.PASSAGE].ljust(quality.PASSAGE)
        return "".join(parts)

    labels = np.tile([0.0, 1.0], 12).astype(np.float32)
    seen, held = (bags_of([bag(y == 0) for y in labels]) for _ in range(2))
    x, owner = (np.concatenate(v) for v in zip(*seen, strict=True))
    assert len(x) == 24_000
    model = quality.fitted(x, owner, labels, steps=60)
    assert ((quality.scores(model, held, 24) > 0.5) == labels).all()


def test_languages(spark, documents):
    rows = languages.languages(documents, spans=True).collect()
    langs = {r.doc_id: r.lang for r in documents.collect()}
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.98
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)


def test_languages_of_mixed_and_odd_rows(spark, documents):
    texts = {r.lang: r.text for r in documents.where("length(text) between 800 and 1500").collect()}
    mixed = texts["de"][:400] + " " + texts["es"][:700]
    extra = spark.createDataFrame(
        [(9001, mixed, None), (9002, None, "en"), (9003, "12 — € 34", "en"), (9004, "", None), (9005, "Привет мир как дела", None), (None, "x", "en")], "doc_id long, text string, lang string"
    )
    rows = {r.doc_id: r for r in languages.languages(documents.select("doc_id", "text", "lang").union(extra), spans=True).collect()}
    found = rows[9001].spans
    assert rows[9001].lang_pred == "es" and [s.lang for s in found][:1] == ["de"] and len(found) <= 4
    assert abs(found[0].end - 400) < 40
    assert [rows[k].lang_pred for k in (9002, 9003, 9004)] == ["und"] * 3 and rows[9005].lang_pred in langs_of(documents)
    assert languages.languages(extra.limit(0)).count() == 0
    assert {r.lang_pred for r in languages.languages(extra.where("doc_id = 9001")).collect()} == {"und"}


def langs_of(documents):
    return {r.lang for r in documents.select("lang").distinct().collect()}


def test_viterbi_equals_brute_force():
    draw = np.random.default_rng(2)
    for _ in range(30):
        at = np.cumsum([0, *draw.integers(0, 6, 5)])
        e = draw.normal(size=(at[-1], 3)).astype(np.float32)
        path = languages.viterbi(e, at, 1.0)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if a == b:
                continue

            def value(p, a=a):
                return sum(e[a + k, s] for k, s in enumerate(p)) - sum(x != y for x, y in zip(p, p[1:], strict=False))

            best = max(np.ndindex(*[3] * (b - a)), key=value)
            assert value(path[a:b]) == pytest.approx(value(best), abs=1e-4)


def test_viterbi_with_300_languages():
    e = np.zeros((6, 300), np.float32)
    e[:4, 299] = e[4:, 260] = 5
    assert languages.viterbi(e, np.array([0, 6]), 3.0).tolist() == [299] * 4 + [260] * 2
    assert languages.viterbi(e[:1], np.array([0, 1]), 3.0).tolist() == [299]
    assert languages.viterbi(e[:, :256], np.array([0, 6]), 3.0).dtype == np.uint8


def test_language_model(spark, odd, documents):  # noqa: F811
    docs = documents.select("doc_id", "text").union(odd.where("doc_id >= 3 AND doc_id < 8").selectExpr("doc_id + 10000", "text"))
    rows = {r.doc_id: r for r in language_model.scored(docs, steps=2).collect()}
    tokens = {r.doc_id: [*WORD.findall(lowered(r.text or "")), None] for r in docs.collect()}
    counts = Counter(t for d, ts in tokens.items() if remainder(d, 5) != 1 for t in ts)
    n, v = sum(counts.values()), len(counts)
    for d, ts in tokens.items():
        row = rows[d]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(ts), sum(t in counts for t in ts), n)
        assert row.base_score == pytest.approx(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts))
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert language_model.scored(docs.limit(0)).count() == 0


def test_forward_equals_enumeration():
    model = language_model.first_model(np.full(language_model.CLASSES + 1, 1 / (language_model.CLASSES + 1)))
    start, between, emit = model
    classes = np.array([5, 9, 5, 4096, 7], np.int64)
    lengths = np.array([4, 1])
    got = language_model.log_likelihood(model, classes, lengths)
    want = 0.0
    for path in np.ndindex(*[language_model.STATES] * 4):
        p = start[path[0]] * emit[path[0], classes[0]]
        for k in range(1, 4):
            p *= between[path[k - 1], path[k]] * emit[path[k], classes[k]]
        want += p
    assert got == pytest.approx([math.log10(want), math.log10((start * emit[:, 7]).sum())])


def posteriors(model, classes, lengths):
    """Expected counts and log10 likelihood by enumerating every path of states."""
    start, between, emit = model
    first, moved, emitted, likelihood = np.zeros(len(start)), np.zeros(between.shape), np.zeros(emit.shape), 0.0
    for at, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        seen, sums = classes[at : at + n], (np.zeros(len(start)), np.zeros(between.shape), np.zeros(emit.shape))
        total = 0.0
        for path in np.ndindex(*[len(start)] * n):
            p = start[path[0]] * emit[path[0], seen[0]]
            for k in range(1, n):
                p *= between[path[k - 1], path[k]] * emit[path[k], seen[k]]
            total += p
            sums[0][path[0]] += p
            for k in range(n):
                sums[2][path[k], seen[k]] += p
                if k:
                    sums[1][path[k - 1], path[k]] += p
        first, moved, emitted, likelihood = first + sums[0] / total, moved + sums[1] / total, emitted + sums[2] / total, likelihood + math.log10(total)
    return first, moved, emitted, likelihood


@pytest.mark.parametrize("window", [1, 2, 3, 4, 128])
def test_expected_counts_equal_enumeration(monkeypatch, window):
    monkeypatch.setattr(language_model, "STATES", 3)
    draw = np.random.default_rng(window)
    shares = [draw.dirichlet(np.ones(n), size) for n, size in ((3, None), (3, 3), (6, 3))]
    for lengths in ([7], [1, 5, 2], [3, 6, 1, 4]):
        lengths = np.array(lengths)
        classes = draw.integers(0, 6, lengths.sum())
        got, want = language_model.expected(tuple(shares), classes, lengths, window), posteriors(shares, classes, lengths)
        for a, b in zip(got, want, strict=True):
            assert np.allclose(a, b, rtol=1e-4, atol=1e-5)


def test_expected_counts_do_not_depend_on_windows():
    draw = np.random.default_rng(4)
    model = language_model.first_model(draw.dirichlet(np.ones(language_model.CLASSES + 1)))
    lengths = np.array([300, 1, 9000, 128, 129])
    classes = draw.integers(0, language_model.CLASSES + 1, lengths.sum())
    want = language_model.expected(model, classes, lengths, 10_000)
    assert want[3] == pytest.approx(language_model.log_likelihood(model, classes, lengths).sum(), rel=1e-6)
    for window in (64, 128):
        for a, b in zip(language_model.expected(model, classes, lengths, window), want, strict=True):
            assert np.allclose(a, b, rtol=1e-3, atol=1e-3)
    assert want[1].sum() == pytest.approx((lengths - 1).sum(), rel=1e-4)


def seconds(work):
    """CPU seconds, the least of five runs."""
    spent = []
    for _ in range(5):
        began = time.process_time()
        work()
        spent.append(time.process_time() - began)
    return min(spent)


def cut_rows(texts):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "held_out": [d % 3 == 0 for d in range(len(texts))], "text": pa.array(texts, pa.string())})
    out = [b for cut in language_model._cut(iter([batch])) for b in cut.to_pylist()]
    return [r for r in out if r["number"] is None], [r for r in out if r["number"] is not None]


def test_tokens_are_the_words_of_each_text():
    texts = [" \x1c a\x0bBÄ\u2003x\x85 ", None, "", "\t\n", "A a\x00B c ", "ſ K", "abcd xbcd"]
    (row,), entries = cut_rows(texts)
    words = {r["number"]: r["word"] for r in sorted(entries, key=lambda r: r["number"])}
    assert list(words) == list(range(len(words))) and words[0] == b"" and len(set(words.values())) == len(words)
    tokens, wanted = np.frombuffer(row["tokens"], np.int32), [[*(t or "").encode().lower().split(), b""] for t in texts]
    assert [words[t] for t in tokens] == [w for ws in wanted for w in ws] and row["lengths"] == [len(w) for w in wanted]
    learnt = Counter(w for d, ws in enumerate(wanted) for w in ws if d % 3)
    assert {r["word"]: r["n"] for r in entries} == {w: learnt[w] for w in words.values()}
    classes = np.frombuffer(row["classes"], np.uint16)
    assert [*classes] == [language_model.END if not w else language_model.word_class(w) for w in words.values()]


def test_cutting_costs_little_more_than_splitting(documents):
    texts = [r.text or "" for r in documents.select("text").collect()]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "held_out": [False] * len(texts), "text": pa.array(texts, pa.string())})
    split = seconds(lambda: [t.encode().lower().split() for t in texts])
    assert seconds(lambda: list(language_model._cut(iter([batch])))) < 3 * split


def test_every_step_raises_the_likelihood(monkeypatch, documents):
    seen, step = [], language_model._step

    def watched(rows, model):
        model, likelihood = step(rows, model)
        seen.append(likelihood)
        return model, likelihood

    monkeypatch.setattr(language_model, "_step", watched)
    rows = language_model.scored(documents, steps=4, gain=0.0).collect()
    assert len(seen) == 4 and seen == sorted(seen)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
    seen.clear()
    language_model.scored(documents, steps=9, gain=100.0).collect()
    assert len(seen) == 2


def test_token_counts(spark, odd, documents, tmp_path):  # noqa: F811
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    got = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.token_counts(docs).collect())
    assert got == sorted((r.doc_id or -1, len(WORD.findall(r.text or ""))) for r in docs.collect())
    assert token_counts.token_counts(docs.limit(0)).count() == 0
    ids = np.array([5, 6, 0, 0, 7, 7, 7, 7, 7, 7, 7, 0, 9, 9], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "b.bin").write_bytes(b"")
    for block in (1, 2, 3, 100):
        rows = token_counts.scan(spark, str(tmp_path), block).orderBy("document").collect()
        assert [(r.document, r.n_tokens, r.ended) for r in rows] == [(0, 2, True), (1, 0, True), (2, 7, True), (3, 2, False)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li><a href=/>Home</a><li>About</ul></nav><div class="cookie-notice">We use cookies</div><div id="layout"><div class="story">
<h1>%s &amp; more</h1><p>One <b>bold</b>ly&nbsp;said<br>thing %s<p>Two &lt;tags&gt; %s<script>var t="</p>";</script>
<form><input name=q>Search</form></div><aside class="sidebar">Related</aside><div class="comments"><p>First! %s</p></div></div>
<div class="ad">Buy</div><footer>&copy; x</footer>"""


def test_pages(spark):
    rows = [(k, "http://a.example/x", PAGE % (f"T{k}", f"a{k} " * 9, f"b{k} " * 9, "c" * k)) for k in range(6)]
    rows += [(10, None, None), (11, "odd", ""), (12, "http://b.example", "<article>Only <i>this</i></article><p>not this"), (12, "http://b.example", "<article>Only <i>this</i></article><p>not this")]
    got = {r.page_id: r for r in pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k].text == f"T{k} & more One boldly said thing " + f"a{k} " * 9 + "Two <tags> " + (f"b{k} " * 9).strip()
        assert got[k].n_chars == len(got[k].text)
    assert (got[10].text, got[11].text, got[12].text) == ("", "", "Only this")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.main_texts(empty).count() == 0


def texts_of(spark, rows):
    """Main text by page_id; a page is its host and its markup."""
    frame = spark.createDataFrame([(k, f"http://{host}/{k}", html) for k, (host, html) in enumerate(rows)], "page_id long, url string, html string")
    return [r.text for r in sorted(pages.main_texts(frame).collect(), key=lambda r: r.page_id)]


def test_pages_with_names_in_other_attributes(spark):
    shown = ['style="overflow:hidden"', 'data-hidden="false"', 'title="a hidden gem"', "data-id=comments", 'data-role="nav"', 'aria-hidden="false"']
    gone = ["hidden", 'hidden=""', "aria-hidden='true'", 'role="nav"', "id=comments", 'data-x="1" class="x comments"', "CLASS=menu"]
    rows = [(f"{k}.example", f"<article {a}><div>Text</div></article>") for k, a in enumerate(shown)]
    rows += [(f"g{k}.example", f"<article><div {a}>no</div><div>yes</div></article>") for k, a in enumerate(gone)]
    rows += [("h.example", '<article><div class="tab hidden">no</div><div class="tab">yes</div></article>')]
    assert texts_of(spark, rows) == ["Text"] * len(shown) + ["yes"] * (len(gone) + 1)


def test_copies_of_pages_without_article(spark):
    page = '<body><div class="ad">%s</div><div class="top">Our shop</div><div class="story"><h1>%s</h1><p>%s says something</div></body>'
    rows = [("one.example", page % (k, "Same", "same")) for k in range(4)]
    rows += [("half.example", page % (k, "Copy", "copy")) for k in range(6)] + [("half.example", page % (k, f"Title {k}", f"text {k}")) for k in range(5)]
    got = texts_of(spark, rows)
    assert got[:4] == ["Our shop Same same says something"] * 4
    assert got[4:] == ["Copy copy says something"] * 6 + [f"Title {k} text {k} says something" for k in range(5)]


def test_pages_by_induction(spark):
    page = '<body><main>Latest news<div class="body"><h1>Title %d</h1><p>%s</div><article class="teaser"><p>Teaser %d</article></main></body>'
    rows = [("teasers.example", page % (k, f"text {k} " * 9, k)) for k in range(5)]
    note = '<body><article>Press<h1>Title %d</h1><div class="x1">All rights kept</div><p>%s</article></body>'
    rows += [("note.example", note % (k, f"text {k} " * 9)) for k in range(5)] + [("note.example", note.replace("All rights kept", "One of a kind") % (5, "text 5 " * 9))]
    rows += [("few.example", note % (k, f"text {k} " * 9)) for k in range(2)]
    body = lambda k: f"Title {k} " + (f"text {k} " * 9).strip()
    got = texts_of(spark, rows)
    assert got[:5] == [f"{body(k)} Teaser {k}" for k in range(5)]
    assert got[5:10] == [body(k) for k in range(5)] and got[10] == "Title 5 One of a kind " + body(5)[8:]
    assert got[11:] == [f"Press Title {k} All rights kept " + body(k)[8:] for k in range(2)]


def test_pages_of_any_depth(spark):
    deep = "<div>" * 5000 + "<p>Deep %d"
    rows = [("d.example", deep % k) for k in range(5)] + [("d.example", "<ul>" * 3000 + "flat"), ("e.example", "<blockquote>" * 5000 + "quoted")]
    assert texts_of(spark, rows) == [f"Deep {k}" for k in range(5)] + ["flat", "quoted"]


def test_tree_matching():
    a = ["r", False, [["x", False, []], ["y", False, [["z", False, []]]], ["w", False, []]]]
    b = ["r", False, [["y", False, [["z", False, []]]], ["x", False, []], ["w", False, []]]]
    size, pairs = pages.matched(a, b)
    assert size == 4 and pairs == {"": "", "/y": "/y", "/y/z": "/y/z", "/w": "/w"}


def test_surrogates(spark, odd):  # noqa: F811
    text = "Mail Ann.Lee@Corp.example or ann.lee@corp.example, +1 (988) 555-2485, 42.144.35.254, 4041-8949 7460-8795 and 4041894974608795; token = \"0cab398dc11d1a2a11dc6572c8df8bd228c864f3\" Mrs. Éva Lee, Herr Иван Петров, 123-45-6789."
    docs = spark.createDataFrame([(1, text, 7), (1, text, 7), (2, "ask ann.lee@corp.example", 0), (3, None, 0), (4, "plain text. 10 of 12", 0)], "doc_id long, text string, n_entities int")
    rows = sorted(surrogates.replaced(docs, "k").collect(), key=lambda r: r.doc_id)
    assert [r.n_entities for r in rows] == [10, 10, 1, 0, 0] and rows[0].text == rows[1].text
    out = rows[0].text
    for secret in ("nn.Lee", "corp.example", "555-2485", "42.144", "8949", "0cab398", "Éva", "Петров", "45-6789"):
        assert secret not in out
    first, second = re.findall(r"\S+@\S+\w", out)
    assert first.lower() == second and first != second and second == rows[2].text[4:] and second.endswith(".example")
    plain, joined = re.search(r"(4\d{3}-\d{4} \d{4}-\d{4}) and (\d{16})", out).groups()
    assert re.sub(r"\D", "", plain) == joined
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}, \d+\.\d+\.\d+\.\d+,", out) and re.search(r'token = "[0-9a-f]{40}"', out)
    assert re.search(r"Mrs\. (%s) [A-Z][a-z]+," % "|".join(surrogates.WOMEN), out) and re.search(r"Herr [А-Я][а-я]{3} [А-Я][а-я]{5},", out)
    assert (rows[3].text, rows[4].text) == (None, "plain text. 10 of 12")
    assert surrogates.replaced(odd.limit(0)).count() == 0 and surrogates.replaced(odd).count() == 10


def test_domains_stay_distinct_and_numbers_are_one_entity(spark, monkeypatch):
    """Every domain has its own surrogate, also where one letter is all its room; +1 numbers are one with and without it."""
    monkeypatch.setattr(surrogates, "MOST_DRAWS", 2)
    texts = [f"{c}{k}@{c}.example" for c in "abcdefghijklmnopqrstuvwxy" for k in range(2)]
    texts += ["+1 (988) 555-2485 or 988-555-2485, (988) 555-2485 and +19885552485", "+49 88 555248, 498-855-5248"]
    rows = {r.doc_id: r.text for r in surrogates.replaced(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    domains = [rows[k].split("@")[1] for k in range(50)]
    assert len(set(domains)) == 25 and domains[::2] == domains[1::2] and not set(domains) & {f"{c}.example" for c in "abcdefghijklmnopqrstuvwxy"}
    assert len({rows[k] for k in range(50)}) == 50
    first, *others = re.split(", | or | and ", rows[50])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", first) and "9885552485" not in re.sub(r"\D", "", rows[50])
    assert {re.sub(r"\D", "", n)[-10:] for n in [first, *others]} == {re.sub(r"\D", "", first)[1:]} and others[-1].startswith("+1")
    abroad, home = rows[51].split(", ")
    assert re.fullmatch(r"\+49 \d\d \d{6}", abroad) and re.fullmatch(r"\d{3}-\d{3}-\d{4}", home) and "49" + abroad[4:].replace(" ", "") != home.replace("-", "")


HELPERS = "row found row_key new raw kind prefix canon kept tail n none c0 domain _found _key _new _kept n_entities _n_entities shard words copy order part _shard _words _copy _order _id _source _size _nth size key row_hash copies score predicted".split()


def test_columns_named_as_helpers(spark):
    text = "Ask Mrs. Lee at lee@corp.example. " + " ".join(f"word{k}" for k in range(40))
    rows = [(k, text if k else None, "en", "s", 1, *range(len(HELPERS))) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in HELPERS))
    held = {c: k for k, c in enumerate(HELPERS)}
    out = {r.doc_id: r.asDict() for r in surrogates.replaced(docs).collect()}
    assert [out[1][c] for c in HELPERS if c != "n_entities"] == [held[c] for c in HELPERS if c != "n_entities"]
    assert (out[0]["n_entities"], out[1]["n_entities"], out[0]["text"]) == (0, 2, None) and "lee@" not in out[1]["text"]
    for name, stage in corpus_pipeline.STAGES[1:4]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns, name
        assert [{c: r[c] for c in HELPERS} for r in after.collect()] == [held] * 2, name
    mix = corpus_pipeline.mixture(spark, docs, FOLDER)
    mine = [c for c in docs.columns if c not in ("shard", "words", "copy")]
    assert mix.columns == [*mine, "shard", "words", "copy"]
    taken = [r.asDict() for r in mix.collect()]
    assert sum(r["words"] for r in taken) == 68 and all(r[c] == held[c] for r in taken for c in HELPERS if c in mine)


@pytest.mark.parametrize("number", range(5))
def test_stages_with_odd_rows(spark, odd, number):  # noqa: F811
    """Nulls in any column, empty and very long texts, repeated rows, extra columns and empty tables, in every stage."""
    name, stage = corpus_pipeline.STAGES[number]
    nulls = spark.createDataFrame([(None,) * 6] * 2, odd.schema)
    rows = odd.union(nulls)
    out = stage(spark, rows, FOLDER)
    left = out.collect()
    assert out.columns[:6] == odd.columns and stage(spark, odd.limit(0), FOLDER).columns == out.columns
    assert stage(spark, odd.limit(0), FOLDER).count() == 0
    if name == "mixing":
        # The words of all rows are 7 * 4 + 2 + 2 + 50,001: sources stop at twice their size.
        assert all(r.text and r.text.strip() for r in left) and {r.doc_id for r in left} <= {1, 2, None, 6, 7, 8}
        assert abs(sum(r.words for r in left) - 1.5 * 50_033) <= 5
    elif name == "near-duplicates":
        # Rows 1 and 2 are copies, and so are 6 and 7; the null doc_id stays with all its rows.
        assert sorted(r.doc_id for r in left if r.doc_id) == [1, 1, 3, 4, 5, 6, 8] and sum(r.doc_id is None for r in left) == 3
    elif name == "quality classifier":
        assert len(left) <= 12
    else:
        # Nothing here is personal or tested; n_chars alone follows the text, which it does not in these rows.
        assert len(left) == 12 and sorted(map(str, out.drop("n_chars").collect())) == sorted(map(str, rows.drop("n_chars").collect()))


def test_surrogates_stay_distinct(spark):
    """A format with little room: draws are repeated until no two entities share a surrogate."""
    entities = spark.createDataFrame([("ssn", f"{k}") for k in range(0, 10, 2)], "kind string, canon string")
    rows = surrogates.surrogates(entities).collect()
    new = [r.new for r in rows]
    assert len(set(new)) == 5 and not set(new) & {r.canon for r in rows}


def test_surrogates_with_a_prefix_stay_distinct(spark):
    """300 numbers of one country code in a room of 1,000: rendered ones are no two alike, and none is a real one."""
    docs = spark.createDataFrame([(k, f"+1 {k:03}") for k in range(300)] + [(300, "+1000")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in surrogates.replaced(docs).collect()}
    new = {rows[k] for k in range(300)}
    assert len(new) == 300 and all(re.fullmatch(r"\+1 \d{3}", n) for n in new) and not new & {f"+1 {k:03}" for k in range(300)}
    assert rows[300] == rows[0].replace(" ", "")


def test_surrogates_of_full_formats(spark, monkeypatch):
    """More entities than surrogates of their format: all are replaced, by distinct ones of a longer format."""
    monkeypatch.setattr(surrogates, "MOST_DRAWS", 2)
    real = [f"{c}@x.example" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"+1{k:03}" for k in range(600)] + ["Dr Ան", "10.1.1.1"]
    rows = {r.doc_id: r.text for r in surrogates.replaced(spark.createDataFrame(list(enumerate(real)), "doc_id long, text string")).collect()}
    assert len(rows) == len(real) == len(set(rows.values())) and not set(rows.values()) & set(real)
    assert all(re.fullmatch(r"[a-z]\d*@[a-z]\.example", rows[k]) for k in range(26)) and all(re.fullmatch(r"\+1\d{3,}", rows[k]) for k in range(26, 626))
    assert re.fullmatch("Dr [A-Z][a-z]+", rows[626])


def test_pipeline(spark, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == docs.columns, name
        assert after.count() <= before.count()
        before = spark.createDataFrame(after.collect(), docs.schema)
    kept = {r.doc_id for r in before.collect()}
    assert np.mean([labels[d] for d in kept if d in labels]) > 0.95
    mix = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(mix.doc_id) <= kept and {"shard", "words", "copy"} <= set(mix.columns)
    sizes = sum(len(WORD.findall(r.text)) for r in before.collect())
    assert abs(mix.words.sum() - 1.5 * sizes) < 25
    assert corpus_pipeline.ORACLE_SQL is None
