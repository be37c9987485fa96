"""Secrets and conversations against their SQL, and conversations and alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import string
import time
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from checks.compare import database
from logferry.llm import alignment, conversations, pages, secrets
from logferry.llm.queries import ORACLES, QUERIES
from tests.conftest import FOLDER
from tests.llm.test_planned import odd  # noqa: F401

LETTERS = string.ascii_letters + string.digits


def ran(df):
    return sorted(map(tuple, df.collect()), key=repr)


def by_sql(df, name, sql):
    db = duckdb.connect()
    db.register(name, df.toArrow())
    return sorted(db.execute(sql).fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op11_secrets", "op12_conversations"])
def test_whole_tables(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    found = database(FOLDER).execute(ORACLES[name])
    assert frame.columns == [c[0] for c in found.description]
    assert ran(frame) == sorted(found.fetchall(), key=repr)


@pytest.fixture
def secret_rows(spark):
    draw = random.Random(1)
    some = lambda n, signs: "".join(draw.choice(signs) for _ in range(n))
    texts = [
        None, "", "AKIA" + some(16, string.ascii_uppercase) + " token=token: abcdef AKIAshort", f"x {some(40, LETTERS + '+/')} é😀 {some(40, LETTERS + '_-')} 0123456789abcdef0123456789abcdef",
        f'Password: "hunter2hunter2" and passwd=abc sha256:{some(40, LETTERS)}', some(3000, LETTERS + "+/"), ("a" * 600 + some(700, LETTERS) + "b" * 600) * 3,
        "123e4567-e89b-12d3-a456-426614174000 " + some(30, "ABCDEF0123456789"), " ".join(some(24, LETTERS) for _ in range(600)),
        "API_KEY = 'abcdefghij' apikey:x", "secretſ=abcdefg toKen=abcdefgh", some(24, string.digits), "EXAMPLE" + some(30, LETTERS), "z" * 300_000,
        "commit " + some(40, "ABCDEF0123456789"), " ".join(["token=abcdef"] * 700),
    ]
    return spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(None, "token=abcdef", 7)] * 2, "doc_id long, text string, found int")


def test_secrets_of_odd_rows(spark, secret_rows):
    rows = ran(secrets.scanned(secret_rows))
    assert rows == by_sql(secret_rows, "documents", secrets.ORACLE)
    spans = {r[0]: r[5] for r in rows}
    assert spans[3].startswith("entropy_base64:2:42,") and spans[5] == "entropy_base64:0:3000"
    assert spans[0] == spans[1] == spans[11 + 1] == spans[13] == spans[14] == "" and spans[4] == "assign:0:25"
    assert secrets.scanned(secret_rows.limit(0)).count() == 0
    kept = secrets.secrets(secret_rows).select("doc_id", "text", "found")
    assert kept.count() == 18 and kept.where("doc_id = 9").first().found[0].kind == "assign"


def test_entropy_by_definition(spark):
    draw = random.Random(2)
    of = secrets.CLASSES[1]
    text = "".join(draw.choice("abcdefghijkl" if i // 40 % 2 else LETTERS) for i in range(1500))
    high = []
    for i in range(len(text) - of.width + 1):
        n = np.array(list(Counter(text[i : i + of.width]).values())) / of.width
        high.append(-(n * np.log2(n)).sum() >= of.bits)
    covered = {i + k for i, h in enumerate(high) if h for k in range(of.width)}
    df = spark.createDataFrame([(text,)], "text string")
    found = secrets.secrets(df, classes=(of,)).first().found
    assert {i for x in found for i in range(x.start, x.end)} == covered and 0 < len(covered) < len(text)


def cheapest(codes):
    """(cost, audit) by trying every edit, from the end."""
    many = len(codes)

    @cache
    def best(i, state, inserted):
        options = [(0, "")] if i == many and state in (0, 3) else []
        if inserted < 2:
            cost, audit = best(i, (2, 2, 3, 2)[state], inserted + 1)
            options.append((cost + 5, "I" + audit))
        if i < many:
            fault, initial = codes[i]
            more = 5 if fault == 2 else 0
            steps = [("D", 2, state)]
            if fault != 1:
                steps.append(("R", 1 + more, (2, 2, 3, 2)[state]))
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))
                if to is not None:
                    steps.append(("K", more, to))
            for letter, price, to in steps:
                cost, audit = best(i + 1, to, 0)
                options.append((cost + price, letter + audit))
        return min(options, default=(10**6, ""))

    return best(0, 0, 0)


def test_auction_finds_the_cheapest():
    draw, lattice = random.Random(4), conversations.Lattice()
    for _ in range(600):
        codes = [(draw.choice([0, 0, 0, 1, 2]), draw.choice("sua?")) for _ in range(draw.randrange(0, 14))]
        given = bytes(f * 4 + "sua?".index(r) for f, r in codes)
        assert lattice.repaired(given) == cheapest(tuple(codes))


def test_prices_are_tight_distances():
    for code in [None, *range(12)]:
        for following in [(0, 0, 0, 0), (0, 7, 3, 1), (5, 9, 0, 2)]:
            prices, tight = conversations.auction(code, following)
            for state in range(4):
                lengths = {a[0]: a[1] + (following if a[2] else prices)[a[3]] for a in conversations.arcs(state, code)}
                assert prices[state] == min(lengths.values()) and tight[state][0] == min(k for k, v in lengths.items() if v == prices[state])


@pytest.fixture
def talks(spark):
    draw = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Hi.", "a b", "  ", "", None, "Why?\n", "x!\x0b", "é", "Hi. ", "..."]
    rows = [(c, draw.choice([None, *range(6), 9, -3]), draw.choice(roles), draw.choice(texts), 1) for c in [None, *range(40)] for _ in range(draw.choice([0, 1, 3, 8, 40]))]
    rows += [(50, t, draw.choice(roles[:2]), draw.choice(["Yes.", "No.", "x" * draw.randrange(1, 50_000) + "."]), 1) for t in range(400)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit int").repartition(5)


def test_odd_conversations(spark, talks):
    found = conversations.repaired(conversations.damaged(talks), talks)
    assert ran(found) == by_sql(talks, "conversations", conversations.ORACLE)
    assert conversations.repaired(talks.limit(0)).count() == 0


def test_conversation_over_many_tasks(spark, talks, monkeypatch):
    long = talks.where("conv_id = 50 OR conv_id IS NULL")
    whole = ran(conversations.repaired(long))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert ran(conversations.repaired(long)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def plainly_aligned(texts):
    """Rows of the alignment by whole texts and all pairs."""
    byte, piece = Tokenizer.from_file(alignment.BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
    byte.encode_special_tokens = True
    sign, spelling = alignment.byte_of_sign(), {i: w for w, i in byte.get_vocab().items()}
    bytes_a = lambda i: bytes(sign[c] for c in spelling[i])
    bytes_b = lambda i: bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i) else piece.id_to_piece(i).replace("▁", " ").encode()
    docs = []
    for text in texts:
        a = byte.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        if any(b"".join(map(f, ids)) != (" " + (text or "")).encode() for f, ids in ((bytes_a, a), (bytes_b, b))):
            a, b = [], []
        ends_a, ends_b = (np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((bytes_a, a), (bytes_b, b)))
        groups, low = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            groups.append([[i for i, e in zip(ids, ends, strict=True) if low < e <= cut] for ids, ends in ((a, ends_a), (b, ends_b))])
            low = cut
        docs.append((len(a), len(b), groups))
    held = Counter(p for *_, groups in docs for p in {(x, y) for a, b in groups for x in a for y in b})
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    for n_a, n_b, groups in docs:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        yield n_a, n_b, len(groups), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 5_000])
def test_alignment(spark, block_bytes):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").where("doc_id < 60").collect()
    texts = [
        "", None, "a", " a", "a  b ", "a\n b", "\n", "  ", "x \t y", "▁a b", "<|endoftext|> <s> </s> <unk>", "日本語 テキスト 😀", "é é", "don't  stop", "　 x", "a b",
        "a\x85 b", "\x00 a", "the the", "the the", "好" * 3000, " ".join(["x\n"] * 50), *[r.text for r in docs],
    ]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    found, links = alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string, n_a int, block string"), block_bytes=block_bytes)
    assert ran(found) == sorted([(i, *row) for i, row in enumerate(plainly_aligned(texts))], key=repr)
    assert links.where("best").count() >= links.select("token_a").distinct().count()


def test_alignment_of_odd_rows(spark, odd):  # noqa: F811
    found, _ = alignment.aligned(odd)
    rows = found.collect()
    assert len(rows) == 10 and sum(r.n_a == 0 for r in rows) == 2
    assert alignment.aligned(odd.limit(0))[0].count() == 0 == alignment.aligned(odd.limit(0))[1].count()


def test_words_are_encoded_as_whole_texts(spark):
    with open(alignment.BYTE_BPE, "rb") as a, open(alignment.PIECE_BPE, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    byte = Tokenizer.from_file(alignment.BYTE_BPE)
    byte.encode_special_tokens = True
    for text in [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r.text] + ["a  b \n c\n", "x y", "1   2  "]:
        words = alignment.words(text)
        assert "".join(" " + w for w in words) == " " + text
        flat = lambda lists: [i for ids in lists.to_pylist() for i in ids]
        assert flat(aligner.a.encode(words)) == byte.encode(" " + text, add_special_tokens=False).ids
        assert flat(aligner.b.encode(words)) == aligner.b._model.encode(text)


def test_names_and_scripts_that_lose_no_page(spark):
    page = '%s<div class="%s"><p>Story %d is told %s.</p></div></body>'
    heads = ["<body class='post no-sidebar'>", "<body class='has-banner comments'>", '<body><script>var open="<!--";</script>', "<body><style>a > b { content: '<p' }</style>", "<body><main class='with-sidebar'>"]
    names = ["peer-reviews", "job-search", "article-header", "wide", "text"]
    rows = [(f"h{n}.example", page % (head, name, k, "again " * k)) for n, (head, name) in enumerate(zip(heads, names, strict=True)) for k in range(5)]
    got = {r.url: [] for r in spark.createDataFrame(rows, "url string, html string").collect()}
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    for r in pages.main_texts(frame).orderBy("page_id").collect():
        got[r.url].append(r.text)
    assert all(texts == [f"Story {k} is told {'again ' * k}".strip() + ("." if k == 0 else " .") if k else "Story 0 is told ." for k in range(5)] for texts in got.values())


def test_names_that_drop():
    dropped = lambda tag, names: pages._label(tag, f' class="{names}"')[1]
    assert all(dropped("div", n) for n in ("comments", "site-header", "comment-list", "cookie-notice", "main-menu", "x sidebar", "related-posts", "ad-slot2"))
    assert not any(dropped("div", n) for n in ("no-sidebar", "has-banner", "with-sidebar", "peer-reviews", "job-search", "article-header", "main", "content-list"))
    assert not dropped("body", "sidebar") and not dropped("main", "comments") and dropped("article", "comments")


@pytest.mark.parametrize("broken", ['<b x="', '<b x=">"', "<b x='\"", "<a b=\"'>'", "<", "<a ", "<!--", "</"])
def test_broken_markup_takes_linear_time(broken):
    counts = []
    for size in (2_000, 400_000):
        start = time.process_time()
        list(pages.events(broken * (size // len(broken))))
        counts.append(time.process_time() - start)
    assert counts[1] < 2


def test_tags_by_a_plain_scanner():
    """Against a scanner that looks at one sign after the other."""
    draw = random.Random(8)
    parts = ["<a", "<b ", ">", '"', "'", "=", " x", "y", "</a", "/", " ", "1 < 2", 'c="d"', "e='f>g'"]

    def plain(page, at):
        name = pages._NAME.match(page, at).end()
        k, seen = name, ""
        while k < len(page) and page[k] != ">":
            if page[k] in "\"'" and seen.rstrip().endswith("=") and page.find(page[k], k + 1) > 0:
                k = page.find(page[k], k + 1)
                seen = ""
            else:
                seen += page[k]
            k += 1
        return k if k < len(page) else page.find(">", name)

    for _ in range(3_000):
        page = "".join(draw.choice(parts) for _ in range(draw.randrange(2, 25)))
        tags = pages._Tags(page)
        for at in range(len(page)):
            if pages._NAME.match(page, at):
                found = tags.at(at)
                assert (found[3] - 1 if found else -1) == plain(page, at), (page, at)
