"""Main text of web pages by wrapper induction over pages of the same host.

Each page's tree is reduced to a skeleton: its block elements, siblings of one label merged. Skeletons of
a host are aligned with the host's most frequent one by simple tree matching, so a slot means the same
node on all pages. Pages that say the same outside dropped elements count once. Over the host's pages, a
slot whose pages repeat few texts is template, a slot whose text varies is content. The wrapper of a
skeleton is its content root, the deepest node that holds nearly all varying text, and the texts of template
slots below it. Article and main elements only decide between nodes that hold as much, and on hosts with too
few different pages. Extraction reads each page once more and keeps what its wrapper keeps.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logferry.llm.arrays import column, pieces
from logferry.llm.store import written

#: Fixed values of HTML: elements that run inside a line, have no end tag, or hold no markup.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
#: Start tags that end an open paragraph, and elements that end their own open sibling.
ENDS_P = set("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SELF_ENDING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
#: Elements that are a piece of a text and not its whole.
TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figure figcaption ul ol dl".split())
#: Elements, and words in class, id or role, that are never main text, whatever the host's pages say.
DROPPED = set("head nav header footer aside form button select dialog menu object canvas audio video input".split()) | RAW - {"title"} | {"title"}
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disclaimer discussion disqus feedback"
    " footer form header hidden menu menubar modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promotion recommended"
    " related replies reply responses reviews search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar widget".split()
)
#: A slot is template if its commonest text is on this share of at least ``LEAST_PAGES`` pages of the host that say different things.
CONSTANT_SHARE = 0.5
LEAST_PAGES = 4
#: The content root holds at least this share of the varying text.
ROOT_SHARE = 0.8

#: Words beside which a dropped word says no more than it does alone.
QUALIFIERS = set(
    "site page main top bottom left right global primary secondary user reader list box bar area block wrapper container section links link icons buttons slot"
    " unit item items inner outer post posts content group panel row".split()
).union(DROPPED_WORDS)
#: Elements that no name makes a page lose.
PROTECTED = {"html", "body", "main"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?=/?[a-zA-Z])|<|[^<]+", re.S)
#: A tag without angle brackets in its values, which nearly all are.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(?=[\s/>])([^<>\"'=]*(?:=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|(?![\"'\s]))[^<>\"'=]*)*)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|<|=\s*[\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMING = {"class", "id", "role", "hidden", "aria-hidden"}
_SPLIT = re.compile(r"[^a-z]+")


class _Tags:
    """Finds where tags end. Every part of a page is looked at a bounded number of times."""

    def __init__(self, page: str):
        self._page = page
        self._last = {c: page.rfind(c) for c in "\"'"}
        self._last_end = page.rfind(">")
        # Places from where no tag ends but inside a quoted value, because a tag that began before would have.
        self._endless: set[int] = set()

    def at(self, start: int) -> tuple[str, str, str, int] | None:
        """(slash, name, attributes, end) of the tag that begins here, or None where none ends.

        A quote opens a value if it stands behind = and is closed somewhere. A tag that would end only inside
        a value ends there.
        """
        m = _TAG.match(self._page, start)
        if m:
            return m.group(1), m.group(2), m.group(3), m.end()
        if self._last_end < start:
            return None
        name = _NAME.match(self._page, start)
        end = self._end(name.end()) if start not in self._endless else -1
        if end < 0:
            end = self._page.find(">", name.end())
            if end < 0:
                return None
        return name.group(1), name.group(2), self._page[name.end() : end], end + 1

    def _end(self, at: int) -> int:
        passed = []
        while True:
            m = _STOP.search(self._page, at)
            if m is None:
                self._endless.update(passed)
                return -1
            at = m.end()
            sign = self._page[at - 1]
            if sign == ">":
                return at - 1
            if sign == "<":
                if at - 1 in self._endless:
                    self._endless.update(passed)
                    return -1
                passed.append(at - 1)
            elif self._last[sign] >= at:
                at = self._page.find(sign, at) + 1


def events(page: str) -> Iterator[tuple]:
    """('open', tag, attributes), ('close', tag) and ('text', string) of markup that may be broken.

    Raw elements give no text, whatever they hold; missing end tags are implied as browsers do for
    paragraphs, list items and table cells; end tags without a start are ignored, and all open elements end
    with the page. A slash at the end of a start tag means nothing, as in browsers.
    """
    stack: list[str] = []
    tags, at = _Tags(page), 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        whole = m.group()
        begin, at = at, m.end()
        if whole[0] != "<":
            yield "text", whole
            continue
        if len(whole) > 1:
            continue
        found = tags.at(begin) if _NAME.match(page, begin) else None
        if found is None:
            yield "text", whole
            continue
        slash, tag, attributes, at = found
        tag = tag.lower()
        if not slash:
            if tag in ENDS_P and "p" in stack:
                low = len(stack) - 1 - stack[::-1].index("p")
                if not any(t in ENDS_P for t in stack[low + 1 :]):
                    while len(stack) > low:
                        yield "close", stack.pop()
            elif tag in SELF_ENDING and tag in stack:
                low = len(stack) - 1 - stack[::-1].index(tag)
                if not any(t in SELF_ENDING[tag] for t in stack[low + 1 :]):
                    while len(stack) > low:
                        yield "close", stack.pop()
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag in VOID:
                yield "void", tag
                continue
            stack.append(tag)
            yield "open", tag, attributes
        elif tag in stack:
            while True:
                top = stack.pop()
                yield "close", top
                if top == tag:
                    break
    while stack:
        yield "close", stack.pop()


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """Tag with the first name in class, id or role, and whether a name says that this is no main text.

    A name does if its words are dropped words, or such and ``QUALIFIERS``: ``site-header`` and ``comment-list`` do,
    ``no-sidebar``, ``peer-reviews`` and ``article-header`` do not. Such elements have labels of their own, so they are not merged with siblings that are shown.
    """
    first, dropped = "", False
    for m in _ATTRIBUTE.finditer(attributes):
        kind = m.group(1).lower()
        if kind not in _NAMING:
            continue
        value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if kind == "hidden" or kind == "aria-hidden":
            dropped = dropped or kind == "hidden" or value == "true"
            continue
        for name in value.split():
            first = first or re.sub(r"\d+", "", name)
            words = [w for w in _SPLIT.split(name) if w]
            named = tag not in PROTECTED and QUALIFIERS.issuperset(words) and not DROPPED_WORDS.isdisjoint(words)
            dropped = dropped or named
    return (f"{tag}.{first}" if first else tag) + ("!" if dropped else ""), dropped


def _below(at: int, label: str) -> int:
    """The id of the slot of this label below the slot ``at``; the root is 0. Ids do not grow with depth."""
    return xxhash.xxh64_intdigest(label.encode(), at) >> 1


class Node:
    def __init__(self, label: str, dropped: bool, depth: int, at: int, up: int):
        self.label, self.dropped, self.depth, self.at, self.up = label, dropped, depth, at, up
        self.children: dict[str, Node] = {}
        self.text: list[str] = []


def tree(page: str) -> list[Node]:
    """Block elements of a page in preorder, siblings of one label merged, with the text that lies right in them."""
    root = Node("", False, 0, 0, 0)
    path = [root]
    inline: list[bool] = []
    for event in events(page):
        kind = event[0]
        if kind == "text":
            path[-1].text.append(event[1])
        elif kind == "open":
            tag = event[1]
            inline.append(tag in INLINE)
            if tag not in INLINE:
                label, dropped = _label(tag, event[2])
                up = path[-1]
                node = up.children.get(label)
                if node is None:
                    node = up.children[label] = Node(label, dropped or tag in DROPPED or up.dropped, up.depth + 1, _below(up.at, label), up.at)
                path.append(node)
        elif kind == "close" and inline and not inline.pop():
            path.pop()
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo += reversed(node.children.values())
    return nodes


def skeleton(nodes: list[Node]) -> list:
    """Depth and label of every node in preorder that is shown and has text in it: flat, whatever the depth.

    Pages that say the same have one skeleton, whatever lies in dropped elements.
    """
    by_slot = {n.at: n for n in nodes}
    kept = {0}
    for node in nodes:
        if not node.dropped and any(t.strip() for t in node.text):
            while node.at not in kept:
                kept.add(node.at)
                node = by_slot[node.up]
    return [[n.depth, n.label] for n in nodes if n.at in kept]


def slots(nodes: Iterable[Node]) -> Iterator[tuple[int, str]]:
    """Slot and own text of every node that has text."""
    for node in nodes:
        text = " ".join("".join(node.text).split())
        if text:
            yield node.at, text


def _parents(shape: list) -> list[int]:
    """Position of each node's parent in a skeleton; the root's is -1."""
    out, path = [], []
    for k, (depth, _) in enumerate(shape):
        del path[depth:]
        out.append(path[-1] if path else -1)
        path.append(k)
    return out


def _ids(shape: list, parents: list[int]) -> list[int]:
    out = [0]
    for (_, label), up in zip(shape[1:], parents[1:], strict=True):
        out.append(_below(out[up], label))
    return out


def _matches(x: list, y: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two flat skeletons: size of the best order-preserving match, and its positions."""
    if x[0][1] != y[0][1]:
        return 0, []
    below: list[list[list[int]]] = []
    for shape in (x, y):
        below.append([[] for _ in shape])
        for k, up in enumerate(_parents(shape)):
            if up >= 0:
                below[-1][up].append(k)
    # Pairs of nodes whose ancestors have equal labels too, parents before children.
    order, todo = [], [(0, 0)]
    kids: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
    while todo:
        pair = todo.pop()
        order.append(pair)
        ours, theirs = below[0][pair[0]], below[1][pair[1]]
        both = {x[c][1] for c in ours} & {y[d][1] for d in theirs}
        kids[pair] = [c for c in ours if x[c][1] in both], [d for d in theirs if y[d][1] in both]
        todo += [(c, d) for c in kids[pair][0] for d in kids[pair][1] if x[c][1] == y[d][1]]
    size: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}
    for pair in reversed(order):
        ours, theirs = kids[pair]
        best = [[0] * (len(theirs) + 1) for _ in range(len(ours) + 1)]
        for i, c in enumerate(ours, 1):
            for j, d in enumerate(theirs, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + size.get((c, d), 0))
        tables[pair], size[pair] = best, best[-1][-1] + 1
    pairs, todo = [], [(0, 0)]
    while todo:
        pair = todo.pop()
        pairs.append(pair)
        (ours, theirs), best = kids[pair], tables[pair]
        i, j = len(ours), len(theirs)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((ours[i], theirs[j]))
    return size[0, 0], pairs


def matched(a: list, b: list) -> tuple[int, dict[str, str]]:
    """Simple tree matching of two nested skeletons: size of the best order-preserving match, and its path pairs."""
    flat: list[list] = []
    paths: list[list[str]] = []
    for nested in (a, b):
        flat.append([])
        paths.append([])
        todo: list[tuple] = [(0, nested, "")]
        while todo:
            depth, (label, _, children), at = todo.pop()
            flat[-1].append([depth, label])
            paths[-1].append(at)
            todo += [(depth + 1, c, f"{at}/{c[0]}") for c in reversed(children)]
    size, pairs = _matches(*flat)
    return size, {paths[0][k]: paths[1][n] for k, n in pairs}


def host_of(url: Column) -> Column:
    """The host in lower case; a null or odd url shares the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page and slot with text: hash of what the page says outside dropped elements, hash and size of the slot's text."""
    for piece in pieces(batches, "html"):
        rows: list[tuple] = []
        for host, page in zip(column(piece, "host").to_pylist(), column(piece, "html").to_pylist(), strict=True):
            nodes = tree(page or "")
            shape = json.dumps(skeleton(nodes))
            key = _key(shape)
            found = [(at, _key(text), len(text)) for at, text in slots(n for n in nodes if not n.dropped)]
            content = _key(json.dumps([f[:2] for f in found]))
            rows.append((host, content, key, shape, None, None, 0))
            rows += [(host, content, key, None, *f) for f in found]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["host", "content", "shape_key", "shape", "slot", "text_hash", "chars"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per slot of a skeleton: the slot of the host's reference that it matches, or one of its own."""
    for batch in batches:
        for row in batch.to_pylist():
            mine, other = json.loads(row["shape"]), json.loads(row["reference"])
            ids, theirs = (_ids(s, _parents(s)) for s in (mine, other))
            pairs = {ids[k]: theirs[n] for k, n in _matches(mine, other)[1]}
            common = [pairs.get(at, _below(at, "?")) for at in ids]
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["host"]] * n, pa.string()), pa.array([row["shape_key"]] * n, pa.int64()), pa.array(ids, pa.int64()), pa.array(common, pa.int64())], ["host", "shape_key", "slot", "common"]
            )


def wrapper(shape: list, varying: dict[int, float], induced: bool) -> list[int]:
    """Slots of a skeleton that are its content roots, by the varying text of its slots.

    The root is the deepest node with nearly all varying text, or the article or else main element around it
    that holds as much. Where nothing could be induced, which is where a host has too few different pages or
    nothing varies, all articles are roots, or all main elements, or else the whole page.
    """
    parents = _parents(shape)
    ids = _ids(shape, parents)
    tags = [label.split(".")[0] for _, label in shape]
    sizes = [varying.get(at, 0.0) for at in ids]
    largest = [-1] * len(shape)
    for k in range(len(shape) - 1, 0, -1):
        sizes[parents[k]] += sizes[k]
    for k in range(1, len(shape)):
        if largest[parents[k]] < 0 or sizes[k] > sizes[largest[parents[k]]]:
            largest[parents[k]] = k
    if induced and sizes[0]:
        path = [0]
        while (k := largest[path[-1]]) >= 0 and sizes[k] >= ROOT_SHARE * sizes[0] and tags[k] not in TEXT_BLOCKS:
            path.append(k)
        return [ids[next((k for tag in ("article", "main") for k in path if tags[k] == tag), path[-1])]]
    for tag in ("article", "main"):
        found: list[int] = []
        inside = [False] * len(shape)
        for k, up in enumerate(parents):
            if up >= 0 and inside[up]:
                inside[k] = True
            elif tags[k] == tag:
                inside[k] = True
                found.append(ids[k])
        if found:
            return found
    return [0]


def main_text(page: str, roots: list[int], template: dict[int, int]) -> str:
    """Text under the roots and outside dropped elements; blocks are joined by one space.

    What lies right in a slot of ``template`` is left out if it is the text of that hash, not what is below.
    """
    keep = set(roots)
    parts: list[tuple[int, str]] = []
    own: dict[int, list[str]] = {at: [] for at in template}
    path = [(0, False)]
    inline: list[bool] = []
    inside = 1 if 0 in keep else 0
    for event in events(page):
        kind = event[0]
        if kind == "text":
            at, outside = path[-1]
            if inside and not outside:
                parts.append((at, event[1]))
            if at in own:
                own[at].append(event[1])
        elif kind == "void":
            if event[1] not in ("wbr", "img"):
                parts.append((-1, " "))
        elif kind == "open":
            tag = event[1]
            inline.append(tag in INLINE)
            if tag not in INLINE:
                label, dropped = _label(tag, event[2])
                at = _below(path[-1][0], label)
                path.append((at, dropped or tag in DROPPED or path[-1][1]))
                inside += at in keep
                parts.append((-1, " "))
        elif kind == "close" and inline and not inline.pop():
            inside -= path.pop()[0] in keep
            parts.append((-1, " "))
    left_out = {at for at, texts in own.items() if texts and _key(" ".join("".join(texts).split())) == template[at]}
    return " ".join(entities.unescape("".join(t for at, t in parts if at not in left_out)).split())


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "html"):
        keys = [_key(json.dumps(skeleton(tree(page or "")))) for page in column(piece, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(keys, pa.int64())], [*piece.schema.names, "shape_key"])


def _wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            roots = wrapper(json.loads(row["shape"]), {s["slot"]: s["varying"] for s in row["slots"]}, row["pages"] >= LEAST_PAGES)
            template = [(s["slot"], s["template"]) for s in row["slots"] if s["template"] is not None]
            rows.append((row["host"], row["shape_key"], roots, template))
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.map_(pa.int64(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["host", "shape_key", "roots", "template"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "html"):
        found = [main_text(page or "", roots, dict(template)) for page, roots, template in zip(*(column(piece, c).to_pylist() for c in ("html", "roots", "template")), strict=True)]
        yield pa.RecordBatch.from_arrays([column(piece, "page_id"), column(piece, "url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, shape_key, roots, template)``, the wrapper of every skeleton of a host."""
    reduced = written(
        pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_reduced, "host string, content long, shape_key long, shape string, slot long, text_hash long, chars long")
        # Copies of a page are one page: a text recurs only on pages that differ elsewhere.
        .distinct()
        .groupBy("host", "shape_key", "shape", "slot", "text_hash")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")),
        "slots",
    )
    shapes = reduced.where("slot IS NULL").select("host", "shape_key", "shape", "n")
    reference = shapes.groupBy("host").agg(F.max(F.struct("n", "shape")).alias("first"), F.sum("n").alias("pages")).select("host", F.col("first.shape").alias("reference"), "pages")
    aligned = written(shapes.join(reference, "host").select("host", "shape_key", "shape", "reference").mapInArrow(_aligned, "host string, shape_key long, slot long, common long"), "aligned")
    placed = reduced.where("slot IS NOT NULL").drop("shape").join(aligned, ["host", "shape_key", "slot"])
    recurs = (F.col("pages") >= LEAST_PAGES) & (F.col("most.n") >= CONSTANT_SHARE * F.col("pages"))
    common = (
        placed.groupBy("host", "common", "text_hash").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
        .groupBy("host", "common")
        .agg(F.sum("n").alias("pages"), F.max(F.struct("n", "text_hash", "chars")).alias("most"), F.sum("chars").alias("chars"))
        .select("host", "common", F.when(recurs, F.col("most.text_hash")).alias("template"), F.when(recurs, 1 - F.col("most.chars") / F.col("chars")).otherwise(1.0).alias("share"))
    )
    # How much varies in a slot is counted on the pages of its own skeleton.
    sizes = reduced.where("slot IS NOT NULL").groupBy("host", "shape_key", "slot").agg(F.sum("chars").alias("chars"))
    known = (
        aligned.join(common, ["host", "common"]).join(sizes, ["host", "shape_key", "slot"], "left")
        .groupBy("host", "shape_key")
        .agg(F.collect_list(F.struct("slot", (F.coalesce("chars", F.lit(0)) * F.col("share")).alias("varying"), "template")).alias("slots"))
    )
    wrapped = shapes.join(reference.select("host", "pages"), "host").join(known, ["host", "shape_key"], "left").select("host", "shape_key", "shape", "pages", F.coalesce("slots", F.array()).alias("slots"))
    return written(wrapped.mapInArrow(_wrapped, "host string, shape_key long, roots array<long>, template map<long,long>"), "wrappers")


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages`` (page_id, url, html).

    Null html is empty, and an empty page has empty text. Pages of a null url form one host. Other
    columns are ignored; equal rows are extracted apart.
    """
    pages = pages.select("page_id", "url", "html")
    shaped = pages.withColumn("host", host_of(F.col("url"))).mapInArrow(_shaped, "page_id long, url string, html string, host string, shape_key long")
    return shaped.join(wrappers(pages), ["host", "shape_key"]).select("page_id", "url", "html", "roots", "template").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
