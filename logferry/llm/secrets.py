"""Secrets in texts: assignments, keys and long hexadecimal strings, and strings of high entropy.

Strings of one character class that are long enough are candidates. A window slides over each; the number
of times that each character occurs in it is kept up to date by counting one character in and one out, and
with it the sum of ``n * log2(n)``, so that the Shannon entropy per character, ``log2(width) - sum / width``, is
known at every place for a constant effort. Windows at or above the class's entropy make spans, which merge
where they touch. Candidates that are on the allow-list, or follow words that announce a checksum, make none.

All of it is one projection of DataFrame functions: nothing is shuffled, and a text is searched once per kind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of the base, in their order, and what a match must have.
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
VALUE = "[A-Za-z0-9+/_.=-]+"
LEAST_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = f"({'|'.join(map(_either_case, KEYWORDS))})[\"']?\\x20*[:=]\\x20*[\"']?({VALUE})"


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``alphabet`` of ``width`` characters and more, whose windows have ``bits`` of entropy or more."""

    kind: str
    alphabet: str
    width: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{''.join(chr(92) + c if c in '+/_-' else c for c in self.alphabet)}]{{{self.width},}}"

    @property
    def limit(self) -> int:
        """The largest sum of a window that has enough entropy."""
        return math.floor(self.width * SCALE * (math.log2(self.width) - self.bits))


#: Sums are whole numbers of this fraction, so that counting in and out never drifts.
SCALE = 1 << 20
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharacterClass("entropy_hex", _DIGITS + "abcdefABCDEF", 20, 3.0),
    CharacterClass("entropy_base64", _DIGITS + _LOWER + _LOWER.upper() + "+/", 24, 4.0),
    CharacterClass("entropy_url", _DIGITS + _LOWER + _LOWER.upper() + "_-", 24, 4.0),
)
#: Candidates that are no secrets: numbers, words joined by signs, UUIDs, alphabets, examples.
ALLOWED = (
    "^[0-9]+$",
    "^[A-Za-z]?[a-z]+([-_/+][A-Za-z]?[a-z]+)*$",
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "abcdefgh|ABCDEFGH|0123456789|qwertyuiop",
    "[Ee]xample|EXAMPLE|[Pp]laceholder|PLACEHOLDER|[Cc]hange_?[Mm]e|[Xx]{8}",
)
#: What stands before a checksum.
ANNOUNCED = "([Ss][Hh][Aa][-_]?[0-9]+|[Mm][Dd]5|[Cc]ommit|[Cc]hecksum|[Ii]ntegrity|base64,)[-\"'=: ]*$"
#: Characters before a candidate that are looked at.
BEFORE = 24
#: Windows that one pass counts through; hits whose places are added up together.
WINDOWS, HITS = 512, 256


def _hits(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches that do not overlap, each with the length and the end of what precedes it."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    told = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern)
    rows = F.zip_with(
        F.arrays_zip(found.alias("value"), told.alias("told")), F.slice(gaps, 1, F.size(found)),
        lambda m, gap: F.struct(F.length(gap).cast("long").alias("gap"), m["value"].alias("value"), m["told"].alias("told"), F.right(gap, F.lit(BEFORE)).alias("before")),
    )
    # Most texts have no match; these are only searched, not cut.
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<gap:bigint,value:string,told:string,before:string>>"))


_SPAN = "struct<start:bigint,end:bigint,value:string,told:string,before:string>"


def _placed(hits: str) -> Column:
    """Hits with their places. Running sums go over groups of hits, then over the groups."""
    own = f"""
      aggregate(slice(p, g * {HITS} + 1, {HITS}), named_struct('at', 0L, 'out', cast(array() as array<{_SPAN}>)), (s, x) -> named_struct(
        'at', s.at + x.gap + length(x.value),
        'out', concat(s.out, array(named_struct('start', s.at + x.gap, 'end', s.at + x.gap + length(x.value), 'value', x.value, 'told', x.told, 'before', x.before)))))"""
    groups = f"transform(sequence(0, greatest(size(p) - 1, 0) div {HITS}), g -> {own})"
    summed = f"""
      aggregate({groups}, named_struct('at', 0L, 'out', cast(array() as array<struct<base:bigint,out:array<{_SPAN}>>>)), (s, g) -> named_struct(
        'at', s.at + g.at, 'out', concat(s.out, array(named_struct('base', s.at, 'out', g.out))))).out"""
    moved = "transform(o.out, x -> named_struct('start', o.base + x.start, 'end', o.base + x.end, 'value', x.value, 'told', x.told, 'before', x.before))"
    # An array of one element gives its value a name, which is then computed once.
    return F.expr(f"flatten(transform(array({hits}), p -> flatten(transform({summed}, o -> {moved}))))")


def _windows(candidates: str, of: CharacterClass) -> Column:
    """Spans of the windows of high entropy. Ten counts of six bits lie in one number."""
    width, slots = of.width, -(-len(of.alphabet) // 10)
    steps = [round((n + 1) * math.log2(n + 1) * SCALE) - round(n * math.log2(max(n, 1)) * SCALE) for n in range(width)]
    # Adding one to a count of n adds steps[n] to the sum.
    step = f"array({', '.join(f'{v}L' for v in steps)})"
    entering, leaving = "get(codes, j)", f"get(codes, j - {width})"
    count = lambda code: f"(shiftright(s.counts[{code} div 10], cast(6 * ({code} % 10) as int)) & 63)"
    one = lambda code: f"if(k = {code} div 10, shiftleft(1L, cast(6 * ({code} % 10) as int)), 0L)"
    # The state before character j is of the window that ends there.
    high = f"(j >= {width} and s.sum <= {of.limit})"
    new = f"({high} and j - {width} > s.to)"
    state = f"""named_struct(
      'counts', transform(s.counts, (n, k) -> n + {one(entering)} - {one(leaving)}),
      'sum', s.sum - if(j < {width}, 0L, get({step}, cast({count(leaving)} - 1 as int)))
             + get({step}, cast({count(entering)} - if({entering} <=> {leaving}, 1, 0) as int)),
      'from', if({new}, j - {width}, s.from), 'to', if({high}, j, s.to),
      'runs', if({new} and s.to >= 0, concat(s.runs, array(named_struct('from', s.from, 'to', s.to))), s.runs))"""
    zero = f"named_struct('counts', array_repeat(0L, {slots}), 'sum', 0L, 'from', 0, 'to', -1, 'runs', cast(array() as array<struct<from:int,to:int>>))"
    ended = "if(s.to >= 0, concat(s.runs, array(named_struct('from', s.from, 'to', s.to))), s.runs)"
    runs = f"aggregate(sequence(0, size(codes)), {zero}, (s, j) -> {state}, s -> {ended})"
    block = f"transform(array(slice(all, b * {WINDOWS} + 1, {WINDOWS + width - 1})), codes -> transform({runs}, r -> named_struct('start', x.start + b * {WINDOWS} + r.from, 'end', x.start + b * {WINDOWS} + r.to)))[0]"
    codes = f"transform(split(x.value, ''), c -> instr('{of.alphabet}', c) - 1)"
    found = f"flatten(transform({candidates}, x -> transform(array({codes}), all -> flatten(transform(sequence(0, (size(all) - {width}) div {WINDOWS}), b -> {block})))[0]))"
    # Runs of neighbouring blocks touch; runs of different candidates do not.
    begins = "filter(rs, (r, i) -> i = 0 or r.start > rs[i - 1].end)"
    ends = "filter(rs, (r, i) -> i = size(rs) - 1 or rs[i + 1].start > r.end)"
    return F.expr(f"transform(array({found}), rs -> zip_with({begins}, {ends}, (a, b) -> named_struct('start', a.start, 'end', b.end)))[0]")


def _named(spans: Column, kind: str, number: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _outside(spans: Column, others: Column) -> Column:
    """Spans that do not lie wholly inside one of the others."""
    return F.filter(spans, lambda x: ~F.exists(others, lambda o: (o["start"] <= x["start"]) & (x["end"] <= o["end"])))


def secrets(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED, announced: str = ANNOUNCED) -> DataFrame:
    """``docs`` (text, any others) with ``found``: an array of (start, order, end, kind) by start, then kind.

    Places count code points, ends are exclusive. Kinds of the base, ``assign``, ``access`` and ``hex``, come
    first and are never suppressed; spans of high entropy that lie inside a span of an earlier kind are left
    out. A null or empty text has no spans; very long texts are searched whole, in one task; equal rows give
    equal results, each its own row. Column names of ``docs`` that clash with ``found`` are replaced.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    patterns = [("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0)]
    # Runs begin where no character of the class stands before; that keeps the search from starting inside words.
    patterns += [(c.kind, f"(?<!{c.pattern.rpartition('{')[0]}){c.pattern}", 0) for c in classes]
    hits = docs.select(F.struct("*").alias("row")).select("row", *[_hits(text, p, g).alias(k) for k, p, g in patterns])
    placed = hits.select("row", *[_placed(k).alias(k) for k, _, _ in patterns])
    no_secret = lambda x: F.exists(F.array(*map(F.lit, allowed)), lambda p: F.regexp_like(x["value"], p)) | x["before"].rlike(announced)
    secret = placed.select(
        "row", F.filter("assign", lambda x: F.length(x["told"]) >= LEAST_VALUE).alias("assign"), "access", "hex",
        *[F.filter(c.kind, lambda x: ~no_secret(x)).alias(c.kind) for c in classes],
    )
    spans = secret.select("row", F.concat(*[_named(F.col(k), k, n) for n, k in enumerate(("assign", "access", "hex"))]).alias("found"), *[_windows(c.kind, c).alias(c.kind) for c in classes])
    for n, c in enumerate(classes):
        rest = [other.kind for other in classes[n + 1 :]]
        spans = spans.select("row", F.concat("found", _named(_outside(F.col(c.kind), F.col("found")), c.kind, 3 + n)).alias("found"), *rest)
    return spans.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "found"], F.array_sort("found").alias("found"))


def scanned(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every row of ``docs`` (doc_id, text)."""
    base = F.filter("found", lambda x: x["order"] < 3)
    count = lambda k: F.size(F.filter("found", lambda x: x["order"] == k)).cast("long")
    return secrets(docs.select("doc_id", "text")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
    )


def oracle(classes: tuple[CharacterClass, ...] = CLASSES) -> str:
    """SQL that counts every window anew."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *[(c.kind, c.pattern) for c in classes]]
    hits = " UNION ALL ".join(
        f"SELECT r, {n} AS ord, '{k}' AS kind, unnest(regexp_extract_all(text, {quoted(p)})) AS value,"
        f" unnest(regexp_extract_all(text, {quoted(p)}, {2 if k == 'assign' else 0})) AS told,"
        f" unnest(string_split_regex(text, {quoted(p)})) AS gap, unnest(range(len(regexp_extract_all(text, {quoted(p)})) + 1)) AS i FROM docs"
        for n, (k, p) in enumerate(kinds)
    )
    table = ", ".join(str(round(n * math.log2(max(n, 1)) * SCALE)) for n in range(max(c.width for c in classes) + 1))
    no_secret = " OR ".join([f"regexp_matches(value, {quoted(p)})" for p in ALLOWED] + [f"regexp_matches(right(gap, {BEFORE}), {quoted(ANNOUNCED)})"])
    facts = ", ".join(f"({3 + n}, {c.width}, {c.limit})" for n, c in enumerate(classes))
    inside = lambda n: f"NOT EXISTS (SELECT 1 FROM upto{n - 1} u WHERE u.r = e.r AND u.a <= e.a AND e.z <= u.z)"
    levels = ", ".join(f"upto{n} AS (SELECT * FROM upto{n - 1} UNION ALL SELECT r, ord, kind, a, z FROM runs e WHERE ord = {3 + n} AND {inside(n)})" for n in range(len(classes)))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({hits}),
placed AS (
  SELECT *, sum(length(gap)) OVER before + coalesce(sum(length(value)) OVER (PARTITION BY r, ord ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM hits WHERE value IS NOT NULL WINDOW before AS (PARTITION BY r, ord ORDER BY i)
), base AS (
  SELECT r, ord, kind, a, a + length(value) AS z FROM placed WHERE ord IN (1, 2) OR ord = 0 AND length(told) >= {LEAST_VALUE}
), classes(ord, width, most) AS (VALUES {facts}),
windows AS (
  SELECT r, ord, kind, i, a, width, most, unnest(range(length(value) - width + 1)) AS w, value FROM placed JOIN classes USING (ord) WHERE NOT ({no_secret})
), high AS (
  SELECT r, ord, kind, i, a + w AS a, a + w + width AS z FROM windows
  WHERE list_sum(list_transform(list_distinct(string_split(substr(value, w + 1, width), '')),
    lambda c: [{table}][width - length(replace(substr(value, w + 1, width), c, '')) + 1])) <= most
), islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY r, ord ORDER BY a) AS island
  FROM (SELECT *, CASE WHEN a <= lag(z) OVER (PARTITION BY r, ord ORDER BY a) THEN 0 ELSE 1 END AS fresh FROM high)
), runs AS (SELECT r, ord, kind, min(a) AS a, max(z) AS z FROM islands GROUP BY r, ord, kind, island),
{levels.replace("upto-1", "base")},
texts AS (
  SELECT r, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
         string_agg(kind || ':' || a::BIGINT || ':' || z::BIGINT, ',' ORDER BY a, ord) FILTER (ord < 3) AS base,
         string_agg(kind || ':' || a::BIGINT || ':' || z::BIGINT, ',' ORDER BY a, ord, z) AS spans
  FROM upto{len(classes) - 1} GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (r)
"""


ORACLE = oracle()
