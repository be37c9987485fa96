"""Repair of conversations' structure at least cost, by the auction algorithm for shortest paths.

A conversation should read ``(s?(ua)+)?`` in its roles' initials and hold no blank, repeated or broken-off
rows. Edits are Keep (0), Rerole to user or assistant (1), Delete (2, and the only one for blank and
duplicate rows) and Insert of an empty user or assistant row (5); a truncated row that stays adds 5. Repairs
are the paths through a lattice: a node is (rows done, state of the pattern), an edit is an arc.

Every node has a price. A path is extended along the cheapest arc as long as prices are tight, otherwise its
last node's price is raised and the path contracted (Bertsekas). Origins are taken from the last column to the
first, with the prices kept; a run ends where it meets a node whose price has converged, and then all its
nodes have. Converged prices are distances to the end, so an arc lies on a shortest path if and only if it is
tight, and tracing the ASCII-least tight arc from the start gives the ASCII-least cheapest repair. What a
column's auction gives depends only on its row and on the differences of the next column's prices, so it is
run once for each of these.

Rows are judged and ordered without their texts, over ranges of (conv_id, turn), so that a very long
conversation is spread over many tasks; of it, one byte a row comes together to be repaired, as the audit
does in any result. Its texts are only read in order to be hashed, as a stream.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logferry.llm.arrays import column
from logferry.llm.store import written

#: White space that makes a text blank.
BLANK = " \t\n\x0b\x0c\r"
#: What edits cost, and what a truncated row that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern: nothing yet, after system, after user, after assistant; may it end there; where a
#: user or assistant row that fits leads, and its role.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (True, False, False, True)
FITTING = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Initials of roles as codes, other roles last; a row's code is its fault times four and its initial.
INITIALS = "sua"
OTHER = 3
FINE, GONE, BROKEN = range(3)


def kept_to(state: int, initial: int) -> int | None:
    """State after a row of this role is kept, or None where it does not fit."""
    if state == START and initial == 0:
        return SYSTEM
    return FITTING[state] if initial + 1 == FITTING[state] else None


def arcs(state: int, code: int | None) -> list[tuple[str, int, bool, int]]:
    """(letter, cost, whether it leads to the next column, state there); ``code`` None is the last column."""
    found = [("I", INSERT, False, FITTING[state])]
    if code is None:
        return found + [("", 0, True, START)] if ENDS[state] else found
    fault, initial = divmod(code, 4)
    found.append(("D", DELETE, True, state))
    if fault != GONE:
        more = TRUNCATED if fault == BROKEN else 0
        to = kept_to(state, initial)
        if to is not None:
            found.append(("K", KEEP + more, True, to))
        found.append(("R", REROLE + more, True, FITTING[state]))
    return found


def auction(code: int | None, following: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Converged prices of a column's four nodes, and of each node the ASCII-least tight arc (letter, state).

    ``following`` are the converged prices of the next column, none of them negative.
    """
    leaving = [arcs(state, code) for state in range(4)]
    prices, done = [0] * 4, [False] * 4
    length = lambda arc: arc[1] + (following if arc[2] else prices)[arc[3]]
    for origin in range(4):
        path = [] if done[origin] else [origin]
        while path:
            tip = path[-1]
            cheapest = min(leaving[tip], key=length)
            if prices[tip] < length(cheapest):
                prices[tip] = length(cheapest)
                if len(path) > 1:
                    path.pop()
            elif cheapest[2] or done[cheapest[3]]:
                for node in path:
                    done[node] = True
                path = []
            else:
                path.append(cheapest[3])
    tight = [min((arc[0], arc[3]) for arc in leaving[s] if length(arc) == prices[s]) for s in range(4)]
    return tuple(prices), tuple(tight)


class Lattice:
    """Cheapest repairs of sequences of row codes; columns that were solved are remembered."""

    def __init__(self):
        self._column: dict[tuple[int | None, tuple[int, ...]], int] = {}
        self._solved: list[tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]] = []

    def _solve(self, code: int | None, following: tuple[int, ...]) -> int:
        at = self._column.get((code, following))
        if at is None:
            prices, tight = auction(code, following)
            least = min(prices)
            at = self._column[code, following] = len(self._solved)
            # Prices matter by their differences; the least one is kept apart.
            self._solved.append((least, tuple(p - least for p in prices), tight))
        return at

    def repaired(self, codes: bytes) -> tuple[int, str]:
        """(cost, audit) of the cheapest repair, the ASCII-least of equals."""
        at = self._solve(None, (0,) * 4)
        chosen, base = array("L", [at]), self._solved[at][0]
        for code in reversed(codes):
            at = self._solve(code, self._solved[at][1])
            base += self._solved[at][0]
            chosen.append(at)
        cost = base + self._solved[at][1][START]
        letters, state, place = [], START, len(chosen) - 1
        while True:
            letter, state = self._solved[chosen[place]][2][state]
            if not letter:
                return cost, "".join(letters)
            letters.append(letter)
            place -= letter != "I"


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` of ``rows`` as the query damages them, by crc32 of ``conv_id:turn``."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    return (
        rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def judged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, digest, blank, repeated, truncated)``: rows without their texts.

    ``repeated`` says that role and text occur at an earlier turn; of equal rows of one turn, none is.
    """
    bare = F.rtrim("text", F.lit(BLANK))
    slim = rows.select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = ["conv_id", "role", "digest"]
    # Few texts occur twice, and only these are joined.
    first = slim.groupBy(*[F.col(c).alias(f"{c}_") for c in same]).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = slim.join(first.drop("n"), [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in same], "left")
    return joined.select(*slim.columns, F.coalesce(place > F.col("first"), F.lit(False)).alias("repeated"))


_PIECE = "conv_id long, part int, piece long, codes binary, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"


def _changes(values: pa.Array, before) -> np.ndarray:
    """Whether each value differs from the one before it; null equals null."""
    shifted = pa.concat_arrays([pa.array([before], values.type), values[:-1]])
    equal = pc.or_(pc.fill_null(pc.equal(values, shifted), False), pc.and_(values.is_null(), shifted.is_null()))
    return ~equal.to_numpy(zero_copy_only=False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one conversation in ordered rows, each with its codes and counts."""
    part, piece = TaskContext.get().partitionId(), 0
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = {c: column(batch, c) for c in ("conv_id", "turn", "role", "digest")}
        changed = {c: _changes(v, last[c] if last else None) for c, v in columns.items()}
        if last is None:
            changed["conv_id"][0] = True
        last = {c: v[-1].as_py() for c, v in columns.items()}
        flags = {c: column(batch, c).to_numpy(zero_copy_only=False) for c in ("blank", "truncated", "repeated")}
        same_row = ~(changed["conv_id"] | changed["turn"] | changed["role"] | changed["digest"])
        duplicate = ~flags["blank"] & (flags["repeated"] | same_row)
        gone = flags["blank"] | duplicate
        truncated = flags["truncated"] & ~gone
        initials = pc.index_in(pc.utf8_slice_codeunits(columns["role"], 0, 1), pa.array(list(INITIALS), columns["role"].type))
        initial = pc.fill_null(initials, OTHER).to_numpy(zero_copy_only=False)
        begins = changed["conv_id"].copy()
        begins[0] = True
        starts = np.flatnonzero(begins)
        # What a row makes with the one before it counts inside a piece; between pieces it is added later.
        legal = np.isin(np.roll(initial, 1) * 4 + initial, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])
        turn = columns["turn"]
        known = ~turn.is_null().to_numpy(zero_copy_only=False)
        new_turn = known & (begins | changed["turn"])
        turn = pc.fill_null(turn, 0).to_numpy()
        total = lambda v: np.add.reduceat(v.astype(np.int64), starts)
        low = np.minimum.reduceat(np.where(known, turn, np.iinfo(np.int64).max), starts)
        high = np.maximum.reduceat(np.where(known, turn, np.iinfo(np.int64).min), starts)
        codes = (np.where(gone, GONE, np.where(truncated, BROKEN, FINE)) * 4 + initial).astype(np.uint8).tobytes()
        stops = [*starts[1:].tolist(), len(batch)]
        some = total(known) == 0
        yield pa.RecordBatch.from_arrays(
            [
                columns["conv_id"].take(pa.array(starts)), pa.array([part] * len(starts), pa.int32()), pa.array(range(piece, piece + len(starts)), pa.int64()),
                pa.array([codes[i:j] for i, j in zip(starts.tolist(), stops, strict=True)], pa.binary()),
                *(pa.array(total(v)) for v in (flags["blank"], duplicate, truncated, ~legal & ~begins, new_turn)),
                pa.array(low, mask=some), pa.array(high, mask=some),
            ],
            [f.split(" ")[0] for f in _PIECE.split(", ")],
        )
        piece += len(starts)


_FACTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    """Pieces of one conversation, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.high, self.low = conv_id, bytearray(), None, None
        self.sums = [0] * 5

    def add(self, row: dict) -> None:
        if not row["codes"]:
            return
        for k, c in enumerate(("blank", "duplicate", "truncated", "illegal", "turns")):
            self.sums[k] += row[c]
        if self.codes:
            pair = (self.codes[-1] % 4, row["codes"][0] % 4)
            self.sums[3] += pair not in ((0, 1), (1, 2), (2, 1))
            # Rows come by turn, so a turn of both pieces is the last of one and the first of the other.
            self.sums[4] -= self.high is not None and self.high == row["low"]
        self.codes += row["codes"]
        if row["low"] is not None:
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def row(self, lattice: Lattice) -> tuple:
        cost, audit = lattice.repaired(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums[4]
        return (self.conv_id, gaps, *self.sums[:4], cost, audit)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lattice, now = Lattice(), None
    names = [f.split(" ")[0] for f in _FACTS.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()]
    batched = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    for batch in batches:
        ready = []
        for row in batch.to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                if now:
                    ready.append(now.row(lattice))
                now = _Conversation(row["conv_id"])
            now.add(row)
        if ready:
            yield batched(ready)
    if now:
        yield batched([now.row(lattice)])


class _Repaired:
    """Digest of a repaired conversation, whose rows come one after the other."""

    def __init__(self, facts: dict):
        self.facts, self._edits = facts, iter(facts["audit"])
        self._state, self._hash, self._any = START, hashlib.sha256(), False

    def _write(self, role: str, text: bytes) -> None:
        self._hash.update((b"\n" if self._any else b"") + role.encode() + b":" + text)
        self._any = True

    def _insert(self) -> str | None:
        """Write the rows that are inserted here; the next other edit."""
        for letter in self._edits:
            if letter != "I":
                return letter
            self._state = FITTING[self._state]
            self._write(ROLES[self._state], b"")
        return None

    def add(self, role: str, text: bytes) -> None:
        letter = self._insert()
        if letter == "K":
            self._state = kept_to(self._state, INITIALS.find(role[:1]))
            self._write(role, text)
        elif letter == "R":
            self._state = FITTING[self._state]
            self._write(ROLES[self._state], text)

    def row(self) -> list:
        self._insert()
        return [*self.facts.values(), self._hash.hexdigest()]


_RESULT = f"{_FACTS}, repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's facts come first, then its rows in order."""
    now = None
    names = [f.split(" ")[0] for f in _RESULT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    batched = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    for batch in batches:
        ready = []
        facts = column(batch, "facts")
        for k, role, text in zip(range(len(batch)), column(batch, "role").to_pylist(), column(batch, "text").cast(pa.large_binary()).to_pylist(), strict=True):
            if role is None:
                if now:
                    ready.append(now.row())
                now = _Repaired(facts[k].as_py())
            else:
                now.add(role, text)
        if ready:
            yield batched(ready)
    if now:
        yield batched([now.row()])


def repaired(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): what is wrong and the cheapest repair.

    Gives ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``. Rows are
    taken by turn, null first, then by role and by the MD5 of the text; equal rows are duplicates. A row's
    first fault counts, of blank, duplicate and truncated. Null roles and texts are one space; a null conv_id
    is a conversation. A very long text or conversation is read as a stream. ``every`` (conv_id) names further
    conversations, which may have no row: zeros, an empty audit and the digest of nothing. Other columns are
    ignored.
    """
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    order = ["conv_id", "turn", "role", "digest"]
    slim = written(judged(rows), "judged")
    pieces = slim.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, _PIECE)
    ids = (rows if every is None else every).select("conv_id").distinct()
    nothing = [F.lit(None).cast(f.split(" ")[1]).alias(f.split(" ")[0]) for f in _PIECE.split(", ")[1:]]
    solved = pieces.union(ids.select("conv_id", *nothing)).repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(_solved, _FACTS)
    facts = solved.select("conv_id", F.struct("*").alias("facts"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"))])
    texts = rows.select("conv_id", F.lit(None).cast(facts.schema["facts"].dataType).alias("facts"), "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text")
    # A conversation's facts have no role and stand before its rows.
    both = facts.union(texts).withColumn("is_row", F.col("role").isNotNull())
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest").select("facts", "role", "text").mapInArrow(_hashed, _RESULT)


ORACLE = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), crc AS (
  SELECT *, xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(k, ''),
      lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 20 AS kind
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE kind <> 0
), placed AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i
  FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed
), judged AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS r,
         CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM seen
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), best AS (
  SELECT conv_id, n AS i, {'c': 0, 'a': ''} AS z, {'c': 10, 'a': 'II'} AS s, {'c': 5, 'a': 'I'} AS u, {'c': 0, 'a': ''} AS e FROM facts
  UNION ALL
  SELECT conv_id, i, list_min([bz, {'c': vu.c + 5, 'a': 'I' || vu.a}]), list_min([bs, {'c': vu.c + 5, 'a': 'I' || vu.a}]), vu, ve
  FROM (
    SELECT conv_id, i, bz, bs, list_min([bu, {'c': be.c + 5, 'a': 'I' || be.a}]) AS vu, list_min([be, {'c': bu.c + 5, 'a': 'I' || bu.a}]) AS ve
    FROM (
      SELECT best.conv_id, best.i - 1 AS i,
        list_min([{'c': z.c + 2, 'a': 'D' || z.a}, {'c': u.c + ru, 'a': 'R' || u.a}, {'c': CASE r WHEN 's' THEN s.c + ke WHEN 'u' THEN u.c + ke ELSE 1000000 END, 'a': 'K' || CASE r WHEN 's' THEN s.a ELSE u.a END}]) AS bz,
        list_min([{'c': s.c + 2, 'a': 'D' || s.a}, {'c': u.c + ru, 'a': 'R' || u.a}, {'c': CASE r WHEN 'u' THEN u.c + ke ELSE 1000000 END, 'a': 'K' || u.a}]) AS bs,
        list_min([{'c': u.c + 2, 'a': 'D' || u.a}, {'c': e.c + ru, 'a': 'R' || e.a}, {'c': CASE r WHEN 'a' THEN e.c + ke ELSE 1000000 END, 'a': 'K' || e.a}]) AS bu,
        list_min([{'c': e.c + 2, 'a': 'D' || e.a}, {'c': u.c + ru, 'a': 'R' || u.a}, {'c': CASE r WHEN 'u' THEN u.c + ke ELSE 1000000 END, 'a': 'K' || u.a}]) AS be
      FROM best JOIN (
        SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS ke, ke + 1 AS ru FROM judged
      ) j ON j.conv_id IS NOT DISTINCT FROM best.conv_id AND j.i = best.i
    )
  )
), solved AS (
  SELECT conv_id, z.c AS cost, z.a AS audit FROM best WHERE i = 0
), edits AS (
  SELECT conv_id, audit, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS k FROM solved WHERE audit <> ''
), numbered AS (
  SELECT conv_id, k, letter, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i FROM edits
), kept AS (
  SELECT n.conv_id, n.k, n.letter, j.role, j.text, row_number() OVER (PARTITION BY n.conv_id ORDER BY n.k) AS p,
         max(CASE WHEN letter = 'K' AND j.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS led
  FROM numbered n LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM n.conv_id AND j.i = n.i AND n.letter <> 'I' WHERE letter <> 'D'
), hashed AS (
  SELECT conv_id, string_agg(CASE letter WHEN 'K' THEN role || ':' || text
           ELSE CASE WHEN (p - led) % 2 = 1 THEN 'user:' ELSE 'assistant:' END || coalesce(text, '') END, chr(10) ORDER BY k) AS content
  FROM kept GROUP BY conv_id
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(content, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN hashed ON hashed.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
