"""Personal data replaced by surrogates of the same type, gender, script and format, in DataFrame functions only.

Entities are found by patterns. A surrogate is drawn from a keyed hash of the entity's canonical form,
so one entity has one surrogate in all documents, however it is spelled. Letters become letters of the
same script and case, digits digits; separators, country codes, labels and honorifics stay. Canonical
surrogates, with the prefix that stays, are compared over the whole corpus: one that two entities share, or that is itself an entity,
is drawn anew for all but the first, until all are distinct; where a format has no room left, in a longer one.
Domains of e-mail addresses are entities of their own, placed before the addresses. A number of the numbering
plan +1 is the same entity with and without this country code.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logferry.llm.store import written

#: What makes draws unguessable; callers pass their own.
KEY = "change-me"
#: Draws in the entity's own format; what is left then has a format that is nearly full and gets a longer one.
MOST_DRAWS = 40

#: Types in order of precedence, with their patterns (Java regular expressions without groups to capture).
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+'-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9_+/.~\-]{6,}",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\b(?:ghp|gho|sk|pk|xox[bp])[_-][A-Za-z0-9_\-]{16,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9-])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9-])|(?<![0-9-])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "name": r"\b(?:Mr|Mrs|Ms|Miss|Dr|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr)\b\.? \p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?|(?:г-н|г-жа) \p{Lu}\p{L}+(?: \p{Lu}\p{L}+)?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these characters and words has no entity.
SIGNS = "[@0-9=:]"
TITLES = ("Mr", "Ms", "Miss", "Dr", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Sra", "Sr", "г-")

# Letters of the scripts that surrogates can be written in, and given names by gender.
ALPHABETS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[0-9]": "0123456789",
    r"[\p{IsLatin}&&\p{Ll}]": "áàâäåãçéèêëíìîïñóòôöõøúùûüýß", r"[\p{IsLatin}&&\p{Lu}]": "ÁÀÂÄÅÃÇÉÈÊËÍÌÎÏÑÓÒÔÖÕØÚÙÛÜÝ",
    r"[\p{IsCyrillic}&&\p{Ll}]": "абвгдежзиклмнопрстуфхцчшэюя", r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    r"[\p{IsGreek}&&\p{Ll}]": "αβγδεζηθικλμνξοπρστυφχψω", r"[\p{IsGreek}&&\p{Lu}]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    r"\p{IsHan}": "王李张刘陈杨黄赵吴周徐孙马朱胡林郭何高罗", r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてと",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテト", r"\p{IsHangul}": "가나다라마바사아자차카타파하김이박최정강",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطعغفقكلمنهوي", r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת", r"\p{IsDevanagari}": "कखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
}
HEX = "0123456789abcdef"
WOMEN = "Ada Alma Anna Berta Carla Clara Dora Edith Elena Emma Eva Flora Greta Ida Irma Julia Karla Laura Lena Lucia Maria Marta Nora Olga Paula Rosa Sara Silvia Sofia Vera".split()
MEN = "Adam Albert Anton Bruno Carl David Edgar Emil Erik Felix Georg Hugo Ivan Jakob Jonas Julius Karl Leo Lukas Marco Martin Max Oskar Otto Paul Peter Robert Simon Thomas Viktor".split()
SYLLABLES = "ba be bo da de do fa fi ga go ha he ka ke ki la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se so ta te ti to va vi wa we za zo".split()


def _draw(base: Column | str, at: Column | int, most: int) -> Column:
    """A number below ``most`` from the hash of ``base`` and a position."""
    text = F.concat(base if isinstance(base, Column) else F.col(base), F.lit("|"), (at if isinstance(at, Column) else F.lit(at)).cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long") % most


def _from(text: Column, at: Column) -> Column:
    """All of ``text`` from its character number ``at`` on."""
    return F.substring(text, at, F.char_length(text))


def _pick(values: str | list[str], number: Column) -> Column:
    if isinstance(values, str):
        return F.substring(F.lit(values), (number + 1).cast("int"), F.lit(1))
    return F.element_at(F.array(*map(F.lit, values)), (number + 1).cast("int"))


def entity_type(raw: Column) -> Column:
    whole = [(t, F.lit(f"^(?:{p})$")) for t, p in PATTERNS.items()]
    out = F.when(F.regexp(raw, whole[0][1]), whole[0][0])
    for t, p in whole[1:]:
        out = out.when(F.regexp(raw, p), t)
    return out.otherwise("phone")


def _national(raw: Column) -> Column:
    """Whether a phone number is one of ten digits after the country code +1."""
    return F.regexp(raw, F.lit("^\\+1(?:[^0-9]*[0-9]){10}[^0-9]*$"))


_LABEL = r"^(?i:(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"


def prefix_of(kind: Column, raw: Column) -> Column:
    """What of an entity stays: a secret's label, a key's mark, a country code, an honorific."""
    return (
        F.when(kind == "secret", F.regexp_extract(raw, _LABEL, 0))
        .when(kind == "key", F.regexp_extract(raw, "^(?:AKIA|ASIA|[a-z]+[_-])", 0))
        .when((kind == "phone") & _national(raw), "+1")
        .when(kind == "phone", F.regexp_extract(raw, "^\\+[0-9]{1,3}(?=[^0-9])|^\\+[0-9]", 0))
        .when(kind == "iban", F.substring(raw, 1, 2))
        .when(kind == "card", F.substring(raw, 1, 1))
        .when(kind == "name", F.regexp_extract(raw, "^[^ ]+ ", 0))
        .otherwise("")
    )


def canonical(kind: Column, raw: Column) -> Column:
    """Spellings of one entity share it: only letters and digits, e-mail in lower case, a name's gender.

    Phone numbers with another country code than +1 begin with the sign, so they equal no number without one.
    """
    plain = F.regexp_replace(raw, "[^\\p{L}\\p{N}]", "")
    rest = F.expr("substring(raw, char_length(prefix) + 1)")
    return (
        F.when(kind == "email", F.lower(raw))
        .when(kind == "ip", F.regexp_replace(raw, "(?<![0-9])0+(?=[0-9])", ""))
        .when(kind == "name", F.concat(F.when(F.regexp(raw, F.lit("^(?:Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа)")), "f|").when(F.regexp(raw, F.lit("^Dr")), "-|").otherwise("m|"), rest))
        .when(kind == "secret", rest)
        .when((kind == "phone") & _national(raw), F.substring(plain, 2, 10))
        .when((kind == "phone") & raw.startswith("+"), F.concat(F.lit("+"), plain))
        .otherwise(plain)
    )


def _letters(text: Column, base: Column) -> Column:
    """Every letter and digit of ``text`` replaced by one of its alphabet, by hash of position."""

    def one(c: Column, i: Column) -> Column:
        out = None
        for pattern, letters in ALPHABETS.items():
            new = _pick(letters, _draw(base, i, len(letters)))
            out = F.when(F.regexp(c, F.lit(pattern)), new) if out is None else out.when(F.regexp(c, F.lit(pattern)), new)
        # Scripts without an alphabet here are written in Latin letters and digits: nothing real stays.
        for pattern, letters in ((r"\p{Lu}", "[A-Z]"), (r"\p{L}", "[a-z]"), (r"\p{N}", "[0-9]")):
            out = out.when(F.regexp(c, F.lit(pattern)), _pick(ALPHABETS[letters], _draw(base, i, len(ALPHABETS[letters]))))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def kept_of(kind: Column, raw: Column, prefix: Column) -> Column:
    """So many characters at the beginning of the canonical form stay."""
    signs = F.char_length(F.regexp_replace(prefix, "[^\\p{L}\\p{N}]", ""))
    phone = F.when(_national(raw) | ~raw.startswith("+"), 0).otherwise(signs + 1)
    return F.when(kind == "phone", phone).when(kind.isin("iban", "card", "key"), signs).otherwise(0)


def surrogate_of(kind: Column, canon: Column, base: Column, tail: Column) -> Column:
    """The canonical surrogate for one draw; ``base`` holds key, type, entity and number of the draw.

    ``tail`` is the surrogate of an e-mail's domain.
    """
    hexed = F.array_join(F.transform(F.split(canon, ""), lambda c, i: _pick(HEX, _draw(base, i, 16))), "")
    ip = F.concat_ws(".", (_draw(base, 0, 223) + 1).cast("string"), *[_draw(base, k, 256).cast("string") for k in (1, 2)], (_draw(base, 3, 254) + 1).cast("string"))
    email = F.concat(_letters(F.regexp_extract(canon, "^(.*)@", 1), base), F.lit("@"), tail)
    domain = F.concat(_letters(F.regexp_extract(canon, "^(.*)\\.", 1), base), F.regexp_extract(canon, "(\\.[^.]*)$", 1))
    given = F.when(F.substring(canon, 1, 1) == "f", _pick(WOMEN, _draw(base, 0, len(WOMEN)))).otherwise(_pick(MEN, _draw(base, 0, len(MEN))))
    family = F.initcap(F.concat(*[_pick(SYLLABLES, _draw(base, k, len(SYLLABLES))) for k in (1, 2, 3, 4)]))
    said = _from(canon, F.lit(3))
    latin = F.regexp(said, F.lit("^[\\p{IsLatin}' -]+$"))
    name = F.when(latin & said.contains(" "), F.concat_ws(" ", given, family)).when(latin, family).otherwise(_letters(said, base))
    is_hex = (kind == "secret") & F.regexp(canon, F.lit("^[0-9a-f]+$"))
    return F.when(kind == "ip", ip).when(kind == "email", email).when(kind == "domain", domain).when(kind == "name", F.concat(F.substring(canon, 1, 2), name)).when(is_hex, hexed).otherwise(_letters(canon, base))


def _longer(kind: Column, new: Column, base: Column, by: int) -> Column:
    """A canonical surrogate with ``by`` more drawn characters, for formats without room."""
    digits = F.concat(*[_draw(base, F.lit(f"+{k}"), 10).cast("string") for k in range(by)])
    letters = F.concat(*[_pick(SYLLABLES, _draw(base, F.lit(f"+{k}"), len(SYLLABLES))) for k in range(by)])
    email = F.concat(F.regexp_extract(new, "^(.*)@", 1), digits, F.regexp_extract(new, "(@.*)$", 1))
    domain = F.concat(F.regexp_extract(new, "^(.*)\\.", 1), digits, F.regexp_extract(new, "(\\.[^.]*)$", 1))
    return F.when(kind == "email", email).when(kind == "domain", domain).when(kind == "name", F.concat(new, letters)).when(kind == "ip", F.concat(new, F.lit("."), digits)).otherwise(F.concat(new, digits))


def _filled(kind: Column, raw: Column, prefix: Column, new: Column) -> Column:
    """The canonical surrogate in the spelling of ``raw``: its separators, its upper case, its prefix."""
    plain = F.regexp_replace(new, "[^\\p{L}\\p{N}]", "")
    plain = F.when((kind == "phone") & _national(raw), F.concat(F.lit("1"), plain)).otherwise(plain)
    chars = F.split(raw, "")

    def one(c: Column, i: Column) -> Column:
        nth = F.char_length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^\\p{L}\\p{N}]", ""))
        letter = F.substring(plain, nth, F.lit(1))
        is_upper = (kind == "email") & F.regexp(c, F.lit("\\p{Lu}"))
        return F.when(F.regexp(c, F.lit("[\\p{L}\\p{N}]")), F.when(is_upper, F.upper(letter)).otherwise(letter)).otherwise(c)

    spelled = F.array_join(F.transform(chars, one), "")
    # A surrogate of a longer format ends with what has no place in ``raw``; a longer e-mail stays as drawn.
    n = F.char_length(F.regexp_replace(raw, "[^\\p{L}\\p{N}]", ""))
    keeps = F.concat(prefix, _from(spelled, F.char_length(prefix) + 1), _from(plain, n + 1))
    spelled = F.when(F.char_length(plain) > n, new).otherwise(spelled)
    return F.when(kind == "ip", new).when(kind == "secret", F.concat(prefix, new)).when(kind == "name", F.concat(prefix, _from(new, F.lit(3)))).when(kind == "email", spelled).otherwise(keeps)


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``(kind, canon, new)``: a distinct surrogate for every row of ``entities`` (kind, canon).

    With a column ``kept``, so many characters at the beginning of ``canon`` stay; e-mail addresses have a
    column ``tail``, the surrogate of their domain. Draws are repeated until
    no surrogate is shared or is an entity itself. What ``MOST_DRAWS`` draws do not place, as a format
    is full or nearly full, gets a longer format, by one more character with each further draw.
    """
    kept = F.col("kept") if "kept" in entities.columns else F.lit(0)
    tail = F.col("tail") if "tail" in entities.columns else F.lit(None).cast("string")

    def drawn(rows: DataFrame, draw: int) -> DataFrame:
        base = F.concat(F.lit(f"{key}|{draw}|"), "kind", F.lit("|"), "canon")
        new = surrogate_of(F.col("kind"), F.col("canon"), base, F.col("tail"))
        if draw >= MOST_DRAWS:
            new = _longer(F.col("kind"), new, base, draw - MOST_DRAWS + 1)
        return rows.withColumn("new", F.when(F.col("kept") > 0, F.concat(F.substring("canon", F.lit(1), F.col("kept")), _from(new, F.col("kept") + 1))).otherwise(new))

    known = entities.select("kind", "canon", kept.alias("kept"), tail.alias("tail"))
    taken = known.select("kind", F.col("canon").alias("new"))
    done, todo = None, known
    for draw in count():
        tried = written(drawn(todo, draw), "drawn")
        free = tried.join(taken, ["kind", "new"], "left_anti")
        first = written(free.groupBy("kind", "new").agg(F.min("canon").alias("canon")).select("kind", "canon", "new"), "surrogates")
        done = first if done is None else done.union(first)
        taken = taken.union(first.select("kind", "new"))
        todo = written(tried.select("kind", "canon", "kept", "tail").join(first.select("kind", "canon"), ["kind", "canon"], "left_anti"), "redrawn")
        if todo.isEmpty():
            return done


def placed(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``(kind, canon, new)`` of ``entities`` (kind, canon, kept), e-mail addresses after their domains."""
    mail = entities.where("kind = 'email'").withColumn("domain", F.regexp_extract("canon", "@(.*)$", 1))
    domains = surrogates(mail.select(F.lit("domain").alias("kind"), F.col("domain").alias("canon")).distinct(), key)
    mail = mail.join(domains.select(F.col("canon").alias("domain"), F.col("new").alias("tail")), "domain").select("kind", "canon", "kept", "tail")
    others = entities.where("kind <> 'email'").select("kind", "canon", "kept", F.lit(None).cast("string").alias("tail"))
    return surrogates(written(mail.union(others), "placed"), key)


def replaced(docs: DataFrame, key: str = KEY, counted: str | None = "n_entities") -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and in the column ``counted`` the number of replaced places.

    Null and empty texts stay; so do texts without entities, and an empty table. Equal rows are changed
    alike. All other columns stay, whatever their names, but one named as ``counted`` is replaced; with None
    nothing is counted. A very long text is one row of its task; its entities alone are shuffled one by one.
    """
    names = [c for c in docs.columns if c != counted]
    others = [c for c in names if c != "text"]
    # Other columns are held in one struct under numbers, so none has the name of a helper.
    held = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    rows = docs.select(held.alias("row"), "text")
    has = F.regexp("text", F.lit(SIGNS))
    for title in TITLES:
        has = has | F.col("text").contains(title)
    found = F.when(F.coalesce(has, F.lit(False)), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    # Patterns are looked for once; the entities found stay beside the texts.
    marked = written(rows.withColumn("found", found), "marked")
    touched = marked.where("size(found) > 0").withColumn("row_key", F.md5(F.to_json(F.struct("row", F.xxhash64("text")))))
    raws = touched.select("row_key", F.explode(F.array_distinct("found")).alias("raw"))
    kind, raw, prefix = F.col("kind"), F.col("raw"), F.col("prefix")
    typed = raws.withColumn("kind", entity_type(raw)).withColumn("prefix", prefix_of(kind, raw)).withColumn("canon", canonical(kind, raw))
    spelled = written(typed.select("kind", "canon", "prefix", "raw").distinct(), "entities")
    # What is compared is what is rendered: an entity keeps the longest prefix of its spellings.
    new = placed(spelled.groupBy("kind", "canon").agg(F.max(kept_of(kind, raw, prefix)).alias("kept")), key)
    spelling = written(spelled.join(new, ["kind", "canon"]).select("raw", _filled(kind, raw, prefix, F.col("new")).alias("new")), "spelled")
    by_row = raws.distinct().join(spelling, "raw").groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("raw", "new"))).alias("new"))
    parts = F.split("text", ENTITY, -1)
    rebuilt = F.concat(F.element_at(parts, 1), F.array_join(F.transform("found", lambda m, i: F.concat(F.element_at("new", m), F.get(parts, i + 1))), ""))
    changed = touched.join(by_row, "row_key").select("row", rebuilt.alias("text"), F.size("found").alias("n"))
    same = marked.where("found IS NULL OR size(found) = 0").select("row", "text", F.lit(0).alias("n"))
    out = [F.col("text") if c == "text" else F.col(f"row.c{others.index(c)}").alias(c) for c in names]
    return same.union(changed).select(*out, *([F.col("n").alias(counted)] if counted else []))
