"""Keyed surrogates for personal data.

Entities (e-mail addresses, phone numbers, IPv4 addresses, card and social security numbers,
secrets, names behind a title and wherever they recur in the document) are replaced by surrogates
of the same type and format.  A name goes on over capitalised words, initials and particles; past a
line break only over words that the document doesn't write small.

Numbers, secrets and the parts of addresses pass through a keyed permutation of the strings of
their length and alphabet, applied again until the result is valid for its type (Luhn digit,
octets, area codes), so different originals of one format get different surrogates and every
mention of one original the same.  Name parts are composed from syllables that suit their
script and the gender of the title; given names and surnames are mapped one by one, so "Mr Smith"
and "Mr John Smith" keep sharing a surname.

Surrogates of all distinct entities of the corpus are then checked: one that another entity has
too, or that occurs as an original, is drawn again under the next attempt, until none is left.
Only the entities with a later attempt are joined back, so a frequent entity costs nothing.

A null text stays null; repeated rows and missing doc_ids are treated like any others.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelattice.sources.kept import keep

# Titles by the gender of the person
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Sir", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Lady", "Госпожа")
NEUTRAL = ("Dr", "Prof", "Professor", "Mx", "Доктор")

# Alphabets by script
LATIN, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
CYRILLIC, GREEK = "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"
SYLLABLES = {
    "latin": ("b d f g h k l m n p r s t v br dr kl st tr".split(), "a e i o u".split(), {"m": "n r s l k d".split(), "f": "a ia ina ella".split(), "x": "e in en is".split()}),
    "cyrillic": ("б в г д ж з к л м н п р с т".split(), "а е и о у".split(), {"m": "н р с й к".split(), "f": "а ия ина".split(), "x": "ен ин ис".split()}),
    "greek": ("β γ δ κ λ μ ν π ρ σ τ φ".split(), "α ε ι ο υ".split(), {"m": "ος ης ας".split(), "f": "α η ια".split(), "x": "ι ω".split()}),
}

_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}",
    "secret": r"(?i:(?<![^\W_])(?P<word>token|password|passwd|secret|api_?key)\b[\"']?\s*(?P<sign>=(?![=>])|:(?!:))\s*)(?:(?P<quote>[\"'])(?P<quoted>(?:(?!(?P=quote))[^\n])+)(?P=quote)|[\"']?(?P<bare>[^\s\"']+))",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d(?:[ ./-]?\(?\d\)?){7,14}|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4})(?!\d)",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "name": rf"\b(?P<title>{'|'.join([*MALE, *FEMALE, *NEUTRAL])})\.?\s+(?P<name>{_NAME})",
}
PARTICLES = frozenset("van von der den de del della di da dos das du la le ten ter zu zur af av y e i bin ibn al el st".split())
_FINDERS = [(kind, re.compile(pattern)) for kind, pattern in PATTERNS.items()]
_DIGITS = re.compile(r"\d")
_WORD = re.compile(_NAME)
_GAP = re.compile(r"[^\S\n]*\n?[^\S\n]*")
_HEX = re.compile(r"[0-9a-fA-F]+")


def _may_hold(text: str) -> set[str]:
    """The types whose indispensable characters or words the text has; a quick test before the patterns."""
    out = {"email"} if "@" in text else set()
    if _DIGITS.search(text):
        out |= {"ipv4"} if text.count(".") > 2 else set()
        out |= {"ssn", "phone"} if any(c in text for c in "- .+") else set()
        out |= {"card"}
    if "=" in text or ":" in text:
        out.add("secret")
    if any(title in text for title in (*MALE, *FEMALE, *NEUTRAL)):
        out.add("name")
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _ascii_digits(value: str) -> str:
    return "".join(str(unicodedata.decimal(c)) for c in value if c.isdecimal())


def _name_words(text: str, start: int) -> list[tuple[int, int]]:
    """The spans of the capitalised words of the name that begins at ``start``."""
    out, at, broken = [], start, False
    while (m := _WORD.match(text, at)) is not None:
        word = m[0]
        end = m.end() - 2 * (word[-2:].lower() in ("'s", "’s"))
        initial = len(word) == 1 and text[m.end() : m.end() + 1] == "."
        if word[0].isupper():
            if out and (len(word) == 1 and not initial or broken and re.search(rf"\b{re.escape(word.lower())}\b", text)):
                break
            out.append((at, end))
        elif word not in PARTICLES:
            break
        gap = _GAP.match(text, m.end() + initial)
        if end < m.end() or gap.end() == m.end() and not initial:
            break
        at, broken = gap.end(), "\n" in gap[0]
    return out


def _secret_span(text: str, m: re.Match) -> tuple[int, int]:
    """The value of a secret; empty for a plain word in prose after a colon."""
    if m["quoted"] is not None:
        return m.span("quoted")
    start, end = m.span("bare")
    before = m.start()
    while before and (text[before - 1].isalnum() or text[before - 1] == "_"):
        before -= 1
    if before and text[before - 1] in "?&":  # a parameter of an address
        end = start + len(re.split("[&#]", text[start:end])[0])
    value = text[start:end].rstrip(".,;:!?)]}>") or text[start:end]
    prose = m["sign"] == ":" and not m["word"].lower().startswith("pass") and value.isalpha() and value in (value.lower(), value.capitalize()) and not (len(value) >= 12 and _HEX.fullmatch(value))
    return start, start if prose else start + len(value)


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities, ascending, not overlapping."""
    found: list[tuple[int, int, str, str]] = []
    known: dict[str, str] = {}
    may = _may_hold(text)
    for kind, finder in _FINDERS:
        if kind not in may:
            continue
        for m in finder.finditer(text):
            if kind == "name":
                words = _name_words(text, m.start("name"))
                gender = "m" if m["title"] in MALE else "f" if m["title"] in FEMALE else "x"
                for i, (start, end) in enumerate(words):
                    role = "surname" if i == len(words) - 1 else f"given-{gender}"
                    found.append((start, end, role, text[start:end].lower()))
                    if end - start > 1 and known.get(text[start:end].lower()) != "surname":
                        known[text[start:end].lower()] = role
                continue
            start, end = _secret_span(text, m) if kind == "secret" else m.span()
            value = text[start:end]
            if not value:
                continue
            if kind == "card" and not luhn(_ascii_digits(value)):
                continue
            if kind in ("phone", "card", "ssn"):
                value = _ascii_digits(value)
                if kind == "phone" and len(value) == 11 and value[0] == "1":
                    value = value[1:]
            found.append((start, end, kind, value if kind == "secret" and not _HEX.fullmatch(value) else value.lower()))
    if known:
        titled = {e[0] for e in found}
        for m in _WORD.finditer(text):
            end = m.end() - 2 * (m[0][-2:].lower() in ("'s", "’s"))
            value = text[m.start() : end].lower()
            if value in known and m[0][0].isupper() and m.start() not in titled:
                found.append((m.start(), end, known[value], value))
    taken, out = 0, []
    for entity in sorted(found, key=lambda e: (e[0], -e[1])):
        if entity[0] >= taken:
            out.append(entity)
            taken = entity[1]
    return out


def _number(key: bytes, *parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "replace"), key=key, digest_size=16).digest(), "big")


def permuted(value: str, alphabet: str, key: bytes, tweak: str) -> str:
    """A keyed permutation of the strings of this length over the alphabet (alternating Feistel rounds)."""
    base, digits = len(alphabet), [alphabet.index(c) for c in value]
    if len(digits) == 1:
        return alphabet[(digits[0] + _number(key, "one", tweak)) % base]
    half = len(digits) // 2
    left, right = digits[:half], digits[half:]
    for i in range(8):
        mask = _number(key, tweak, i, len(value), *right)
        number = 0
        for d in left:
            number = number * base + d
        number = (number + mask) % base ** len(left)
        moved = []
        for _ in left:
            number, d = divmod(number, base)
            moved.append(d)
        left, right = right, moved[::-1]
    return "".join(alphabet[d] for d in left + right)


def _walk(value: str, step: Callable[[str], str], valid: Callable[[str], bool]) -> str:
    """Applies a permutation until the result is valid: a permutation of the valid strings."""
    value = step(value)
    while not valid(value):
        value = step(value)
    return value


def _class_of(c: str) -> tuple[str, str, bool]:
    return unicodedata.name(c, "").split(" ")[0], unicodedata.category(c), c.lower() == c


@lru_cache(maxsize=4096)
def _relatives(c: str) -> str:
    """The letters or digits of the same script and case within the same 256 code points, without those of the usual alphabets."""
    page, wanted = ord(c) & ~255, _class_of(c)
    return "".join(x for x in map(chr, range(page, page + 256)) if x.isalnum() and _class_of(x) == wanted and x not in LATIN + LATIN.upper() + DIGITS + CYRILLIC + GREEK)


def _drawn_text(canonical: str, key: bytes, tweak: str, attempt: int) -> str:
    """Letters drawn for a text that has none to permute or whose format is exhausted; longer with every attempt."""
    number, made = _number(key, "drawn", tweak, canonical), ""
    for _ in range(8 + attempt):
        number, letter = divmod(number, 26)
        made += LATIN[letter]
        number = number or _number(key, tweak, canonical, made)
    return made


def _letters(text: str, key: bytes, tweak: str) -> str:
    """Permutes the letters of each script and the digits in place; other characters stay."""
    out = list(text)
    usual = {"latin": LATIN, "upper": LATIN.upper(), "digits": DIGITS, "cyrillic": CYRILLIC, "greek": GREEK}
    others = {_relatives(c) for c in text if c.isalnum() and not any(c in a for a in usual.values())}
    for name, alphabet in [*usual.items(), *((a[0], a) for a in sorted(others))]:
        at = [i for i, c in enumerate(text) if c in alphabet]
        if at:
            for i, c in zip(at, permuted("".join(text[i] for i in at), alphabet, key, f"{tweak}{name}"), strict=True):
                out[i] = c
    return "".join(out)


def script_of(word: str) -> str:
    return next((name for name, a in (("cyrillic", CYRILLIC), ("greek", GREEK)) if any(c in a for c in word)), "latin")


def surrogate(kind: str, canonical: str, key: bytes, attempt: int = 0) -> str:
    """Canonical form of the surrogate."""
    tweak = f"{kind}/{attempt}"
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        host, top = domain.rsplit(".", 1)
        made = f"{_letters(local, key, tweak)}@{_letters(host, key, tweak + 'host')}.{top}"
        return made if made != canonical and attempt < 4 else f"{_drawn_text(canonical, key, tweak, attempt)}@{_letters(host, key, tweak + 'host')}.{top}"
    if kind == "secret":
        made = permuted(canonical, HEX, key, tweak) if _HEX.fullmatch(canonical) else _letters(canonical, key, tweak)
        return made if made != canonical and attempt < 4 else _drawn_text(canonical, key, tweak, attempt)
    if kind == "ipv4":
        number = "".join(f"{int(o):02x}" for o in canonical.split("."))
        usable = lambda h: h[:2] not in ("00", "7f", "ff") and h[6:] not in ("00", "ff")
        made = _walk(number, lambda h: permuted(h, HEX, key, tweak), usable)
        return ".".join(str(int(made[i : i + 2], 16)) for i in range(0, 8, 2))
    if kind == "card":
        return _walk(canonical, lambda d: d[0] + permuted(d[1:], DIGITS, key, tweak + d[0]), luhn)
    if kind == "ssn":
        valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        return _walk(canonical, lambda d: permuted(d, DIGITS, key, tweak), valid)
    if kind == "phone":
        return _walk(canonical, lambda d: permuted(d, DIGITS, key, tweak), lambda d: d[0] not in "01" or canonical[0] in "01")
    onsets, vowels, endings = SYLLABLES[script_of(canonical)]
    gender = kind[-1] if kind.startswith("given-") else "x"
    number, made = _number(key, tweak, canonical), ""
    for _ in range(2 + (kind == "surname") + attempt // 2):
        number, onset = divmod(number, len(onsets))
        number, vowel = divmod(number, len(vowels))
        made += onsets[onset] + vowels[vowel]
    return made[: -1 if gender == "f" else None] + endings[gender][number % len(endings[gender])]


def shaped(original: str, made: str, kind: str) -> str:
    """The surrogate in the format of one mention: its separators and the case of its letters."""
    if kind in ("phone", "card", "ssn"):
        digits = [str(unicodedata.decimal(c)) for c in original if c.isdecimal()]
        lead = "".join(digits[: len(digits) - len(made)])
        source = iter(lead + made)
        return "".join(chr(ord(c) - unicodedata.decimal(c) + int(next(source))) if c.isdecimal() else c for c in original)
    if kind in ("email", "secret"):
        return "".join(m.upper() if o.isupper() and len(m.upper()) == 1 else m for o, m in zip(original, made, strict=True)) if len(original) == len(made) else made
    if kind == "ipv4":
        return made
    return made.upper() if len(original) > 1 and original.isupper() else made[:1].upper() + made[1:]


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates, and (start, end, type) of each in it."""
    cached = lru_cache(maxsize=None)(lambda kind, value: surrogate(kind, value, key, attempts.get((kind, value), 0)))
    out, at, size, spans = [], 0, 0, []
    for start, end, kind, value in find_entities(text):
        new = shaped(text[start:end], cached(kind, value), kind)
        out += [text[at:start], new]
        size += start - at
        spans.append((size, size + len(new), kind))
        size, at = size + len(new), end
    return "".join([*out, text[at:]]), spans


def entities(docs: DataFrame) -> DataFrame:
    """Rows (text_hash, kind, canonical) of the entities of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = [(h, kind, value) for h, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if t for kind, value in {e[2:] for e in find_entities(t)}]
                if rows:
                    yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)], names=["text_hash", "kind", "canonical"])

    text = F.col("text").cast("string")
    return docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(run, "text_hash bigint, kind string, canonical string")


def _drawn(rows: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            made = [surrogate(k, v, key, attempt) for k, v in zip(kinds, values, strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(made, pa.string())], names=["kind", "canonical", "surrogate"])

    return rows.mapInArrow(run, "kind string, canonical string, surrogate string")


def settled_attempts(distinct: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogates were taken.

    ``distinct`` has kind and canonical, each pair once.
    """
    group = F.regexp_replace("kind", "^given-.*", "given")
    originals = distinct.select(group.alias("g"), F.col("canonical").alias("s"))
    rows, taken, later, attempt = distinct, None, None, 0
    while True:
        drawn = keep(_drawn(rows, key, attempt).withColumn("g", group), "drawn")
        clear = drawn.join(originals, (drawn["g"] == originals["g"]) & (drawn["surrogate"] == originals["s"]), "left_anti")
        if taken is not None:
            clear = clear.join(taken, (clear["g"] == taken["tg"]) & (clear["surrogate"] == taken["s"]), "left_anti")
        winner = clear.groupBy("g", "surrogate").agg(F.min(F.struct("canonical", "kind")).alias("w"))
        winner = keep(winner.select("w.kind", "w.canonical", F.col("g").alias("tg"), F.col("surrogate").alias("s")), "winner")
        if attempt:
            won = winner.select("kind", "canonical", F.lit(attempt).alias("attempt"))
            later = won if later is None else later.unionByName(won)
        rows = keep(drawn.join(winner, ["kind", "canonical"], "left_anti").select("kind", "canonical"), "again")
        if not rows.take(1):
            return later if later is not None else winner.limit(0).select("kind", "canonical", F.lit(0).alias("attempt"))
        held = winner.select("tg", "s")
        taken, attempt = held if taken is None else taken.unionByName(held), attempt + 1


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row of ``docs``: doc_id, text with surrogates, n_entities, spans (start, end, kind) in the new text."""
    found = keep(entities(docs), "entities")
    distinct = keep(found.groupBy("kind", "canonical").count().select("kind", "canonical"), "distinct")
    later = keep(settled_attempts(distinct, key), "later")
    by_text = found.join(later, ["kind", "canonical"]).distinct().groupBy("text_hash").agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("later"))
    by_text = keep(by_text.withColumnRenamed("text_hash", "hash"), "by_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                made = []
                for text, tries in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    attempts = {(t["kind"], t["canonical"]): t["attempt"] for t in tries or ()}
                    made.append((None, []) if text is None else replaced(text, key, attempts))
                spans = [[{"start": a, "end": b, "kind": k} for a, b, k in s] for _, s in made]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
                yield pa.record_batch([part.column(0), pa.array([t for t, _ in made], pa.string()), pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, kind)], names=["doc_id", "text", "n_entities", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(by_text, F.xxhash64(rows["text"]) == by_text["hash"], "left").select("doc_id", "text", "later")
    return joined.mapInArrow(run, "doc_id bigint, text string, n_entities int, spans array<struct<start:int,end:int,kind:string>>")
