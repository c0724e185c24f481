"""Personal data: fixed patterns on the text, then on offset-preserving normal forms of it.

The normal forms undo disguises: a transducer reads the text once, writes
plain characters for homoglyphs, digits for spelled digits and ``@`` or ``.``
for "[at]" or "(dot)", and keeps for every character written the stretch of
source characters it stands for. Identifiers found in a normal form are
mapped back, so every span is a span of the source. One form undoes disguised
addresses and long runs of spelled digits, the others all numbers in which
digits, spelled digits and signs for dots stand together; what is a number of
which kind is left to the patterns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import small_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, place in KINDS

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, read outwards from each @ so that time stays linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping by kind, by start and kind."""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text) if _DOTTED.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), 1))
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(digits := "".join(DIGITS.findall(m[0]))) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                found.append((*m.span(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


# Letters of other scripts that look like a Latin letter, full-width forms come from their code points.
HOMOGLYPHS = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "ｏ": "o", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
HIDDEN = "­​‌‍⁠﻿"
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
WIDE = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
OTHER_DIGITS = {chr(zero + d): str(d) for zero in (0x0660, 0x06F0, 0x0966, 0x09E6, *range(0x1D7CE, 0x1D800, 10)) for d in range(10)}
PLAIN = str.maketrans(HOMOGLYPHS | WIDE | OTHER_DIGITS)

_ODD = re.compile("[" + re.escape("".join([*HOMOGLYPHS, *WIDE, *OTHER_DIGITS, *HIDDEN])) + "]")
_FOLD = {c: chr(t) if isinstance(t, int) else t for c, t in ((chr(k), v) for k, v in PLAIN.items())} | dict.fromkeys(HIDDEN, "")


def _trie(words: list[str]) -> str:
    """The words as one expression that branches on one letter at a time."""
    if words == [""]:
        return ""
    heads = sorted({w[:1] for w in words}, reverse=True)
    parts = [h + _trie(sorted(w[1:] for w in words if w[:1] == h)) if h else "" for h in heads]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


_NUMBER = _trie(sorted(SPELLED))
#: At least five spelled digits in a row: fewer are ordinary prose.
_SPELLED = re.compile(rf"{_NUMBER}(?:[\s,.-]{{1,3}}{_NUMBER}(?![^\W_])){{4,}}+")
_ONE = re.compile(rf"{_NUMBER}(?![^\W_])")
_PART = r"[A-Za-z0-9][A-Za-z0-9_%+-]{0,63}"
_AT_WORD, _DOT_WORD, _OPEN, _SHUT = "at|arroba", "dot|punkt|point|punto", r"[\[({<]\s{0,3}", r"\s{0,3}[\])}>]"
_AT = rf"(?:\s{{0,3}}{_OPEN}(?:{_AT_WORD}|@){_SHUT}\s{{0,3}}|\s{{1,3}}(?:{_AT_WORD})\s{{1,3}}|\s{{0,3}}@\s{{0,3}})"
#: A disguised dot, and any dot.
_DOT_SIGN = rf"\s{{0,3}}{_OPEN}(?:{_DOT_WORD}|\.){_SHUT}\s{{0,3}}|\s{{1,3}}(?:{_DOT_WORD})\s{{1,3}}"
_DOT = rf"(?:{_DOT_SIGN}|\.)"
_HOST = r"[A-Za-z0-9][A-Za-z0-9-]{0,62}"
#: A disguised address: a name, a sign for @ and a host with at least one sign for a dot and a last part of letters.
DISGUISED = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-]){_PART}(?:{_DOT}{_PART}){{0,4}}?{_AT}{_HOST}(?:{_DOT}{_HOST}){{0,5}}{_DOT}[A-Za-z]{{2,24}}(?![A-Za-z0-9_-])")
#: What each match of it that ``_undisguise`` accepts holds: a sign in brackets, a word for a dot, or white space beside an @.
_HINT = re.compile(rf"(?i){_OPEN}(?:{_AT_WORD}|{_DOT_WORD}|[@.]){_SHUT}|\s(?:{_DOT_WORD})\s|\s@|@\s")
_SIGN = re.compile(rf"(?i)(?P<at>{_AT})|(?P<dot>{_DOT})")

_GLUE = r"[\s,.()-]{1,3}"
#: Digits and spelled digits, at least two of them with signs for dots or little else in between.
_CHAIN = re.compile(rf"(?<![0-9])(?:(?<![^\W_]){_NUMBER}(?![^\W_])|[0-9]++)(?:(?:{_DOT_SIGN}|{_GLUE})(?:{_NUMBER}(?![^\W_])|[0-9]++))++")
_LINK = re.compile(rf"(?P<figure>[0-9]++)|(?P<word>{_NUMBER}(?![^\W_]))|(?P<dot>{_DOT_SIGN})|(?P<glue>{_GLUE})")


def fold(text: str) -> tuple[str, list[int] | None]:
    """Homoglyphs and odd digits as plain characters, hidden ones dropped; the source position of each character, None if all are their own."""
    if text.isascii() or not _ODD.search(text):
        return text, None
    out, place = [], []
    for i, c in enumerate(text):
        plain = _FOLD.get(c, c)
        if plain:
            out.append(plain)
            place.append(i)
    return "".join(out), place


class Normal:
    """A text under rewriting, each character with the stretch of the source it stands for."""

    def __init__(self, text: str, place: list[int] | None):
        self.text = text
        self.start = place if place is not None else range(len(text))
        self.end = [p + 1 for p in place] if place is not None else range(1, len(text) + 1)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> Normal:
        """Replace stretches, given in order; every character of a replacement stands for the whole stretch."""
        out, starts, ends, last = [], [], [], 0
        for a, b, new in changes:
            out += [self.text[last:a], new]
            starts += [*self.start[last:a], *[self.start[a]] * len(new)]
            ends += [*self.end[last:a], *[self.end[b - 1]] * len(new)]
            last = b
        out.append(self.text[last:])
        fresh = Normal("".join(out), [])
        fresh.start, fresh.end = [*starts, *self.start[last:]], [*ends, *self.end[last:]]
        return fresh


def _undisguise(found: re.Match) -> list[tuple[int, int, str]]:
    """The signs of a disguised address: one for @, and a disguised dot if that one is the bare word."""
    signs = [(*m.span(), "@" if m.lastgroup == "at" else ".") for m in _SIGN.finditer(found.string, *found.span())]
    ats = [found.string[a:b] for a, b, new in signs if new == "@"]
    plain_dots = all(found.string[a:b] == "." for a, b, new in signs if new == ".")
    return [] if len(ats) != 1 or (plain_dots and ats[0].strip().isalpha()) else signs


def lowered(plain: str) -> str:
    """The text in lower case, character by character."""
    lower = plain.lower()
    return lower if len(lower) == len(plain) else plain.translate({c: c + 32 for c in range(65, 91)})


def normalise(text: str) -> Normal | None:
    """The first normal form, or None where the text has no such disguise."""
    plain, place = fold(text)
    lower = lowered(plain)
    now = Normal(plain, place) if place is not None else None
    changes = []
    for run in _SPELLED.finditer(lower):
        if run.start() == 0 or not lower[run.start() - 1].isalnum():
            words = _ONE.finditer(lower, *run.span())
            changes.append((run.start(), run.end(), "".join(SPELLED[w[0]] for w in words)))
    if changes:
        now = (now or Normal(plain, None)).rewrite(changes)
        plain = now.text
    signs = []
    if _HINT.search(plain):
        for found in DISGUISED.finditer(plain):
            signs += _undisguise(found)
    if signs:
        now = (now or Normal(plain, None)).rewrite(signs)
    return now


def numbers(plain: str, lower: str, place: list[int] | None) -> list[Normal]:
    """Normal forms in which spelled digits and signs for dots in numbers are undone.

    What stands between two spelled digits goes; dots without white space stay
    in the first form and go in the second, which is there if they differ.
    """
    kept, dropped = [], []
    for chain in _CHAIN.finditer(lower):
        parts = list(_LINK.finditer(lower, *chain.span()))
        for k, part in enumerate(parts):
            at = part.span()
            if part.lastgroup == "word":
                kept.append((*at, SPELLED[part[0]]))
                dropped.append(kept[-1])
            elif part.lastgroup == "dot":
                kept.append((*at, "."))
                dropped.append(kept[-1])
            elif part.lastgroup == "glue" and parts[k - 1].lastgroup == parts[k + 1].lastgroup == "word":
                dropped.append((*at, ""))
                if part[0] != ".":
                    kept.append(dropped[-1])
    return [Normal(plain, place).rewrite(c) for c in ([kept] if kept == dropped else [kept, dropped]) if c]


def forms(text: str) -> list[tuple[Normal, tuple[int, ...]]]:
    """The normal forms of a text and the places in KINDS of what is looked for in each."""
    first = normalise(text)
    plain, place = fold(text)
    return [*([(first, (0, 1, 2, 3))] if first else []), *((form, (1, 2, 3)) for form in numbers(plain, lowered(plain), place))]


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """``(base, all)``: spans of the fixed patterns, and these with what only the normal forms show.

    A span of a normal form counts if it covers a disguise, that is if its
    source is not the plain text itself, and if it overlaps no span of its kind
    that is plain or found in a form before.
    """
    if not text:
        return [], []
    base = base_spans(text)
    extra = []
    taken = [sorted((a, b) for a, b, k in base if k == kind) for kind in range(len(KINDS))]
    for form, kinds in forms(text):
        for a, b, kind in base_spans(form.text):
            start, end = form.start[a], form.end[b - 1]
            if kind in kinds and text[start:end] != form.text[a:b] and not any(start < y and x < end for x, y in taken[kind]):
                taken[kind].append((start, end))
                extra.append((start, end, kind))
    return base, sorted(base + extra, key=lambda s: (s[0], s[2]))


def written(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in found)


def masked(text: str | None) -> str | None:
    """The text with every stretch of spans replaced by the kind of its first span."""
    if not text:
        return text
    out, last, found = [], 0, spans(text)[1]
    for a, b, kind in found:
        if a >= last:
            out += [text[last:a], f"<{KINDS[kind].upper()}>"]
        last = max(last, b)
    return "".join([*out, text[last:]]) if found else text


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def findings(text: Column) -> Column:
    """Counts and digest of the base spans, and all spans written out. A null text has none."""

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            base, every = spans(t)
            counts = [sum(k == kind for *_, k in base) for kind in range(len(KINDS))]
            rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])

    return find(text)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` counted anew; null texts stay null."""
    small_batches(docs.sparkSession)
    mask = F.pandas_udf(lambda texts: texts.map(masked, na_action="ignore").astype(object), "string")
    out = docs.withColumn("text", mask(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(spark, sf: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select("doc_id", findings(F.col("text")).alias("f")).select("doc_id", "f.*")
