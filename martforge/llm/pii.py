"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found in the text as it is.  Disguised ones are found in
a normalised copy: small transducers rewrite homoglyphs, spelled digits and
at / dot disguises, each rewrite remembers the source characters it stands
for, and spans of the copy are mapped back to source code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import chunks

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """As the contract's pattern matches: a match's local part is the run of
    its letters before an ``@``, not reaching into the match before."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain identifiers, sorted."""
    out = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# Look-alikes (Cyrillic, Greek, and signs) of the characters identifiers are made of.
LOOK_ALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ѕ": "s",
    "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J",
    "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "α": "a", "ε": "e", "ι": "i", "ν": "v",
    "ο": "o", "ρ": "p", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g",
    "﹫": "@", "。": ".", "․": ".", "‐": "-", "‑": "-", " ": " ", " ": " ",
    "​": "", "‌": "", "‍": "", "⁠": "", "­": "", "﻿": "",
}
# Digits of other scripts and full-width letters follow from their code points.
LOOK_ALIKES |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
LOOK_ALIKES |= {chr(z + d): str(d) for z in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
# Digit names in the corpus' languages.
DIGIT_NAMES = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_NAME = "(?:" + "|".join(sorted(DIGIT_NAMES, key=len, reverse=True)) + ")"
_ODD = re.compile("[" + "".join(map(re.escape, LOOK_ALIKES)) + "]")
_DOT = "(?:dot|punkt|punto|point)"
#: Digit names side by side (with digits among them), or a single one next to a dot.
_SPELLED = re.compile(rf"\b{_NAME}\b(?:(?:[ ,-]{{0,2}}\b(?:{_NAME}|[0-9]+)\b)+|(?=[ ]{_DOT}\b|[ ]?[\[(]|\.[0-9A-Za-z]))"
                      rf"|(?:(?<=\bdot )|(?<=\bpunkt )|(?<=\bpunto )|(?<=\bpoint )|(?<=[0-9]\.)|(?<=[\])])|(?<=[\])] )){_NAME}\b", re.I)
_TOKEN = re.compile(rf"{_NAME}|[0-9]+", re.I)
_BRACKET = re.compile(r"[ ]?[\[({<][ ]?(at|dot|plus|@|\.)[ ]?[\])}>][ ]?", re.I)
_SPACED = re.compile(rf"(?<=[A-Za-z0-9])(?:[ ]+(at|{_DOT})[ ]+|[ ]*(@)[ ]+|[ ]+(@)[ ]*|[ ]+(\.)[ ]+)(?=[A-Za-z0-9])", re.I)
_PLUS = re.compile(r"\bplus[ ]+(?=[0-9])", re.I)
_HINT = re.compile(rf"[\[({{<][ ]?(?:at|dot|plus|@|\.)[ ]?[\])}}>]|[ ](?:at|{_DOT})[ ]|@[ ]|[ ]@|[ ]\.[ ]|plus[ ]", re.I)
_SIGNS = {"at": "@", "@": "@", "plus": "+"}


class Tape:
    """A text made from a source text, with the source span of each stretch.

    ``cuts`` are the stretches (start in the copy, start and end in the
    source, whether it was rewritten); a copied stretch maps letter by
    letter, a rewritten one as a whole.
    """

    def __init__(self, text: str, cuts: list[tuple[int, int, int, bool]] | None = None):
        self.text, self.cuts = text, cuts or [(0, 0, len(text), False)]
        self.starts = [c[0] for c in self.cuts]

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of [start, end) and whether a rewrite lies in it."""
        a, b = bisect_right(self.starts, start) - 1, bisect_left(self.starts, end) - 1
        at, s, _, new = self.cuts[a]
        first = s if new else s + start - at
        at, s, e, new_b = self.cuts[b]
        last = e if new_b else s + end - at
        return first, last, last - first != end - start or any(c[3] for c in self.cuts[a:b + 1])

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """The tape after ``edits`` (start, end, replacement), in order and
        apart from each other; stretches keep pointing at the first source."""
        if not edits:
            return self
        out, cuts, size, at = [], [], 0, 0

        def copy(start: int, end: int) -> None:
            nonlocal size
            k = bisect_right(self.starts, start) - 1
            while start < end:
                here, s, e, new = self.cuts[k]
                stop = min(end, self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text))
                if stop > start:
                    cuts.append((size, s, e, True) if new else (size, s + start - here, s + stop - here, False))
                    out.append(self.text[start:stop])
                    size += stop - start
                    start = stop
                k += 1

        for start, end, new in edits:
            copy(at, start)
            first, last, _ = self.source(start, end)
            if new:
                cuts.append((size, first, last, True))
                out.append(new)
                size += len(new)
            at = end
        copy(at, len(self.text))
        return Tape("".join(out), cuts or None)


def _digits(match: re.Match) -> str:
    return "".join(DIGIT_NAMES.get(t.lower(), t) for t in _TOKEN.findall(match[0]))


def normalise(text: str) -> Tape | None:
    """The text without disguises, or None if it holds none."""
    tape = Tape(text)
    tape = tape.rewrite([(m.start(), m.end(), LOOK_ALIKES[m[0]]) for m in _ODD.finditer(text)])
    tape = tape.rewrite([(m.start(), m.end(), _digits(m)) for m in _SPELLED.finditer(tape.text)])
    if _HINT.search(tape.text):
        tape = tape.rewrite([(m.start(), m.end(), _SIGNS.get(m[1].lower(), ".")) for m in _BRACKET.finditer(tape.text)])
        tape = tape.rewrite([(m.start(), m.end(), _SIGNS.get((m[1] or m[2] or m[3] or m[4]).lower(), "."))
                             for m in _SPACED.finditer(tape.text) if not (m[1] or "").lower() == "at" or _at_word(tape.text, m.end())])
        tape = tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])
    return tape if tape.text != text else None


_HOST = re.compile(r"[A-Za-z0-9-]+(?:[ ]+(?:dot|punkt|punto|point)[ ]+|[ ]*\.[ ]*)[A-Za-z]{2,}", re.I)


def _at_word(text: str, end: int) -> bool:
    """A spaced ``at`` is a sign only before something like a host name."""
    return _HOST.match(text, end) is not None


def hidden(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of disguised identifiers that lie in no plain one of their kind."""
    tape = normalise(text)
    if tape is None:
        return []
    out = []
    for s, k, e in find(tape.text):
        first, last, rewritten = tape.source(s, e)
        if rewritten:
            out.append((first, k, last))
    taken = {k: [(s, e) for s, b, e in base if b == k] for k in range(len(KINDS))}
    return [x for x in out if not any(s <= x[0] and x[2] <= e for s, e in taken[x[1]])]


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(plain spans, all spans) of a text, each (start, kind, end), sorted."""
    base = find(text)
    return base, sorted(base + hidden(text, base))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text: one row per row of ``docs``.

    Columns: ``id_col``; n_email, n_ip, n_card, n_phone (plain spans per
    kind); base_sha256 (digest of the plain spans); spans (all spans, the
    disguised ones included, as ``kind:start:end``); n_hidden (the added
    ones).  Offsets count code points of the source text, ends are exclusive.
    A null text counts as empty, an empty text has no spans; null ids and
    repeated rows are kept; other columns are not read.  Map-only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for s, e in chunks(texts):
                found = [scan(t) for t in texts[s:e]]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(s, e - s)]
                    + [pa.array([sum(x[1] == k for x in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                    + [pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]),
                       pa.array([written(every) for _, every in found]),
                       pa.array([len(every) - len(base) for base, every in found], pa.int64())],
                    [id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_hidden"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
              + ", base_sha256 string, spans string, n_hidden long")
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)
