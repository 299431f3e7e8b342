"""Personal data with offset-preserving deobfuscation.

Plain patterns find e-mail addresses, IP addresses, cards and phones in the text as it stands. Then three small transducers rewrite
it, each output character keeping the source span it came from: homoglyphs (full-width and look-alike letters, any script's digits,
odd spaces and dashes, zero-width characters, O and l between digits), spelled digits ("plus one five five"), and at/dot disguises ("name [at] host
dot com"). The same patterns run over the rewritten text and their spans are mapped back. Plain spans always stay; a found span is added unless
it lies within a plain span of its kind. An unbracketed "at" counts only if a dot of the host is disguised as well, because
"at" is an ordinary word.

Every detector is linear in the length of the text. Edge cases: null and empty texts have no spans; a null ``doc_id`` stays null;
repeated rows give repeated results; other columns are ignored by the finder and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import documents, pieces

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Look-alike characters and what they stand for.
LOOK_ALIKES = dict(
    zip(
        "авеѕіјкмнорстухһԁԛѡАВЕЅІЈКМНОРСТУХ" + "αβεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" + "ıɑɡ。․·∙•З" + "‐‑‒–—−" + "⁠​‌‍﻿­",
        list("abesijkmhopctyxhdqwABESIJKMHOPCTYX") + list("abeiknoptuxABEZHIKMNOPTYX") + list("iag.....3") + list("------") + [""] * 6,
        strict=True,
    )
)
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_ONE = re.compile(rf"(?i)plus[\s-]+|\+\s*|{'|'.join(DIGIT_WORDS)}")
_GAP = re.compile(r"[\s,-]{1,2}")


class Sign:
    """A disguised sign: a word for it in brackets, with up to three spaces on either side; bare between one to three spaces; between
    underscores or hyphens inside a word. Matches are found from these cores outwards."""

    def __init__(self, bare: str, bracketed: str):
        self.bracketed = re.compile(rf"[\[({{<]\s{{0,3}}(?i:{bracketed})\s{{0,3}}[\])}}>]")
        self.spaced = re.compile(rf"\s(?i:{bare})(?=\s)")
        self.joined = re.compile(rf"[_-](?<=\w[_-])(?i:{bare})[_-](?=\w)")

    def spans(self, text: str) -> list[tuple[int, int]]:
        cores = [(m.start(), m.end(), 3) for m in self.bracketed.finditer(text)]
        cores += [(m.start() + 1, m.end(), 0) for m in self.spaced.finditer(text)]
        cores += [(m.start(), m.end(), -1) for m in self.joined.finditer(text)]
        out, free = [], 0
        for start, end, spaces in sorted(cores):
            if start < free:
                continue
            a, b = start, end
            if spaces > 0:
                while a > free and start - a < 3 and text[a - 1].isspace():
                    a -= 1
                while b < len(text) and b - end < 3 and text[b].isspace():
                    b += 1
            elif not spaces:
                while a > free and start - a < 4 and text[a - 1].isspace():
                    a -= 1
                while b < len(text) and b - end < 4 and text[b].isspace():
                    b += 1
                if not (1 <= start - a <= 3 and 1 <= b - end <= 3) or not a or text[a - 1].isspace() or b == len(text):
                    continue
            out.append((a, b))
            free = b
        return out


_AT = Sign("at", "at|@|arroba")
_DOT = Sign("dot", r"dot|\.|punto|punkt|point")


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def digit_runs(text: str) -> list[tuple[int, int]]:
    """Runs of spelled digits, one or two spaces, commas or hyphens apart, with a plus sign or word before them."""
    low = text.lower().replace("ſ", "s")
    if len(low) != len(text):  # a letter whose small form is two characters
        low = "".join(c if len(s := c.lower()) != 1 else s for c in text).replace("ſ", "s")
    words = []
    for word in DIGIT_WORDS:
        at = low.find(word)
        while at >= 0:
            stop = at + len(word)
            if not (at and _in_word(text[at - 1])) and not (stop < len(text) and _in_word(text[stop])):
                words.append((at, stop))
            at = low.find(word, stop)
    out: list[tuple[int, int]] = []
    for at, stop in sorted(words):
        if out and at - out[-1][1] <= 2 and _GAP.fullmatch(text, out[-1][1], at):
            out[-1] = out[-1][0], stop
            continue
        free = out[-1][1] if out else 0
        a = at
        while a > free and (text[a - 1].isspace() or text[a - 1] == "-"):
            a -= 1
        if a < at and a - 4 >= free and low[a - 4 : a] == "plus" and not (a > 4 and _in_word(text[a - 5])):
            out.append((a - 4, stop))
            continue
        a = at
        while a > free and text[a - 1].isspace():
            a -= 1
        out.append((a - 1 if a > free and text[a - 1] == "+" else at, stop))
    return out


_DIGITS = re.compile("[0-9]+")
_ASCII_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def leet_runs(text: str) -> list[tuple[int, int]]:
    """Runs of O, o, I and l that stand before or after a digit, with no letter on their other side."""
    out: list[tuple[int, int]] = []
    for digits in _DIGITS.finditer(text):
        b = a = digits.start()
        while a and text[a - 1] in "OoIl":
            a -= 1
        if a < b and not (a and text[a - 1] in _ASCII_LETTERS) and not (out and out[-1][0] == a):
            out.append((a, b))
        b = a = digits.end()
        while b < len(text) and text[b] in "OoIl":
            b += 1
        if a < b and not (b < len(text) and text[b] in _ASCII_LETTERS):
            out.append((a, b))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and dotted host, found from each @ outwards."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            free = host.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    out = []
    for chain in _CHAIN.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts = [(m.start(), m.end()) for m in re.compile("[0-9]+").finditer(text, chain.start(), chain.end())]
        for k in range(0, len(parts) - 3, 4):
            if all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or 0) <= 255 for a, b in parts[k : k + 4]):
                out.append((parts[k][0], parts[k + 3][1]))
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CARD.finditer(text) if 14 <= len(d := _digits(m.group())) <= 19 and _luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]


_HAS_DIGIT = re.compile("[0-9]")


def detect(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        found += [("ip", a, b) for a, b in ips(text)] + [("card", a, b) for a, b in cards(text)]
        if "+" in text:
            found += [("phone", a, b) for a, b in phones(text)]
    return found


class Tape:
    """A rewritten text: each character with the source span it stands for, and the disguises that made it."""

    def __init__(self, text: str):
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)
        self.marks: dict[int, str] = {}  # source start of a rewritten character -> what it was
        self.changed = False

    def rewrite(self, edits: list[tuple[int, int, list[tuple[int, int, str]], str]]) -> None:
        """Replace spans (start, end) by characters (start, end, char), all in positions of the current text."""
        if not edits:
            return
        text, starts, ends, out, at = [], [], [], [], 0
        for a, b, chars, mark in edits:
            text.append(self.text[at:a])
            starts.extend(self.start[at:a])
            ends.extend(self.end[at:a])
            for x, y, c in chars:
                text.append(c)
                starts.append(self.start[x])
                ends.append(self.end[y - 1])
                if mark:
                    self.marks[self.start[x]] = mark
            at = b
        text.append(self.text[at:])
        starts.extend(self.start[at:])
        ends.extend(self.end[at:])
        self.text, self.start, self.end, self.changed = "".join(text), starts, ends, True


def _folded(c: str) -> str | None:
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.decimal(c))
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain.isascii() else None


def fold_glyphs(tape: Tape, folds: dict[str, str | None]) -> None:
    if tape.text.isascii():
        return
    for c in set(tape.text):
        if c > "\x7f" and c not in folds:
            folds[c] = _folded(c)
    wanted = [c for c in set(tape.text) if c > "\x7f" and folds[c] is not None]
    if wanted:
        each = re.compile("[" + "".join(map(re.escape, wanted)) + "]").finditer(tape.text)
        tape.rewrite([(m.start(), m.end(), [(m.start(), m.end(), c)] if (c := folds[m.group()]) else [], "") for m in each])


def fold_digits(tape: Tape) -> None:
    edits = []
    for a, b in digit_runs(tape.text):
        chars = [
            (m.start(), m.end(), DIGIT_WORDS.get(m.group().lower().replace("ſ", "s"), "+")) for m in _ONE.finditer(tape.text, a, b)
        ]
        edits.append((a, b, chars, ""))
    tape.rewrite(edits)


def fold_leet(tape: Tape) -> None:
    one = lambda k: (k, k + 1, "0" if tape.text[k] in "Oo" else "1")
    tape.rewrite([(a, b, [one(k) for k in range(a, b)], "") for a, b in leet_runs(tape.text)])


def fold_signs(tape: Tape, sign: Sign, char: str) -> None:
    edits = []
    for a, b in sign.spans(tape.text):
        mark = "masked" if re.search(r"[\[({<_-]", tape.text[a:b]) or char == "." else "word"
        edits.append((a, b, [(a, b, char)], mark))
    tape.rewrite(edits)


def disguised(text: str, folds: dict[str, str | None]) -> list[tuple[str, int, int]]:
    """Spans, in source positions, that the detectors find once the text is rewritten."""
    tape = Tape(text)
    fold_glyphs(tape, folds)
    fold_digits(tape)
    if _HAS_DIGIT.search(tape.text):
        fold_leet(tape)
    fold_signs(tape, _DOT, ".")
    fold_signs(tape, _AT, "@")
    if not tape.changed:
        return []
    out = []
    for kind, a, b in detect(tape.text):
        if kind == "email":
            at = tape.text.index("@", a)
            if tape.marks.get(tape.start[at]) == "word" and not any(
                tape.text[k] == "." and tape.start[k] in tape.marks for k in range(at, b)
            ):
                continue
        out.append((kind, tape.start[a], tape.end[b - 1]))
    return out


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(text: str, folds: dict[str, str | None]) -> tuple[list, list]:
    """Plain spans, and all spans, each (kind, start, end) in code points, ordered by start and kind."""
    plain = detect(text)
    more = []
    for kind, a, b in disguised(text, folds):
        if not any(k == kind and x <= a and b <= y for k, x, y in plain):
            more.append((kind, a, b))
    plain = _ordered(plain)
    return plain, _ordered(plain + more) if more else plain


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, counts per kind over all spans, ``base_sha256`` of the plain spans, and ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds: dict[str, str | None] = {}
        for batch in batches:
            for part in pieces(batch, limit=8 << 20):
                counts: list[list[int]] = [[] for _ in KINDS]
                digests, spans = [], []
                for text in part.column("text").to_pylist():
                    plain, all_spans = find(text or "", folds)
                    for kind, column in zip(KINDS, counts, strict=True):
                        column.append(sum(s[0] == kind for s in all_spans))
                    digests.append(hashlib.sha256(_joined(plain).encode()).hexdigest())
                    spans.append(_joined(all_spans))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(spans)],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    )


def masked(text: str, folds: dict[str, str | None]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in find(text, folds)[1]:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span masked in ``text`` and ``n_chars`` counted anew; null texts stay null."""
    schema = docs.schema
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds: dict[str, str | None] = {}
        for batch in batches:
            for part in pieces(batch, limit=8 << 20):
                old = part.column("text").to_pylist()
                new = [t if t is None else masked(t, folds) for t in old]
                columns = {n: part.column(n) for n in names}
                columns["text"] = pa.array(new, part.schema.field("text").type)
                if "n_chars" in columns:
                    known = part.column("n_chars").to_pylist()
                    columns["n_chars"] = pa.array(
                        [k if n is o or n == o else len(n) for k, n, o in zip(known, new, old, strict=True)],
                        part.schema.field("n_chars").type,
                    )
                yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(run, schema)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Contract query: counts, digest of plain spans and all spans for every document."""
    return find_pii(documents(spark, sf_dir))
