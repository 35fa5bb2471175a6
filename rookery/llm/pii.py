"""Personal data in texts, disguised forms included, with offsets into the source.

Plain forms (e-mail, IP, card and phone numbers) are found on the text itself. Where a
text shows signs of disguise, a transducer rewrites it left to right: look-alike letters
and digits of other scripts, zero-width characters, spelled digits, and spelled or
bracketed "at", "dot" and "plus". Each rewritten piece keeps the source range that it came
from. The same detectors read the rewritten text, and their spans map back to the
source; one is added where no plain span is in its way. Offsets count code points, end
exclusive.

Defined results: a null text is an empty text without spans; rows that repeat a doc_id give
a row each; an empty table gives an empty result; further columns are ignored.
"""

import hashlib
import re
import string
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
# a number of a longer one is no start: its first digit has failed already
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_PLAIN_WORDS = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Every match holds one at sign, so each sign is tried once, with the run of local characters before it."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield "email", start, end
        at = text.find("@", at + 1)


def plain_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; matches that fail a test are dropped."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _PLAIN_WORDS.sub("", m[0]) if m.end() - m.start() <= 37 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return found


# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K",
    "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a",
    "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "․": ".", "。": ".", "．": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "—": "-", "−": "-", " ": " ", " ": " ", " ": " ", " ": " ", "﹫": "@", "₊": "+",
}
# Spelled digits in the corpus' languages.
NUMBERS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2",
    "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1",
    "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
HIDDEN = "​‌‍⁠﻿­"
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "info", "example", "de", "fr", "es", "uk", "co")

_number = "|".join(sorted(NUMBERS, key=len, reverse=True))
_run = rf"(?<!\w)(?:{_number}|[0-9])(?:[\s,-]{{1,2}}(?:(?:double|triple)[\s-])?(?:{_number}|[0-9]))*(?!\w)"
_wide = "！-～٠-٩۰-۹०-९\U0001d7ce-\U0001d7ff²³¹⁰⁴-⁹₀-₉"
_alike = "".join(map(re.escape, LOOKALIKES))
_STRANGE = re.compile(rf"[{_alike}{HIDDEN}{_wide}]")
_AT = r"(?:\s*[(\[{<]\s*(?:at|@|arroba|chez)\s*[)\]}>]\s*)"
_DOT = r"(?:\s*[(\[{<]\s*(?:dot|\.|punkt|point|punto)\s*[)\]}>]\s*)"
_SPELLED_AT = r"(?:\s+(?:at|AT|At|arroba)\s+)"
_SPELLED_DOT = r"(?:\s+(?:dot|DOT|Dot|punkt|punto)\s+)"
_label = r"[A-Za-z0-9-]+"
_any_dot = rf"(?:{_DOT}|{_SPELLED_DOT}|\.)"
_local = rf"[A-Za-z0-9_%+-]+(?:{_any_dot}[A-Za-z0-9_%+-]+)*?"
# a spelled at needs a spelled dot or a known ending; a bracketed one or @ takes any dot
_MAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?P<local>{_local})(?:(?:{_AT}|@){_label}(?:{_any_dot}{_label})+"
    rf"|{_SPELLED_AT}{_label}(?:\.{_label})*(?:(?:{_DOT}|{_SPELLED_DOT}){_label}(?:\.{_label})*)+(?!\w)"
    rf"|{_SPELLED_AT}{_label}(?:\.{_label})*\.(?:{'|'.join(ENDINGS)})(?![\w-]))"
)
_NUMBER_RUN = re.compile(_run, re.IGNORECASE)
_SIGN = re.compile(r"(?<!\w)(?:plus)[\s-]+(?=[0-9])|[(\[]\s*(?:plus|\+)\s*[)\]]\s*(?=[0-9])", re.IGNORECASE)
_NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT}|{_SPELLED_DOT})(?=[0-9])")
_PIECE = re.compile(r"[^\W\d_]+|[0-9]", re.UNICODE)
_SEVERAL = re.compile(rf"(?:(?<!\w)(?:{_number})[\s,-]{{1,2}}){{3}}", re.IGNORECASE)


_SPELLED = frozenset(NUMBERS)


class Aligned:
    """A rewritten text and where its pieces come from."""

    def __init__(self, text: str):
        self.text = text
        self._starts, self._pieces = [0], [(0, len(text), True)]

    def source(self, at: int, end: bool = False) -> int:
        """The source offset of a position; for an end, of the end of the piece before it."""
        i = bisect_right(self._starts, at - 1 if end else at) - 1
        start, stop, same = self._pieces[i]
        if same:
            return start + at - self._starts[i]
        return stop if end else start

    def rewrite(self, changes: list[tuple[int, int, str]]) -> "Aligned":
        """Replace ranges (in order, without overlap) of the text."""
        out, starts, pieces, at, size = [], [], [], 0, 0

        def copied(a: int, b: int):
            nonlocal size
            if a == b:
                return
            first = bisect_right(self._starts, a) - 1
            for i in range(first, len(self._starts)):
                lo = max(a, self._starts[i])
                hi = min(b, self._starts[i + 1] if i + 1 < len(self._starts) else len(self.text))
                if lo >= b:
                    break
                start, stop, same = self._pieces[i]
                starts.append(size)
                pieces.append((start + lo - self._starts[i], 0, True) if same else (start, stop, False))
                size += hi - lo
            out.append(self.text[a:b])

        for a, b, new in changes:
            copied(at, a)
            if new:
                starts.append(size)
                pieces.append((self.source(a), self.source(b, end=True), False))
                size += len(new)
                out.append(new)
            at = b
        copied(at, len(self.text))
        made = Aligned("".join(out))
        if pieces:
            made._starts, made._pieces = starts, pieces
        return made


def _digits(run: str) -> str:
    out, times = [], 1
    for piece in _PIECE.findall(run):
        low = piece.lower()
        if low in ("double", "triple"):
            times = 2 if low == "double" else 3
            continue
        out.append((NUMBERS.get(low, piece)) * times)
        times = 1
    return "".join(out)


def _straight(c: str) -> str:
    if c in HIDDEN:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    return str(unicodedata.digit(c, "")) or c


def rewritten(text: str) -> Aligned | None:
    """The text without disguises, or None when it shows none."""
    made = Aligned(text)
    if not text.isascii():
        strange = [(m.start(), m.end(), _straight(m[0])) for m in _STRANGE.finditer(text)]
        made = made.rewrite(strange) if strange else made
    changed = made.text != text
    low = made.text.lower()
    if not _SPELLED.isdisjoint(low.replace("-", " ").replace(",", " ").split()) and _SEVERAL.search(made.text):
        runs = [(m.start(), m.end(), _digits(m[0])) for m in _NUMBER_RUN.finditer(made.text)]
        made = made.rewrite([r for r in runs if not made.text[r[0] : r[1]].replace(" ", "").replace("-", "").isdigit()])
        changed, low = True, made.text.lower()
    if "plus" in low or "(+)" in low:
        signs = [(m.start(), m.end(), "+") for m in _SIGN.finditer(made.text)]
        changed, made = changed or bool(signs), made.rewrite(signs)
    spelled_dot = any(w in low for w in ("dot", "punkt", "punto", "point", "(.)", "[.]", "{.}"))
    if spelled_dot:
        dots = [(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(made.text)]
        changed, made = changed or bool(dots), made.rewrite(dots)
    if "@" in low or "at" in low or "arroba" in low or "chez" in low:
        marks = spelled_dot or any(f".{e}" in low for e in ENDINGS) or any(b in low for b in ("(at", "[at", "{at", "<at", "( at", "[ at"))
        if marks:
            changes = []
            for a, b in _mail_windows(made.text):
                for m in _MAIL.finditer(made.text, a, b):
                    body = m[0]
                    if "@" in body and not re.search(rf"{_DOT}|{_SPELLED_DOT}|{_AT}", body):
                        continue
                    changes += _by_marks(m.start(), body)
            made, changed = made.rewrite(_in_order(changes)), changed or bool(changes)
    return made if changed else None


_MARK = re.compile(rf"(?P<at>{_AT}|{_SPELLED_AT})|(?P<dot>{_DOT}|{_SPELLED_DOT})")
# white space after a sign may also stand before the next one, so it is left
_NEAR_AT = re.compile(r"\s*[(\[{<]\s*(?:at|@|arroba|chez)\s*[)\]}>]|\s+(?:at|AT|At|arroba)(?=\s)|@")
_ANY_DOT = re.compile(_any_dot)
_AFTER_AT = re.compile(rf"\s*{_label}(?:{_any_dot}{_label})*")
# the same chain of labels and dots before an at sign, read from right to left
_backward = r"[A-Za-z0-9_%+-]+"
_BEFORE_AT = re.compile(
    rf"{_backward}(?:(?:\s*[)\]}}>]\s*(?:tod|\.|tknup|tniop|otnup)\s*[(\[{{<]\s*"
    rf"|\s+(?:tod|TOD|toD|tknup|otnup)\s+|\.){_backward})*"
)


def _mail_windows(text: str) -> Iterator[tuple[int, int]]:
    """For each at sign or its disguise the whole chain of labels and dots on both sides, merged."""
    last, backward = None, text[::-1]
    for m in _NEAR_AT.finditer(text):
        before = _BEFORE_AT.match(backward, len(text) - m.start())
        after = _AFTER_AT.match(text, m.end())
        if not before or not after or not _ANY_DOT.search(after[0]):
            continue
        a, b = len(text) - before.end(), min(len(text), after.end() + 1)  # one more for the look ahead
        if last and a <= last[1]:
            last = (min(a, last[0]), max(b, last[1]))
        else:
            if last:
                yield last
            last = (a, b)
    if last:
        yield last


def _by_marks(start: int, body: str) -> list[tuple[int, int, str]]:
    """Changes that write one at sign and dots for the marks of a disguised address."""
    changes, had_at = [], "@" in re.sub(_AT, "", body)
    for m in _MARK.finditer(body):
        if m.lastgroup == "at" and not had_at:
            changes.append((start + m.start(), start + m.end(), "@"))
            had_at = True
        elif m.lastgroup == "dot":
            changes.append((start + m.start(), start + m.end(), "."))
    return changes


def _in_order(changes: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    kept, end = [], -1
    for change in sorted(changes):
        if change[0] >= end:
            kept.append(change)
            end = change[1]
    return kept


def _union(spans: list[Span]) -> list[tuple[int, int]]:
    """The ranges that spans cover, in order and without overlap."""
    merged: list[tuple[int, int]] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if merged and start < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, all spans), each in order of start and kind."""
    base = plain_spans(text)
    made = rewritten(text)
    more = []
    if made is not None:
        taken = _union(base)
        for kind, a, b in plain_spans(made.text):
            start, end = made.source(a), made.source(b, end=True)
            place = bisect_right(taken, (start, end))
            free = (not place or taken[place - 1][1] <= start) and (place == len(taken) or taken[place][0] >= end)
            if free:
                more.append((kind, start, end))
                taken.insert(place, (start, end))

    def ordered(spans: list[Span]) -> list[Span]:
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))

    return ordered(base), ordered(base + more)


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text in frame["text"]:
            base, spans = find_spans(text)
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            rows.append((*counts, hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")][1:])
        out.insert(0, "doc_id", frame["doc_id"].astype("Int64").to_numpy())
        yield out


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of plain spans of each kind, their digest, and all spans of every document."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(_found, RESULT)
