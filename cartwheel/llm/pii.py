"""PII: offset-preserving deobfuscation before detection.

Detectors for e-mail addresses, IP addresses, card and phone numbers run on the text
itself (the base spans) and once more on a normalised copy. Transducers make that
copy: look-alike letters, full-width forms and digits of other scripts become ASCII,
invisible characters go, spelled digits become digits, ``[at]``, ``(dot)`` and their
like become ``@`` and ``.``. Every character of the copy knows the source characters
it stands for, so spans found there are mapped back; those that lie within no base span of their
kind are added.

Number words may be part of a number or prose beside it ("6467 one of them"), so the copy
has several readings: none spelled, and all runs of at least 1, 2, 3 or 4 words spelled out.
The detectors decide in each of them (length, Luhn sum), and what any finds counts; of added
e-mail addresses within each other the longest stays. A span of one digit value over and
over without a digit in its source is prose.

Bare words stand for ``@`` and ``.`` only in pairs of one language ("at ... dot", "arroba ...
punto"), and only where the last label is a generic top-level domain of a fixed list or of two
letters ("noon dot the end" is prose). "at" before a host name written out ("look at
example.com") is taken as prose.

All scans are linear in the text's length. Defined cases: a null text is empty and has
no span; rows come back one for one (repeated rows too); offsets are code points;
extra columns are ignored (``redacted`` carries them through).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import by_position, table, take

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

#: look-alike letters (fixed values): Cyrillic and Greek forms of Latin letters
LOOK_ALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονрӏ",
    "ABESIJKMHOPCTYXaesijopcyxdqwABEZHIKMNOPTYXovpl", strict=True))
#: other signs for a dot and a hyphen (fixed values)
SIGNS = dict(zip("。｡․‐‑‒–—−", "...------", strict=True))
SPACES = "\u00a0\u2000-\u200a\u202f\u205f\u3000"
#: bare words for @ and . by language (fixed values): English, Spanish and Portuguese, French, German
SPOKEN = (("at", "dot"), ("arroba", "punto|ponto"), ("arobase|arrobase", "point"), ("ät|klammeraffe", "punkt"))
#: generic top-level domains (fixed values); any two letters are a country's
GENERIC = ("com org net edu gov mil int info biz name pro mobi aero coop museum jobs travel app dev xyz online site shop store "
           "blog cloud tech email world live news media agency digital solutions").split()
INVISIBLE = "­​‌‍⁠﻿"
#: spelled digits (fixed values): English, German, French, Spanish
SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_OF = {w: str(d) for ws in SPELLED for d, w in enumerate(ws.split())} | {"oh": "0"}
#: readings of the copy: the least words of a run that is spelled out
LEAST_SPELLED = (1, 2, 3, 4)

ODD = re.compile(f"[{''.join(LOOK_ALIKES)}{''.join(SIGNS)}{SPACES}{INVISIBLE}！-～﹐-﹫\U0001d400-\U0001d7ff]|(?![0-9])\\d")
#: words that repeat the digit after them (fixed values)
TIMES = {"double": 2, "triple": 3, "doble": 2}
_WORD = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_DIGIT = rf"(?:(?:{'|'.join(TIMES)})[\s-]+)?(?:{_WORD}|[0-9])"
SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:plus[\s,-]+|\+[ ]?)?(?:{_DIGIT}(?:[\s,.-]+(?:(?:dot|point)[\s,.-]+)?))*{_DIGIT}(?!\w)", re.I)
TOKEN = re.compile(r"\w+|\+")
# brackets are looked for first, the white space around them is taken in afterwards: a search that
# began with white space would try every place of a long run
BRACKET_AT = re.compile(r"[\[({<]\s*(?:at|arroba|@)\s*[\])}>]", re.I)
BRACKET_DOT = re.compile(r"[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]", re.I)
_TOP = rf"(?:{'|'.join(GENERIC)}|[A-Za-z]{{2}})(?![A-Za-z0-9-])"
_ARTICLE = r"(?!(?:the|an?|this|that|my|our|your|its)\s)"
#: (all of it, the dots in it) for each language
BARE = [(re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(\s++(?:{at})\s++){_ARTICLE}[A-Za-z0-9-]++(?:(?:\s++(?:{dot})\s++|\.)[A-Za-z0-9-]+)*"
    rf"\s++(?:{dot})\s++{_TOP}", re.I), re.compile(rf"(?<=\S)\s++(?:{dot})\s++", re.I)) for at, dot in SPOKEN]
_ANY_DOT = "|".join(dot for _, dot in SPOKEN)
HALF_BARE = re.compile(
    rf"@[A-Za-z0-9-]++(?:(?:\s++(?:{_ANY_DOT})\s++|\.)[A-Za-z0-9-]+)*\s++(?:{_ANY_DOT})\s++{_TOP}", re.I)
BARE_DOT = re.compile(rf"(?<=\S)\s++(?:{_ANY_DOT})\s++", re.I)
#: signs with spaces around them
SPACED = re.compile(rf"(?<=[A-Za-z0-9_%+-])( {{0,3}})@( {{0,3}})[A-Za-z0-9-]++(?:(?: {{1,3}}\. {{1,3}}|\.)[A-Za-z0-9-]+)*(?: {{1,3}}\. {{1,3}}|\.){_TOP}", re.I)
SPACED_DOT = re.compile(r"(?<=\S) {1,3}\. {1,3}")
DIGIT_DOT = re.compile(r"(?<=[0-9])\s+dot\s+(?=[0-9])", re.I)


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From each @: the run of local characters before it, from the last match on, and the domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def detect(text: str) -> list[tuple[int, int, int]]:
    """Sorted (start, kind number, end) of the base detectors."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


class Normalised:
    """A text under rewriting, with the source span of each of its characters."""

    def __init__(self, text: str, spans: list[tuple[int, int]] | None = None):
        self.text = text
        self.spans = spans  # none: each character is its own source

    def _span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.spans is None else (self.spans[a][0], self.spans[b - 1][1])

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> None:
        """Replace each (start, end, new) of the present text, in order."""
        if not pieces:
            return
        text, spans, at = [], [], 0

        def keep(a: int, b: int) -> None:
            text.append(self.text[a:b])
            spans.extend(zip(range(a, b), range(a + 1, b + 1)) if self.spans is None else self.spans[a:b])

        for a, b, new in pieces:
            keep(at, a)
            text.append(new)
            spans.extend([self._span(a, b)] * len(new))
            at = b
        keep(at, len(self.text))
        self.text, self.spans = "".join(text), spans

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self._span(a, b)


def _plain(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if c in SIGNS:
        return SIGNS[c]
    digit = unicodedata.decimal(c, None)
    return str(digit) if digit is not None else unicodedata.normalize("NFKC", c)


def _spelled(m: re.Match) -> tuple[int, tuple[int, int, str]]:
    """The run's number of words, and what it is rewritten to."""
    new, words, times = "", 0, 1
    for t in TOKEN.findall(m[0]):
        low = t.lower()
        if low in ("plus", "+"):
            new += "+"
        elif low in ("dot", "point"):
            new += "."
        elif low in TIMES:
            times = TIMES[low]
            words += 1
        else:
            words += low in DIGIT_OF
            new += DIGIT_OF.get(low, t) * times
            times = 1
    return words, (m.start(), m.end(), new)


def normalise(text: str) -> list[tuple[int, Normalised]]:
    """The readings of the normalised copy that differ from the text and from each other,
    with the least words of the runs spelled out there (0: none is)."""
    out = Normalised(text)
    if not text.isascii():
        out.rewrite([(m.start(), m.end(), _plain(m[0])) for m in ODD.finditer(text)])
    # the others' triggers may have been disguised themselves
    low = out.text.lower()
    spelled = any(w in low for w in DIGIT_OF)
    if any(c in low for c in "[({<"):
        out.rewrite(_widened(out.text, BRACKET_AT, "@"))
        out.rewrite(_widened(out.text, BRACKET_DOT, "."))
    if any(dot in low for dot in _ANY_DOT.split("|")):
        for (bare, dot), (_, words) in zip(BARE, SPOKEN, strict=True):
            if any(w in low for w in words.split("|")):
                found = []
                for m in bare.finditer(out.text):
                    found.append((*m.span(1), "@"))
                    found += [(d.start(), d.end(), ".") for d in dot.finditer(out.text, m.end(1), m.end())]
                out.rewrite(found)
        if "@" in out.text:
            out.rewrite([(d.start(), d.end(), ".") for m in HALF_BARE.finditer(out.text)
                         for d in BARE_DOT.finditer(out.text, m.start(), m.end())])
        out.rewrite([(m.start(), m.end(), ".") for m in DIGIT_DOT.finditer(out.text)])
    if "@" in out.text:
        found = []
        for m in SPACED.finditer(out.text):
            if m[1] or m[2]:
                found.append((m.start(), m.end(2), "@"))
            found += [(d.start(), d.end(), ".") for d in SPACED_DOT.finditer(out.text, m.end(2), m.end())]
        out.rewrite(found)
    readings = [] if out.spans is None else [(0, out)]
    runs = [_spelled(m) for m in SPELLED_RUN.finditer(out.text)] if spelled else []
    for least in LEAST_SPELLED:
        if any(words == least or words > least == LEAST_SPELLED[-1] for words, _ in runs):
            copy = Normalised(out.text, out.spans)
            copy.rewrite([p for words, p in runs if words >= least])
            copy.rewrite([(d.start(), d.end(), ".") for d in DIGIT_DOT.finditer(copy.text)])
            readings.append((least, copy))
    return readings


def _widened(text: str, bracket: re.Pattern, new: str) -> list[tuple[int, int, str]]:
    """The brackets, with the white space beside them, and what they stand for."""
    out, last = [], 0
    for m in bracket.finditer(text):
        a, b = m.span()
        while a > last and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        out.append((a, b, new))
        last = b
    return out


def _longest(spans: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Without the e-mail addresses that lie within longer ones."""
    out, end = [], -1
    for a, k, b in sorted(spans, key=lambda s: (s[0], -s[2], s[1])):
        if k == 0:
            if b <= end:
                continue
            end = b
        out.append((a, k, b))
    return out


def _prose(new: str, source: str) -> bool:
    """One number word over and over."""
    return len(set(DIGIT.findall(new))) == 1 and not any(map(str.isdecimal, source))


def spans_of(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each sorted (start, kind number, end)."""
    if not text:
        return [], []
    base = detect(text)
    out = set()
    own = [[(a, b) for a, k, b in base if k == kind] for kind in range(len(KINDS))]
    for least, copy in normalise(text):
        nth = [0] * len(KINDS)
        for a, k, b in detect(copy.text):
            start, end = copy.source(a, b)
            if least and _prose(copy.text[a:b], text[start:end]):
                continue
            while nth[k] < len(own[k]) and own[k][nth[k]][1] < end:
                nth[k] += 1
            if nth[k] == len(own[k]) or own[k][nth[k]][0] > start:
                out.add((start, k, end))
    return base, sorted([*base, *_longest(out)])


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans go as one."""
    out, at = [], 0
    for a, k, b in spans_of(text)[1]:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return text if not out else "".join(out) + text[at:]


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                base, every = spans_of(text)
                kinds = [k for _, k, _ in base]
                rows.append((*map(kinds.count, range(len(KINDS))), hashlib.sha256(as_text(base).encode()).hexdigest(),
                             as_text(every), len(every)))
            columns = [pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(found)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", *(c for c, _ in found)])

    found = [*((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return take(docs, doc_id="bigint", text="string").mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_spans bigint")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in the text replaced, all columns carried."""
    plain, where = by_position(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            new = pa.array([redact(t) for t in b.column(at).to_pylist()], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if j == at else c for j, c in enumerate(b.columns)], b.schema.names)

    text = where["text"]
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
