"""Personal data, with disguises undone.

Every text is searched twice. The base search finds addresses, IP numbers, card numbers and phone numbers as they stand.
The second search runs small transducers over the text: homoglyphs and full-width forms become ASCII, invisible
characters go, spelled digits become digits, and ``at``/``dot`` disguises become ``@`` and ``.``. Each character they
write remembers the span of source characters it came from, so an identifier found in the normalised text maps back to
source offsets. Spans of the second search are added where they do not overlap a base span.

Spans are in code points of the source text, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import reader

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The patterns of the base kinds. A match of the number patterns can only begin where no digit stands before, since the
# one before it would have taken that digit too; saying so keeps long digit runs linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMERIC = re.compile(r"[0-9]")

Span = tuple[int, int, int]
"""Start, end, and the kind's place in KINDS."""


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each at sign is tried once, with the longest local part before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        floor = found.end() if found else at + 1
        if found:
            yield start, floor
        at = text.find("@", floor)


def base_spans(text: str) -> list[Span]:
    """Spans by start, then by kind."""
    spans = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if NUMERIC.search(text):
        spans += [(*m.span(), 1) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        spans += [(*m.span(), 2) for m in CARD.finditer(text) if 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            spans += [(*m.span(), 3) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[0], s[2]))


# Letters of other scripts that look like an ASCII one.
LOOKALIKES = dict(
    zip("аеорсухіјѕԁһᴀƖІЈАВЕКМНОРСТУХΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινρ", "aeopcyxijsdhallJABEKMHOPCTYXABEZHIKMNOPTYXoivp".replace("llJ", "lIJ"), strict=True)
)
INVISIBLE = "­​‌‍⁠﻿"
SIGNS = {"․": ".", "。": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", " ": " "}
FULL_WIDTH = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
GLYPHS = {**LOOKALIKES, **SIGNS, **FULL_WIDTH, **dict.fromkeys(INVISIBLE, "")}
ODD = re.compile("[" + "".join(map(re.escape, GLYPHS)) + "]")

# Digits as words.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
DIGIT_WORD = "|".join(DIGIT_WORDS)
ANY_DIGIT = rf"(?:(?:{DIGIT_WORD})(?![A-Za-z])|[0-9])"
SPELLED = re.compile(rf"(?<![A-Za-z])(?:plus[ -]+)?(?:(?:double|triple)[ -]+)?{ANY_DIGIT}(?:[ ,.-]{{0,2}}(?:(?:double|triple)[ -]+)?{ANY_DIGIT}){{6,}}", re.IGNORECASE)
SPELLED_UNIT = re.compile(rf"plus|double|triple|dot|{DIGIT_WORD}|[0-9]|[ ,.-]+", re.IGNORECASE)
SPELLED_SIGN = re.compile(rf"(?<![A-Za-z])(?:{DIGIT_WORD})(?![A-Za-z])", re.IGNORECASE)
SPELLED_IP = re.compile(rf"(?<![A-Za-z0-9.]){ANY_DIGIT}(?:[ -]?{ANY_DIGIT}){{0,2}}(?:[ ]?(?:dot|[\[({{]dot[\])}}]|\.)[ ]?{ANY_DIGIT}(?:[ -]?{ANY_DIGIT}){{0,2}}){{3}}(?![A-Za-z0-9])", re.IGNORECASE)

AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s*@\s*)"
DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\.)"
NAME = r"[A-Za-z0-9_%+-]+"
DISGUISED = re.compile(rf"(?<![A-Za-z0-9._%+-])({NAME}(?:{DOT}{NAME}){{0,4}}?)({AT})([A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+){{1,5}})(?![A-Za-z0-9-])", re.IGNORECASE)
# The last labels that make a host of bare words believable.
TOP_LEVELS = frozenset("com net org edu gov mil int info biz io co me ai app dev uk de fr es it nl eu ch at us ca au nz jp in br".split())
DOTS = re.compile(DOT, re.IGNORECASE)
# What a text must have for a transducer to change it: a bracketed or spaced sign, or a spelled digit beside another
# digit, as near as SPELLED and SPELLED_IP allow. The word "dot" is looked for beside these.
DISGUISE_SIGN = re.compile(r"[\[({<]\s*(?:at|@|\.)\s*[\])}>]|\s@|@\s", re.IGNORECASE)
BESIDE = r"(?:[ ,.-]{0,2}| \. )(?:(?:double|triple)[ -]+)?"
SPELLED_PAIR = re.compile(rf"(?:{DIGIT_WORD})(?![A-Za-z]){BESIDE}{ANY_DIGIT}|[0-9]{BESIDE}(?:{DIGIT_WORD})(?![A-Za-z])", re.IGNORECASE)


class Tape:
    """Text with, for each of its characters, the source span that it stands for.

    Kept as runs ``(start in the text, start and end in the source, whether copied)``: a copied run stands character for
    character, each character of a rewritten one for all of its source. A text has no more runs than twice its edits.
    """

    def __init__(self, text: str, runs: list[tuple[int, int, int, bool]] | None = None):
        self.text = text
        self.runs = runs if runs is not None else [(0, 0, len(text), True)]
        self.starts = [run[0] for run in self.runs]

    def _at(self, place: int) -> tuple[int, int]:
        start, first, last, copied = self.runs[bisect_right(self.starts, place) - 1]
        return (first + place - start, first + place - start + 1) if copied else (first, last)

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self._at(start)[0], self._at(end - 1)[1]

    def _slice(self, start: int, end: int) -> Iterator[tuple[int, int, int, bool]]:
        """Runs of a slice: their length, source and kind."""
        n = bisect_right(self.starts, start) - 1
        while start < end:
            begin, first, last, copied = self.runs[n]
            stop = min(end, self.starts[n + 1] if n + 1 < len(self.runs) else len(self.text))
            yield stop - start, *((first + start - begin, first + stop - begin) if copied else (first, last)), copied
            start, n = stop, n + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace the slices ``(start, end, new)``, given in order; every new character stands for the whole slice."""
        if not edits:
            return self
        parts: list[str] = []
        runs: list[tuple[int, int, int, bool]] = []
        at = size = 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            parts.append(self.text[at:start])
            for length, *run in self._slice(at, start):
                runs.append((size, *run))
                size += length
            if new:
                runs.append((size, *self.source(start, end), False))
                size += len(new)
                parts.append(new)
            at = end
        return Tape("".join(parts), runs)


def unglyph(tape: Tape) -> Tape:
    """Look-alike letters become the ASCII ones they imitate and invisible characters go."""
    return tape.rewrite([(m.start(), m.end(), GLYPHS[m[0]]) for m in ODD.finditer(tape.text)])


def _spoken(text: str, start: int) -> list[tuple[int, int, str]]:
    """Edits that write one run of spelled digits as digits: gaps go, ``double`` and ``triple`` repeat the next digit."""
    edits, times = [], 1
    for m in SPELLED_UNIT.finditer(text):
        unit = m[0].lower()
        if unit in ("double", "triple"):
            new, times = "", 2 if unit == "double" else 3
        elif unit == "plus":
            new = "+"
        elif unit == "dot":
            new = "."
        elif unit[0] in " ,.-":
            new = "." if unit.strip() == "." and "dot" in text.lower() else ""
        else:
            new, times = DIGIT_WORDS.get(unit, unit) * times, 1
        edits.append((start + m.start(), start + m.end(), new))
    return edits


def undigit(tape: Tape) -> Tape:
    """Runs of seven or more digits of which some are spelled, and dotted quads of spelled digits, become digits."""
    runs = [m for pattern in (SPELLED_IP, SPELLED) for m in pattern.finditer(tape.text) if SPELLED_SIGN.search(m[0]) or "dot" in m[0].lower()]
    edits, floor = [], 0
    for m in sorted(runs, key=lambda m: (m.start(), -m.end())):
        if m.start() < floor:
            continue
        floor = m.end()
        edits += _quad(m) if m.re is SPELLED_IP else _spoken(m[0], m.start())
    return tape.rewrite(edits)


def _quad(m: re.Match) -> list[tuple[int, int, str]]:
    edits = []
    for part in re.finditer(rf"[\[({{ ]*dot[\])}} ]*|{DIGIT_WORD}|[ -]*\.[ -]*|[ -]+", m[0], re.IGNORECASE):
        unit = part[0].lower()
        edits.append((m.start() + part.start(), m.start() + part.end(), DIGIT_WORDS.get(unit, "." if "dot" in unit or "." in unit else "")))
    return edits


def unat(tape: Tape) -> Tape:
    """``name (at) host (dot) org`` becomes an address. Bare words count only as ``at`` followed by ``dot``."""
    edits = []
    for m in DISGUISED.finditer(tape.text):
        bare_at, bracketed = m[2].strip().lower() == "at", re.search(r"[\[({<]", m[0])
        host_dots = [d for d in DOTS.finditer(m[0], m.start(3) - m.start())]
        bare = bare_at and not bracketed
        if bare and not (any("dot" in d[0].lower() for d in host_dots) and DOTS.split(m[3])[-1].lower() in TOP_LEVELS):
            continue
        if not bare_at and m[2] == m[2].strip() == "@" and not any(len(d[0]) > 1 for d in DOTS.finditer(m[0])):
            continue  # an address as it stands
        inner = [(m.start(2), m.end(2), "@")] + [(m.start() + d.start(), m.start() + d.end(), ".") for d in DOTS.finditer(m[0]) if not m.start(2) <= m.start() + d.start() < m.end(2)]
        edits += sorted(inner)
    return tape.rewrite(edits)


def disguised(text: str) -> bool:
    """Whether a transducer may change the text; where this is false, none does."""
    return bool(not text.isascii() and ODD.search(text) or "dot" in text.lower() or DISGUISE_SIGN.search(text) or SPELLED_PAIR.search(text))


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of identifiers that only show once disguises are undone and that overlap no base span."""
    if not disguised(text):
        return []
    odd = not text.isascii() and ODD.search(text)
    found: list[Span] = []
    glyphs = unglyph(Tape(text)) if odd else Tape(text)
    digits = undigit(glyphs)
    for tape in dict.fromkeys((glyphs, digits, unat(glyphs), unat(digits))):
        if tape.text != text:
            found += [(*tape.source(a, b), kind) for a, b, kind in base_spans(tape.text)]
    # a sweep: of the base spans that begin before a span's end the furthest end counts, of those added the last one's
    starts = sorted(a for a, _, _ in base)
    ends = list(accumulate((b for _, b, _ in sorted(base)), max))
    out: list[Span] = []
    for span in sorted(set(found), key=lambda s: (s[0], -s[1], s[2])):
        before = bisect_left(starts, span[1])
        if (not before or ends[before - 1] <= span[0]) and (not out or out[-1][1] <= span[0]):
            out.append(span)
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], s[2])))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, of the first kind."""
    parts, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], s[2])):
        if a >= at:
            parts += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


OUT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, masked string"


def detect(docs: DataFrame, keep: list[str], with_text: bool = False) -> DataFrame:
    """Columns ``keep`` with counts of the base kinds, the digest of the base spans, all spans, the number of added ones.

    ``masked`` is the text with its spans replaced, where ``with_text`` asks for it, and null otherwise or for a null
    text. A null text counts as empty. Rows are independent of each other: repeated rows give repeated results.
    """
    schema = docs.select(*keep).schema
    for field in OUT.split(", "):
        schema = schema.add(*field.split(" "))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in reader(batches, "__text"):
            rows = []
            for raw in found:
                text = raw.decode("utf-8", "replace") if raw else ""
                base = base_spans(text)
                extra = added_spans(text, base)
                counts = [sum(k == kind for _, _, k in base) for kind in range(4)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written(base + extra), len(extra), masked(text, base + extra) if with_text and raw is not None else None))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.string()]
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=schema.names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)
