"""Packing of documents into sequences by a configuration linear program.

How many pieces there are of each length is all that decides how well they pack, and that histogram has no more rows than
a sequence has places, whatever the corpus. Over it stands the configuration program: how often is each pattern of lengths
used, so that all pieces are covered by the fewest sequences. It is solved by multiplicative weights: a length's price
falls when the patterns of a round cover it more than it needs, and rises otherwise; the patterns of a round are found by
pricing, an unbounded knapsack by dynamic programming, whose table gives the best pattern around every length at once. The
average over the rounds is rounded, and the lengths left over are put around the largest ones by best fit, gaps closed
exactly where one or two lengths can; of a few such roundings the one with the fewest sequences is taken.

Spark cuts the texts, counts, and hands out places: each piece is numbered among those of its length as it is written,
numbers of tasks are added up by length, and a piece's number says which place of which sequence it fills. No task sees
all pieces of a length, and no row is sorted.

Null and empty texts have one piece, of the final token. Rows that repeat are documents of their own. Other columns than
those named are not read. An empty table gives no row. A long text is cut into tokens in parts, so that a task holds its
text, its token numbers and one part.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlake.llm.common import reader, staged
from meterlake.llm.tokens import driver_text, spelled

CACHE = 300_000
PART = 200_000  # pre-tokens of a text that are held at once

# The pre-token pattern of byte-level tokenizers, for texts of Latin letters alone and for all of Unicode.
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
BLANKS = " \t-\r\x85\xa0"
PLAIN = re.compile(r"[\x00-ɏ‐-‧]*\Z")
LATIN_PIECES = re.compile(
    f" ?[{LATIN}]+| ?[0-9²³¹¼½¾]+|'(?:s|t|re|ve|m|ll|d)| ?[^{BLANKS}{LATIN}0-9²³¹¼½¾]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
PIECES = regex.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class Ids(dict):
    """The token numbers of each pre-token, as little-endian unsigned integers of four bytes."""

    def __init__(self, source: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(source)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {name: struct.pack("<I", i) for name, i in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def __missing__(self, piece: str) -> bytes:
        found = self.tokenizer.model.tokenize(spelled(piece))
        packed = struct.pack(f"<{len(found)}I", *(t.id for t in found))
        if len(self) >= CACHE:
            self.clear()
        self[piece] = packed
        return packed

    def plain(self, text: str) -> bytes:
        pattern = LATIN_PIECES if PLAIN.match(text) else PIECES
        if len(text) <= PART:
            return b"".join(map(self.__getitem__, pattern.findall(text)))
        pieces, out = (m.group() for m in pattern.finditer(text)), bytearray()
        while part := list(islice(pieces, PART)):
            out += b"".join(map(self.__getitem__, part))
        return bytes(out)

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(name in text for name in self.special):
            return self.plain(text)
        return b"".join(self.special.get(part) or self.plain(part) for part in self.cut.split(text) if part)


@lru_cache(maxsize=1)
def loaded(source: str) -> Ids:
    """One per Python worker, whatever the number of its tasks."""
    return Ids(source)


def cut(size: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, but for the first, which may be shorter."""
    first = size % capacity or capacity
    yield 0, first
    for start in range(first, size, capacity):
        yield start, capacity


def pieces(docs: DataFrame, vocabulary: str, keep: list[str], capacity: int, end: int = 0) -> DataFrame:
    """Columns ``keep`` with ``piece, start, length, ids_crc32`` and the piece's number ``at`` among those of its length in ``part``, its task."""
    shared = docs.sparkSession.sparkContext.broadcast(driver_text(docs.sparkSession, vocabulary))
    schema = docs.select(*keep).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("part", "integer"), ("at", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen, part = loaded(shared.value), Counter(), TaskContext.get().partitionId()
        last = struct.pack("<I", end)
        for batch, found in reader(batches, "__text", 128):
            row, rows = [], []
            for i, text in enumerate(found):
                packed = memoryview((ids.encode(text.decode("utf-8", "replace")) if text else b"") + last)
                for n, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                    row.append(i)
                    rows.append((n, start, length, zlib.crc32(packed[4 * start : 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
            kept = [batch.column(name).take(pa.array(row, pa.int64())) for name in keep]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            if rows:
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=schema.names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


Pattern = tuple[tuple[int, int], ...]
"""Lengths, each with how many of it."""


@dataclass(frozen=True)
class Settings:
    rounds: int = 60
    steps: tuple[tuple[float, float], ...] = ((0.0005, 0.0004), (0.05, 0.05))
    """How far a price moves in a round, and how far from the best pattern's value the pattern around a length may stay and
    still be used. The small step is for lengths that fill sequences without a rest, where prices in proportion to lengths
    are right and only the shares of patterns have to be found; the large one is for lengths that do not."""
    shares: tuple[float, ...] = (1.0, 0.75, 0.5, 0.25)
    """Parts of the fractional solution that are rounded, each for one try."""


def knapsack(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every capacity the best value of lengths that fit, and the length to take first (0: leave one place empty)."""
    capacity = len(price) - 1
    worth = np.where(price > 0, price, -np.inf)
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        with_each = best[c - 1 :: -1] + worth[1 : c + 1] if c > 1 else best[:1] + worth[1:2]
        k = int(np.argmax(with_each))
        best[c], choice[c] = (with_each[k], k + 1) if with_each[k] > best[c - 1] else (best[c - 1], 0)
    return best, choice


def around(seeds: np.ndarray, choice: np.ndarray) -> np.ndarray:
    """The best pattern around each of ``seeds``: how many of each length, one row per seed."""
    capacity = len(choice) - 1
    counts = np.zeros((len(seeds), capacity + 1), np.int64)
    counts[np.arange(len(seeds)), seeds] = 1
    left, active = capacity - seeds, np.arange(len(seeds))
    while len(active):
        taken = choice[left[active]]
        counts[active[taken > 0], taken[taken > 0]] += 1
        left[active] -= np.maximum(taken, 1)
        active = active[left[active] > 0]
    return counts


def solve(demand: np.ndarray, rounds: int, rate: float, slack: float) -> tuple[dict[Pattern, float], float]:
    """A fractional solution by multiplicative weights, and a lower bound on the number of sequences from its prices.

    ``demand[l]`` pieces have length ``l``; the last one is the capacity.
    """
    lengths, there = np.arange(len(demand)), demand > 0
    tokens, weight, bound = float(lengths @ demand), np.zeros(len(demand)), 0.0
    used: dict[Pattern, float] = Counter()
    for _ in range(rounds if tokens else 0):
        price = np.where(there, lengths * np.exp(weight), 0.0)
        best, choice = knapsack(price)
        bound = max(bound, float(demand @ price) / best[-1])
        seeds = np.flatnonzero(there)
        seeds = seeds[price[seeds] + best[len(demand) - 1 - seeds] >= (1 - slack) * best[-1]]
        counts = around(seeds, choice)
        amount = demand[seeds] / counts[np.arange(len(seeds)), seeds]
        amount *= tokens / float(amount @ counts @ lengths)
        covered = amount @ counts
        weight += rate * (1 - np.minimum(np.where(there, covered / np.maximum(demand, 1), 1), 4))
        for row, n in zip(counts, amount / rounds, strict=True):
            of = np.flatnonzero(row)
            used[tuple(zip(of.tolist(), row[of].tolist(), strict=True))] += n
    return used, bound


def rounded(used: dict[Pattern, float], demand: np.ndarray, share: float) -> list[tuple[Pattern, int]]:
    """Patterns as often as a part of the solution has them, fractions carried on, and never more than there are pieces."""
    left, carried, out = demand.copy(), 0.0, []
    for pattern, amount in sorted(used.items(), key=lambda item: item[0][::-1], reverse=True):
        upto = carried + share * amount
        times = min(int(upto) - int(carried), *(int(left[length]) // n for length, n in pattern))
        carried = upto
        if times > 0:
            out.append((pattern, times))
            for length, n in pattern:
                left[length] -= n * times
    return out


def closed(left: np.ndarray, gap: int) -> list[int]:
    """One or two lengths that fill a gap exactly, the larger one as large as can be; none if there are none."""
    if left[gap]:
        return [gap]
    small = left[1 : gap // 2 + 1]
    pairs = np.flatnonzero((small > 0) & (left[gap - 1 : gap - 1 - len(small) : -1] > 0)) + 1
    for small_one in pairs[:2].tolist():
        if 2 * small_one < gap or left[small_one] > 1:
            return [small_one, gap - small_one]
    return []


def fitted(demand: np.ndarray, exact: bool) -> list[tuple[Pattern, int]]:
    """Patterns around the largest length left, each as often as it goes: close the gap exactly (if ``exact``), else take the best fit and go on."""
    left, out, top = demand.copy(), [], len(demand) - 1
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        pattern, gap = Counter({top: 1}), len(demand) - 1 - top
        left[top] -= 1
        while gap:
            fit = closed(left, gap) if exact else []
            if not fit:
                some = np.flatnonzero(left[1 : gap + 1])
                if not len(some):
                    break
                fit = [int(some[-1]) + 1]
            for length in fit:
                pattern[length] += 1
                left[length] -= 1
                gap -= length
        more = min(int(left[length]) // n for length, n in pattern.items())
        for length, n in pattern.items():
            left[length] -= more * n
        out.append((tuple(sorted(pattern.items())), 1 + more))


def patterns(demand: np.ndarray, known: Settings = Settings()) -> tuple[list[tuple[Pattern, int]], float]:
    """Patterns and how often each is used, so that every piece has its place, and a lower bound on the number of sequences."""
    tries, bounds = [], []
    for rate, slack in known.steps:
        used, bound = solve(demand, known.rounds, rate, slack)
        bounds.append(bound)
        for share in known.shares:
            first = rounded(used, demand, share)
            left = demand.copy()
            for pattern, times in first:
                for length, n in pattern:
                    left[length] -= n * times
            tries += [first + fitted(left, exact) for exact in (True, False)]
    return min(tries, key=lambda found: sum(times for _, times in found)), max(bounds)


def places(found: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, pieces of this length in each sequence, offset), by length and number.

    The pieces of a length are dealt to the patterns in order. There are no more rows than patterns and lengths in them.
    """
    rows, sequence, number = [], 0, Counter()
    for pattern, times in found:
        offset = 0
        for length, n in reversed(pattern):
            rows.append((length, number[length], sequence, n, offset))
            number[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, keep: list[str], capacity: int = 2048, known: Settings = Settings()) -> DataFrame:
    """One row per piece: columns ``keep`` with ``piece, start, length, ids_crc32, sequence_id, offset``."""
    cut_up = staged(pieces(docs, vocabulary, keep, capacity), "pieces")
    by_part = staged(cut_up.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    demand = np.zeros(capacity + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        demand[row["length"]] = row["n"]
    table = places(patterns(demand, known)[0])
    shared = docs.sparkSession.sparkContext.broadcast(table)
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = cut_up.join(by_part.select("part", "length", earlier.alias("before")), ["part", "length"])
    numbered = numbered.select(*keep, "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("at")).alias("number"))
    schema = docs.select(*keep).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("sequence_id", "long"), ("offset", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, each, offset = shared.value.T
        begins = np.searchsorted(length, np.arange(capacity + 2))
        for batch in batches:
            size, number = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "number"))
            at = np.empty(len(size), np.int64)
            for one in np.unique(size):
                mine = size == one
                span = slice(begins[one], begins[one + 1])
                at[mine] = begins[one] + np.searchsorted(first[span], number[mine], side="right") - 1
            nth = number - first[at]
            out = [pa.array(sequence[at] + nth // each[at]), pa.array(offset[at] + nth % each[at] * size)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=schema.names)

    return numbered.mapInArrow(run, schema)
