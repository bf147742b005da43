"""Importance resampling towards a target distribution, with hashed n-gram features.

Features are all runs of one to three words; a feature falls into the bucket that the CRC-32 of its bytes gives. Over a
zero register a CRC is linear: the CRC of a span is the exclusive or of one contribution for each byte, which depends
on the byte and its distance from the span's end alone, and of a constant for the length. So a table (distance, byte) is
computed once, and the hashes of all features of many texts are one gather from it and one ``bitwise_xor.reduceat`` over
the features' spans. A span longer than the table is cut into blocks from its end; each block is reduced alike, and the
blocks are folded in pairs by the linear map that a run of zero bytes applies.

Two passes over the texts: one counts the buckets of the corpus (and of the target), one adds up the logarithmic gains
of each document's features. Gumbel noise from a hash of the id turns the highest scores into a sample without
replacement. Nothing but one row per bucket and task is shuffled for the counts; the ranks come from a range partitioning
of the documents near the top, so no task ranks them all.

A null or empty text and one without a word has no features and weight 0. A null id counts as an empty string in the
noise and ranks behind all ids of the same score; rows that repeat an id and a score take consecutive ranks. Other
columns are not read. Without a document of enough words, also in an empty table, nothing is drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import staged

WIDTH = 64
"""Bytes of a block, the distances that the table holds."""
SPANS = 4096
"""Spans hashed at once: what they gather stays within a core's cache."""
SLICE = 1 << 18
"""Bytes of text from which on a slice of rows is closed; a longer text is a slice of its own."""


@dataclass(frozen=True)
class Settings:
    grams: int = 3
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 5
    seed: int = 42


def _contributions() -> np.ndarray:
    """What a byte adds to the CRC of a span, by its distance from the span's end."""
    first = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
    table = np.empty((WIDTH, 256), np.uint32)
    table[0] = first
    for d in range(1, WIDTH):
        table[d] = first[table[d - 1] & 255] ^ (table[d - 1] >> 8)
    return table


TABLE = _contributions()
FLAT = np.ascontiguousarray(TABLE.T).ravel()  # by byte, then distance
CONSTANTS = np.array([zlib.crc32(bytes(n)) for n in range(WIDTH + 1)], np.uint32)


def _shift(x: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16 & 255] ^ tables[3][x >> 24]


def _zeros() -> np.ndarray:
    """Tables of the linear map that ``WIDTH`` zero bytes apply, one for each byte of the register."""
    x = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for _ in range(WIDTH):
        x = TABLE[0][x & 255] ^ (x >> 8)
    return x


ZEROS = _zeros()


def _short(wide: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Linear parts of spans of 1 to WIDTH bytes; ``wide`` holds each byte times WIDTH."""
    ends = np.cumsum(length)
    first = ends - length
    at = np.arange(ends[-1])
    index = wide[at + np.repeat(start - first, length)]
    index += np.repeat(ends - 1, length)
    index -= at
    return np.bitwise_xor.reduceat(FLAT[index], first)


def _long(wide: np.ndarray, start: int, end: int) -> int:
    """Linear part of one span of any length, folded in pairs of blocks."""
    cuts = np.arange(end, start, -WIDTH)  # ends of the blocks, the last block first
    starts = np.maximum(cuts - WIDTH, start)
    parts = np.concatenate([_short(wide, starts[i : i + SPANS], (cuts - starts)[i : i + SPANS]) for i in range(0, len(cuts), SPANS)])
    tables = ZEROS
    while len(parts) > 1:
        odd = parts[-1:] if len(parts) % 2 else parts[:0]
        even = len(parts) // 2 * 2
        parts = np.concatenate([parts[0:even:2] ^ _shift(parts[1:even:2], tables), odd])
        tables = _shift(tables, tables)
    return int(parts[0])


def crc_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` of each span; no span is empty."""
    wide = data.astype(np.intp) * WIDTH
    length = end - start
    out = np.empty(len(start), np.uint32)
    fits = np.flatnonzero(length <= WIDTH)
    for i in range(0, len(fits), SPANS):
        some = fits[i : i + SPANS]
        out[some] = _short(wide, start[some], length[some]) ^ CONSTANTS[length[some]]
    if len(fits) < len(start):
        for i in np.flatnonzero(length > WIDTH):
            out[i] = _long(wide, int(start[i]), int(end[i])) ^ zlib.crc32(bytes(int(length[i])))
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Words:
    """The words of a slice of texts, each followed by one space, and where they are."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    row: np.ndarray
    rows: int

    def grams(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, start, end) of all runs of 1 to ``most`` words, by the number of words."""
        for n in range(1, most + 1):
            if len(self.start) < n:
                return
            last = len(self.start) - n + 1
            one = np.flatnonzero(self.row[:last] == self.row[n - 1 :])
            if len(one):
                yield self.row[one], self.start[one], (self.start + self.length)[one + n - 1]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; A-Z is lower-cased, all of it bytewise."""
    low = LOWER[data[offsets[0] : offsets[-1]]]
    bounds = offsets - offsets[0]
    inside = IN_WORD[low]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(low)]] = False  # a word ends where its text does
    begins = np.flatnonzero(inside & ~before)
    at = np.flatnonzero(inside)
    # words are the runs of positions between two beginnings
    length = np.diff(np.append(np.searchsorted(at, begins), len(at)))
    start = np.cumsum(length + 1) - (length + 1)
    packed = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    packed[np.arange(len(at)) + np.repeat(np.arange(len(begins)), length)] = low[at]
    row = np.searchsorted(bounds, begins, side="right") - 1
    return Words(packed, start, length, row, len(bounds) - 1)


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, bytes, offsets) of parts of a column of texts; nulls are empty."""
    wide = column.cast(pa.binary()).fill_null(b"").cast(pa.large_binary())
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    row = 0
    while row < len(wide):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1)
        yield row, end, data, offsets[row : end + 1]
        row = end


def bucket_counts(docs: DataFrame, known: Settings) -> np.ndarray:
    """Features in each bucket, over all texts. One row per bucket leaves each task; the driver gets one per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(known.buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                found = words_of(data, offsets)
                for _, start, end in found.grams(known.grams):
                    total += np.bincount(crc_spans(found.data, start, end) % known.buckets, minlength=known.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    counts = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(known.buckets, np.int64)
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target, rounded down; computed in doubles."""
    all_corpus, all_target, b = float(corpus.sum()), float(target.sum()), float(len(corpus))
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_corpus + b) / ((float(s) + 1) * (all_target + b)))) for s, t in zip(corpus, target, strict=True)], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, known: Settings) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value.astype(float)  # sums of whole numbers, exact
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, stop, data, offsets in slices(batch.column(1)):
                found = words_of(data, offsets)
                n_words[row:stop] = np.bincount(found.row, minlength=found.rows)
                for of, start, end in found.grams(known.grams):
                    n_features[row:stop] += np.bincount(of, minlength=found.rows)
                    each = gain[crc_spans(found.data, start, end) % known.buckets]
                    weight[row:stop] += np.bincount(of, each, minlength=found.rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, known: Settings) -> DataFrame:
    """``scored`` with ``rank``, from 1, of the given share of documents with enough words; null for all others.

    The rows that may be drawn are those from a quantile of the scores on, taken low by ten times the error that the
    sketch of the quantile can have. They are sorted by ranges of the score and written with their place in their range.
    """
    enough = F.col("n_words") >= known.min_words
    share = max(0.001, 1 - known.percent / 100)
    facts = scored.filter(enough).agg(F.count("*").alias("n"), F.percentile_approx("score", share - 0.001, 10_000).alias("low")).first()
    wanted = facts["n"] * known.percent // 100
    near = enough & (F.col("score") >= F.lit(facts["low"]))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    top = scored.filter(near).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    top = staged(top.withColumn("part", F.shiftright("place", 33)).withColumn("at", F.col("place").bitwiseAND((1 << 33) - 1)), "drawn")
    parts = top.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = top.join(parts.select("part", before.alias("before")), "part").withColumn("rank", F.col("before") + F.col("at") + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.filter(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    return ranked.select(*names).unionByName(rest.select(*names))


def resample(docs: DataFrame, target: DataFrame, known: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank, n_words``; ``rank`` is null where it is not drawn."""
    gains = gains_of(bucket_counts(docs, known), bucket_counts(target, known))
    scored = weighed(docs, gains, known).withColumn("score", F.col("weight") + noise(F.col("doc_id"), known.seed))
    return drawn(staged(scored.withColumn("row", F.monotonically_increasing_id()), "scored"), known)
