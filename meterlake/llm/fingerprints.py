"""Counting of fingerprints that are too many to be rows of their own.

Documents are dealt by a hash into batches of bounded size. A batch sends, for each range ("bucket") of fingerprints, one
message with its distinct fingerprints in order and how often it has each; the counts of all batches meet by bucket, and
each message is answered with one byte per fingerprint that says how frequent it is everywhere. A batch recomputes its
fingerprints when it reads the answers, so neither texts nor fingerprints travel with them. Within a batch a fingerprint
is one entry however often it occurs, so a passage of a third of all documents costs a bucket one entry per batch.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import shuffle_parts

BITS = 48
MESSAGE = "bucket long, batch long, low binary, high binary, counts binary"
ANSWER = "batch long, bucket long, ranks binary"
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Codes(dict):
    """64-bit code of each word; forgets all when it holds too many."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def code_words(words: list[bytes], codes: Codes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def rolling(codes: np.ndarray, length: int, base: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2^64, of every window of ``length`` codes, with its bits mixed at the end."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = codes[:n].copy()
    for k in range(1, length):
        total *= np.uint64(base)
        total += codes[k : k + n]
    return mixed(total)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def dealt(docs: DataFrame) -> DataFrame:
    """``doc_id, text, batch`` dealt by batch; a batch is a few megabytes if the number of shuffle partitions suits the input."""
    parts = shuffle_parts(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(2 * parts))).repartition(parts, "batch")


def in_order(table: pa.Table) -> pa.Table:
    """Rows by id, a null first, then by text: the same order whenever a batch is read."""
    ids = pc.fill_null(table.column("doc_id"), -(1 << 63))
    keyed = table.append_column("__id", ids)
    return keyed.take(pc.sort_indices(keyed, [("__id", "ascending"), ("text", "ascending")]))


def split_by_bucket(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys of so many bits; buckets are equal ranges."""
    bounds = np.array([-(-(b << bits) // buckets) for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def tally(batches: DataFrame, keys_of: Callable[[pa.Table], np.ndarray], rank: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Answers ``batch, bucket, ranks`` for the fingerprints that ``keys_of`` finds in a batch, each as often as it is to count.

    ``rank`` makes the bytes of an answer from total counts.
    """
    buckets = 2 * shuffle_parts(batches.sparkSession)

    def send(table: pa.Table) -> pa.Table:
        batch = table.column("batch")[0].as_py()
        keys, counts = np.unique(keys_of(table), return_counts=True)
        at = split_by_bucket(keys, BITS, buckets)
        rows = [
            (b, batch, (part & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), (part >> np.uint64(32)).astype(np.uint16).tobytes(), counts[at[b] : at[b + 1]].astype(np.uint32).tobytes())
            for b in range(buckets)
            if len(part := keys[at[b] : at[b + 1]])
        ]
        return as_table(rows, MESSAGE)

    def answer(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        low = [np.frombuffer(x, np.uint32) for x in table.column("low").to_pylist()]
        keys = np.concatenate(low).astype(np.uint64)
        keys |= np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("high").to_pylist()]).astype(np.uint64) << np.uint64(32)
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ranks = rank(np.add.reduceat(counts[order], starts)).astype(np.uint8)
        out = np.empty(len(order), np.uint8)
        out[order] = np.repeat(ranks, np.diff(np.append(starts, len(keys))))
        ends = np.cumsum([len(x) for x in low])
        return as_table([(b, bucket, out[e - len(x) : e].tobytes()) for b, x, e in zip(table.column("batch").to_pylist(), low, ends, strict=True)], ANSWER)

    return batches.groupBy("batch").applyInArrow(send, MESSAGE).groupBy("bucket").applyInArrow(answer, ANSWER)


def ranks_of(answers: pa.Table, n: int) -> np.ndarray:
    """The ranks of a batch's distinct fingerprints, in order."""
    rows = sorted(zip(answers.column("bucket").to_pylist(), answers.column("ranks").to_pylist(), strict=True))
    out = np.frombuffer(b"".join(r for _, r in rows), np.uint8)
    if len(out) != n:
        raise ValueError(f"{len(out)} answers to {n} fingerprints")
    return out


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}


def as_table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, ARROW[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])
