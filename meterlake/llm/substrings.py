"""Removal of repeated passages by Rabin-Karp hashes of every window of words.

Windows are counted in two steps. First by 48-bit fingerprints, which all windows send in bounded messages; a window
whose fingerprint is alone cannot repeat. The others are compared by a second, 64-bit hash together with the first: for
each distinct window every batch of documents sends its first document, and is told which of its windows begin earlier
elsewhere. Repeated windows then merge into maximal intervals of words, document by document.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm.common import shuffle_parts, texts
from meterlake.llm.fingerprints import BASE, Codes, as_table, code_words, dealt, in_order, ranks_of, rolling, split_by_bucket, tally

CLAIM = "bucket long, batch long, hash binary, mark binary, low binary, high binary"
LATER = "batch long, hash binary"
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, starts array<long>, ends array<long>, kept string"


def windows(table: pa.Table, length: int) -> tuple[pa.Table, list[int], np.ndarray, np.ndarray, np.ndarray]:
    """The batch in order, its documents' word counts, the codes of all words, and where whole windows begin.

    The last array has the row of each such window.
    """
    table, codes = in_order(table), Codes()
    parts = [code_words(t.split(), codes) if t else np.empty(0, np.uint64) for t in texts(table.column("text").combine_chunks())]
    sizes = [len(p) for p in parts]
    ends = np.cumsum(sizes)
    counts = np.maximum(np.array(sizes, np.int64) - length + 1, 0)
    rows = np.repeat(np.arange(len(sizes)), counts)
    # a window is at its document's begin plus its rank among the document's windows
    ranks = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = (ends - sizes)[rows] + ranks if len(rows) else np.empty(0, np.int64)
    return table, sizes, np.concatenate(parts) if parts else np.empty(0, np.uint64), begins.astype(np.int64), rows


def marks_of(codes: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
    """48-bit fingerprints of the windows."""
    return (rolling(codes, length, BASE[1])[begins] if len(begins) else np.empty(0, np.uint64)) >> np.uint64(16)


def hashes_of(codes: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
    return rolling(codes, length, BASE[0])[begins] if len(begins) else np.empty(0, np.uint64)


def remove_repeats(docs: DataFrame, length: int = 20, with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, starts, ends, kept``.

    A word goes if a window of ``length`` words that covers it also begins earlier, in a document of a smaller id or
    before it in its own; judged on the input. ``starts`` and ``ends`` are the maximal intervals of removed words,
    ``kept`` the rest joined by blanks if ``with_text`` asks for it. A null text has no words. Null ids come before all
    others. Rows with equal ids are taken in an order of their own: by batch, then by text.
    """
    batches = dealt(docs)
    buckets = 2 * shuffle_parts(docs.sparkSession)

    def keys(table: pa.Table) -> np.ndarray:
        _, _, codes, begins, _ = windows(table, length)
        return marks_of(codes, begins, length)

    def claims(table: pa.Table, answers: pa.Table) -> pa.Table:
        """The first document of each repeated window of the batch, by range of hashes."""
        if not table.num_rows:
            return as_table([], CLAIM)
        batch = table.column("batch")[0].as_py()
        table, _, codes, begins, rows = windows(table, length)
        marks = marks_of(codes, begins, length)
        distinct, inverse = np.unique(marks, return_inverse=True)
        live = ranks_of(answers, len(distinct))[inverse] > 0
        hashes, first = np.unique(hashes_of(codes, begins[live], length), return_index=True)
        ids = table.column("__id").to_numpy()[rows[live][first]].astype(np.int64)
        marks = marks[live][first]
        at = split_by_bucket(hashes, 64, buckets)
        return as_table(
            [
                (b, batch, hashes[s].tobytes(), marks[s].tobytes(), (ids[s] & 0xFFFFFFFF).astype(np.uint32).tobytes(), (ids[s] >> 32).astype(np.int32).tobytes())
                for b in range(buckets)
                if (s := slice(at[b], at[b + 1])).start < s.stop
            ],
            CLAIM,
        )

    def settle(table: pa.Table) -> pa.Table:
        """For each batch the hashes of its windows that begin in a document before its first one."""
        parts = [np.frombuffer(x, np.uint64) for x in table.column("hash").to_pylist()]
        join = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        hashes, marks = np.concatenate(parts), join("mark", np.uint64)
        ids = join("low", np.uint32).astype(np.int64) | join("high", np.int32).astype(np.int64) << 32
        owners = np.repeat(np.array(table.column("batch").to_pylist(), np.int64), [len(p) for p in parts])
        order = np.lexsort((owners, ids, marks, hashes))
        hashes, marks, owners = hashes[order], marks[order], owners[order]
        later = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (marks[1:] == marks[:-1])])
        hashes, owners = hashes[later], owners[later]
        return as_table([(int(o), np.sort(hashes[owners == o]).tobytes()) for o in np.unique(owners)], LATER)

    def cut(table: pa.Table, later: pa.Table) -> pa.Table:
        if not table.num_rows:
            return as_table([], OUT)
        table, sizes, codes, begins, _ = windows(table, length)
        hashes = hashes_of(codes, begins, length)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        told = np.frombuffer(b"".join(later.column("hash").to_pylist()), np.uint64)
        gone = (np.arange(len(hashes)) != first[inverse]) | np.isin(distinct, told)[inverse]
        covered = np.zeros(len(codes) + 1, np.int64)
        np.add.at(covered, begins[gone], 1)
        np.subtract.at(covered, begins[gone] + length, 1)
        removed = np.cumsum(covered)[:-1] > 0
        rows, at = [], 0
        for doc, text, n in zip(table.column("doc_id").to_pylist(), texts(table.column("text").combine_chunks()), sizes, strict=True):
            mask = removed[at : at + n]
            at += n
            words = text.split() if text else []
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
            left = b" ".join(compress(words, ~mask) if len(edges) else words)
            rows.append((doc, n, int(mask.sum()), hashlib.sha256(left).hexdigest(), edges[::2].tolist(), edges[1::2].tolist(), left.decode("utf-8", "replace") if with_text else None))
        return as_table(rows, OUT)

    answers = tally(batches, keys, lambda counts: counts > 1)
    by_batch = batches.groupBy("batch")
    later = by_batch.cogroup(answers.groupBy("batch")).applyInArrow(claims, CLAIM).groupBy("bucket").applyInArrow(settle, LATER)
    return by_batch.cogroup(later.groupBy("batch")).applyInArrow(cut, OUT)
