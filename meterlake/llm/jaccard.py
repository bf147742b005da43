"""Exact Jaccard self-join on word shingles by T-occurrence search (DivideSkip).

A document that is to reach similarity t with a text of n shingles shares at least T = t n of them. So it occurs in the
inverted lists of any n - T + 1 of these shingles, and the rarest give the shortest lists. Document frequencies are
counted over all documents; each document puts only its rarest shingles that others have too into the index, and the
search reads only these short lists. Candidates are then settled leader by leader: the leader's lists over a block of
candidates are divided, the short ones are merged by a heap, and the long ones are probed by binary search for the
candidates whose count can still reach what is required.

Documents with equal sets are one class. Long lists are not joined with themselves: some members lead, those with the
fewest elements of their own first, as they lie in the middle of their copies; the rest meet only the leaders, and what has come together in one component is not compared again. Rounds go on, with more leaders
each, until every list is one component or all members outside its largest one have led, so no link between components
is lost.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import staged, texts
from meterlake.llm.fingerprints import BASE, Codes, as_table, code_words, dealt, in_order, mixed, ranks_of, rolling, tally
from meterlake.llm.graph import components

SETS = "doc_id long, text_key binary, n long, m long, cls binary, tokens array<long>, hashes binary"


@dataclass(frozen=True)
class Settings:
    words: int = 5
    """Words of a shingle."""
    percent: int = 80
    """Similarity from which two documents are linked."""
    leaders: int = 4
    """Members of a list that lead in the first round; each later round takes eight times as many."""
    probe_cost: float = 0.01
    """The weight of DivideSkip for the number of long lists."""
    text_keys: bool = False
    """Whether rows get the digest of their text, which tells apart those that share an id or have none."""


def shingles(text: bytes | None, words: int, codes: Codes) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted; a text with fewer words is one shingle, one without is none."""
    found = text.lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    coded = code_words(found, codes)
    if len(found) < words:
        return mixed(rolling(coded, len(found), BASE[0]) + np.uint64(len(found)))
    return np.unique(rolling(coded, words, BASE[0]))


def required(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m elements whose similarity reaches the percentage."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """How many of n elements can be left out so that the others are too few for any link, plus one."""
    return n - -(-percent * n // 100) + 1


def rank_of(counts: np.ndarray) -> np.ndarray:
    """0 for what one document has alone, then by eighths of the binary logarithm of the frequency."""
    return np.where(counts > 1, np.minimum(255, 1 + np.floor(8 * np.log2(np.maximum(counts, 1)))), 0)


def divide_skip(query: np.ndarray, block: list[np.ndarray], need: list[int], probe_cost: float = 0.01) -> list[int]:
    """Members of the block that share at least ``need`` elements with the query."""
    sizes = [len(b) for b in block]
    pool, owners = np.concatenate(block), np.repeat(np.arange(len(block)), sizes)
    at = np.minimum(np.searchsorted(query, pool), len(query) - 1)
    hit = query[at] == pool
    at, owners = at[hit], owners[hit]
    order = np.argsort(at, kind="stable")  # owners stay in order within a list
    owners, bounds = owners[order], np.searchsorted(at[order], np.arange(len(query) + 1))
    lists = [owners[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True) if a < b]
    if not lists:
        return []
    lists.sort(key=len)
    least = min(need)
    n_long = min(len(lists), least - 1, int(least / (probe_cost * math.log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    out, last, count = [], -1, 0

    def settle(member: int, count: int) -> None:
        left = len(long)
        for probed in long:
            if count >= need[member] or count + left < need[member]:
                break
            i = bisect_left(probed, member)
            count += i < len(probed) and probed[i] == member
            left -= 1
        if count >= need[member]:
            out.append(member)

    for member in heapq.merge(*short):
        if member != last:
            if count:
                settle(last, count)
            last, count = member, 0
        count += 1
    if count:
        settle(last, count)
    return out


def text_keys(table: pa.Table) -> list[bytes | None]:
    """MD5 digests of the texts."""
    return [None if t is None else hashlib.md5(t, usedforsecurity=False).digest() for t in texts(table.column("text").combine_chunks())]


def sets_of(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per document: number of shingles ``n``, of those that others have too ``m``, class (digest of the set), indexed
    shingles, and the set where there are any."""
    batches = dealt(docs)

    def parts(table: pa.Table) -> list[np.ndarray]:
        codes = Codes()
        return [shingles(t, settings.words, codes) for t in texts(table.column("text").combine_chunks())]

    def keys(table: pa.Table) -> np.ndarray:
        return np.concatenate(parts(table)) >> np.uint64(16)

    def index(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return as_table([], SETS)
        table = in_order(table)
        found = parts(table)
        distinct, inverse = np.unique(np.concatenate(found) >> np.uint64(16), return_inverse=True)
        ranks = ranks_of(answers, len(distinct))[inverse]
        rows, at = [], 0
        keys_of_texts = text_keys(table) if settings.text_keys else [None] * len(found)
        for doc, key, own in zip(table.column("doc_id").to_pylist(), keys_of_texts, found, strict=True):
            rank = ranks[at : at + len(own)]
            at += len(own)
            if not len(own):
                rows.append((doc, key, 0, 0, None, [], None))
                continue
            shared = int((rank > 0).sum())
            rare = np.lexsort((own, rank))[: prefix_length(len(own), settings.percent)]
            # with too few elements that any other document has, no link is possible
            tokens = own[rare[rank[rare] > 0]].view(np.int64).tolist() if 100 * shared >= settings.percent * len(own) else []
            rows.append((doc, key, len(own), shared, hashlib.blake2b(own.tobytes(), digest_size=16).digest(), tokens, own.tobytes() if tokens else None))
        return as_table(rows, SETS)

    answers = tally(batches, keys, rank_of)
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(index, SETS)


def links_of(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``leader, member`` that are linked, as ``a, b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                leaders, members, own, other = (part.column(name).to_pylist() for name in ("leader", "member", "own", "other"))
                out, at = [], 0
                while at < len(leaders):
                    end = at + 1
                    while end < len(leaders) and leaders[end] == leaders[at]:
                        end += 1
                    query = np.frombuffer(own[at], np.uint64)
                    block = [np.frombuffer(x, np.uint64) for x in other[at:end]]
                    need = [required(len(query), len(b), settings.percent) for b in block]
                    out += [(leaders[at], members[at + j]) for j in divide_skip(query, block, need, settings.probe_cost)]
                    at = end
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["a", "b"])

    others = sets.select(F.col("cls").alias("member"), F.col("hashes").alias("other"))
    owns = sets.select(F.col("cls").alias("leader"), F.col("hashes").alias("own"))
    return pairs.join(others, "member").join(owns, "leader").select("leader", "member", "own", "other").mapInArrow(run, "a binary, b binary")


def join_near(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, class_id, text_key, component``.

    ``component_id`` is the smallest id that is reached over links, the row's own among them; ``class_id`` the smallest
    id with an equal set. Texts without words are linked with nothing and keep their own id. Null ids never are the
    smallest; repeated rows belong to one class. ``component`` tells components apart also where ids are null or stand on
    several texts; it is null for texts without words. ``text_key`` is the MD5 digest of the text if the settings ask for it.
    """
    found = staged(sets_of(docs, settings), "jaccard-sets")
    classes = found.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.min(F.when(F.size("tokens") > 0, F.struct("n", "m", "tokens", "hashes"))).alias("s"))
    classes = staged(classes.select("cls", "class_id", "s.n", "s.m", "s.tokens", "s.hashes"), "jaccard-classes")
    sets = classes.filter("hashes is not null").select("cls", "n", "hashes")
    lists = classes.filter("hashes is not null").select("cls", "n", "m", F.posexplode("tokens").alias("k", "token")).withColumn("rest", (F.col("m") - F.col("k")).cast("long")).drop("k")
    sizes = lists.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1").select(F.col("token").alias("t"))
    lists = staged(lists.join(sizes, F.col("token") == F.col("t")).drop("t"), "jaccard-lists")

    linked, roots, led = None, None, None
    count, live = settings.leaders, lists.withColumn("comp", F.col("cls"))
    while True:
        # those outside the largest component of their list who have not led yet
        shares = live.groupBy("token", "comp").agg(F.count("*").alias("k"))
        main = shares.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("kinds")).filter("kinds > 1")
        main = main.select(F.col("token").alias("t"), F.col("top.comp").alias("main"), F.col("top.k").alias("k"))
        open_lists = live.join(main, F.col("token") == F.col("t")).drop("t")
        waiting = open_lists.filter((F.col("comp") != F.col("main")) | (F.col("k") == 1))
        if led is not None:
            waiting = waiting.join(led, ["token", "cls"], "left_anti")
        place = F.row_number().over(Window.partitionBy("token").orderBy(F.col("n") - F.col("m"), "cls"))
        leaders = staged(waiting.withColumn("place", place).filter(F.col("place") <= count).select("token", "cls", "n", "rest", "comp"), "jaccard-leaders")
        if leaders.isEmpty():
            break
        led = leaders.select("token", "cls") if led is None else led.unionByName(leaders.select("token", "cls"))
        heads = leaders.select(F.col("token").alias("t"), F.col("cls").alias("leader"), F.col("n").alias("ln"), F.col("rest").alias("lr"), F.col("comp").alias("lc"))
        # of the first element that two have in common, neither the sizes nor what comes after it rule the overlap out
        near = (
            (F.least("n", "ln") * 100 >= F.greatest("n", "ln") * settings.percent)
            & ((F.col("n") + F.col("ln")) * settings.percent <= F.least("rest", "lr") * (100 + settings.percent))
            & (F.col("comp") != F.col("lc"))
        )
        met = open_lists.join(heads, F.col("token") == F.col("t")).filter(near)
        # a pair of two leaders is settled once
        pairs = met.select(F.least("leader", "cls").alias("x"), F.greatest("leader", "cls").alias("y"), "leader").groupBy("x", "y").agg(F.min("leader").alias("leader"))
        pairs = pairs.select("leader", F.when(F.col("leader") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("member"))
        new = staged(links_of(pairs, sets, settings), "jaccard-links")
        count *= 8
        if new.isEmpty():  # the components stay as they are
            continue
        linked = new if roots is None else new.unionByName(roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = staged(components(linked), "jaccard-roots")
        live = lists.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "n", "m", "rest", "token", F.coalesce("root", "cls").alias("comp"))

    ids = classes.select("cls", "class_id")
    if roots is None:
        final = ids.select("cls", "class_id", F.col("cls").alias("root"), F.col("class_id").alias("component"))
    else:
        rooted = ids.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "class_id", F.coalesce("root", "cls").alias("root"))
        least = rooted.groupBy("root").agg(F.min("class_id").alias("component"))
        final = rooted.join(least, "root").select("cls", "class_id", "root", "component")
    rows = found.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("cls").alias("c"))
    rows = rows.join(final, F.col("c") == F.col("cls"), "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"), "text_key", F.col("root").alias("component"))
