"""Substring removal and the similarity join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.data import SCHEMA, documents
from meterlake.llm import graph, jaccard, substrings

WORDS = re.compile("[^\x20\x09-\x0d]+")


def removed_by_hand(rows, length):
    """Per row in order of (id, text): the kept words."""
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[1] or ""))
    seen, out = set(), []
    for doc, text in order:
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            if key in seen:
                gone[i : i + length] = [True] * length
            seen.add(key)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((doc, len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length", [4, 20])
def test_removal_is_that_of_brute_force(docs, length):
    got = substrings.remove_repeats(docs, length, with_text=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == removed_by_hand([d[:2] for d in documents()], length)
    for r in got:
        assert sum(b - a for a, b in zip(r.starts, r.ends, strict=True)) == r.n_removed
        assert len(r.kept.split()) == r.n_words - r.n_removed
        assert all(b < a for b, a in zip(r.ends[:-1], r.starts[1:], strict=True))


def test_no_documents(none):
    assert substrings.remove_repeats(none).count() == 0
    assert jaccard.join_near(none).count() == 0


def near_by_hand(rows, k, percent):
    sets = []
    for _, text in rows:
        words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}) if words else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return Counter((doc, len(s), min(least[find(i)], default=None)) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_components_are_those_of_brute_force(docs, words, percent):
    got = jaccard.join_near(docs, jaccard.Settings(words=words, percent=percent, leaders=1)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_by_hand([d[:2] for d in documents()], words, percent)


def test_near_copies_that_are_linked_in_part(spark):
    """Chains and copies of a base, some of which are too far from each other."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(80)] = f"x{rng.randrange(4)}"
        rows.append((i, " ".join(copy)))
    frame = spark.createDataFrame([(*r, "en", "s", 1, "b", "c", 1, "g", 1) for r in rows], SCHEMA)
    got = jaccard.join_near(frame, jaccard.Settings(words=3, percent=90, leaders=2)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == near_by_hand(rows, 3, 90)


def test_divide_skip_finds_what_counting_finds():
    rng = np.random.default_rng(2)
    for _ in range(60):
        query = np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64)
        block = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(rng.integers(1, 9))]
        need = [jaccard.required(len(query), len(b), int(rng.integers(30, 100))) for b in block]
        want = [i for i, b in enumerate(block) if len(np.intersect1d(query, b)) >= need[i]]
        for cost in (0.01, 0.5, 50):
            assert sorted(jaccard.divide_skip(query, block, need, cost)) == want


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
