"""Conversations, packing and resampling against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlake.llm import conversations, packing, resample

BLANKS = " \t\n\x0b\x0c\r"
FITS = re.compile(r"(s?(ua)+)?\Z")


# conversations


def all_audits(codes: str, most: int):
    """Every edit script with at most ``most`` inserts, by trying them all: (cost, audit)."""

    def go(i, inserts, cost, audit, roles):
        if i == len(codes) and FITS.match(roles):
            yield cost, audit
        if inserts:
            for role in "ua":
                yield from go(i, inserts - 1, cost + 5, audit + "I", roles + role)
        if i < len(codes):
            yield from go(i + 1, inserts, cost + 2, audit + "D", roles)
            if codes[i] != "x":
                extra = 5 * codes[i].isupper()
                if codes[i].lower() in "sua":
                    yield from go(i + 1, inserts, cost + extra, audit + "K", roles + codes[i].lower())
                for role in "ua":
                    yield from go(i + 1, inserts, cost + 1 + extra, audit + "R", roles + role)

    return go(0, most, 0, "", "")


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_audits_are_the_least_of_all(n):
    for codes in map("".join, itertools.product("suaUox", repeat=n)):
        assert conversations.audit_of(codes) == min(all_audits(codes, 2)), codes


def test_audits_of_some_longer_ones():
    rng = random.Random(5)
    for _ in range(60):
        codes = "".join(rng.choices("suaUAox", [1, 6, 6, 1, 1, 1, 2], k=rng.randint(4, 6)))
        assert conversations.audit_of(codes) == min(all_audits(codes, 1)), codes


def test_blocks_give_what_one_graph_gives():
    rng = random.Random(6)
    for n in (65, 130, 200):
        codes = "".join(rng.choices("suaUAox", [1, 9, 9, 1, 1, 1, 2], k=n))
        exits = conversations.block(codes, [0, None, None, None], 0)
        best = min(exits[q] for q in (0, 3))
        assert conversations.long_audit(codes) == (best // (4 * 5**n), conversations.letters(best % 5**n, n))


def plain_repair(rows):
    """The contract, read once more: rows (conv, turn, role, text) to the result rows."""
    by, seen = defaultdict(list), []
    for conv, turn, role, text in rows:
        if conv not in by:
            by[conv] = []
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        codes, faults, known = "", Counter(), set()
        for _, role, text in own:
            initial = role[:1] if role[:1] and role[:1] in "sua" else "o"
            if not text.strip(BLANKS):
                faults["blank"] += 1
                codes += "x"
            elif (role, text) in known:
                faults["duplicate"] += 1
                codes += "x"
            elif text.strip(BLANKS)[-1] not in ".!?":
                faults["truncated"] += 1
                codes += initial.upper()
            else:
                codes += initial
            known.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = min(all_audits(codes, 1))
        out, at = [], 0
        for letter in audit:
            _, role, text = own[at]
            at += 1
            if letter != "D":
                after = out[-1][0][0] if out else ""
                out.append((role if letter == "K" else "assistant" if after == "u" else "user", text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        seen.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return seen


CONVERSATION = "conv_id long, turn long, role string, text string, head string, copy int, dropped_at int"


def conversation_rows(seed: int = 8):
    rng, rows = random.Random(seed), []
    for conv in range(70):
        for turn in range(rng.randint(1, 5)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.8 else rng.choice(["system", "tool", "", None, "user", "Üser"])
            text = rng.choice(["Yes.", "No!", "Why? ", "cut off", " \t", None, "", "Ärger.\n", "the same.", f"words {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "None at all."), (100, 5, "user", "Twice."), (100, 5, "user", "Twice."), (101, None, "user", "x" * 300_000 + "."), (101, None, "assistant", "ok.")]
    rows += [(conv, 0, "user", "dropped.") for conv in range(200, 260)]
    return rows


def test_repair_is_what_the_contract_says(spark):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "h", 1, 2) for r in rows], CONVERSATION).repartition(3)
    damaged = conversations.damage(df)
    found, out = conversations.repair(damaged)
    got = conversations.digests(damaged, found)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_repair(rows), key=repr)
    texts = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: r.at):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for r in got.collect():
        assert hashlib.sha256("\n".join(texts[r.conv_id]).encode()).hexdigest() == r.repaired_sha256
    assert {r.repaired_sha256 for r in got.filter("audit = ''").collect()} == {hashlib.sha256().hexdigest()}


def test_conversations_of_an_empty_table_and_long_ones(spark):
    none = spark.createDataFrame([], CONVERSATION)
    assert conversations.digests(none, conversations.audits(none)).count() == 0
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i}." if i % 50 else "cut") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one = conversations.audits(df).first()
    codes = "".join(("u", "a")[i % 2] if i % 50 else ("U", "A")[i % 2] for i in range(3000))
    assert (one.cost, one.audit) == conversations.long_audit(codes) and len(one.audit) == 3000 and set(one.audit) <= set("DKR")


# packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_numbers_are_the_library_s(tokenizer):
    rng = random.Random(3)
    ids = packing.Ids(tokenizer.to_str())
    alphabet = ["a", "B", "é", "ß", "ª", "²", "½", "7", "'s", "'T", "'ll", " ", "  ", "\n", "\t", "\x85", "\xa0", "\x1c", " ", " ", "…", "“", "_", "-", "$", "日本", "ا", "Ⅷ", "①", "é", "🙂", "<|endoftext|>", "<|", "it's", " don't"]
    for _ in range(800):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert list(memoryview(ids.encode(text)).cast("I")) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_text_in_parts_is_the_text(tokenizer, monkeypatch):
    ids, text = packing.Ids(tokenizer.to_str()), "the cat's  hat.\n\n é" * 300
    whole = ids.encode(text)
    monkeypatch.setattr(packing, "PART", 7)
    assert ids.encode(text) == whole


def spent(found, demand):
    used = np.zeros_like(demand)
    for pattern, times in found:
        assert sum(length * n for length, n in pattern) < len(demand)
        for length, n in pattern:
            used[length] += n * times
    return used


def best_fit(demand):
    """Best fit in decreasing order, piece by piece."""
    free = []
    for length in range(len(demand) - 1, 0, -1):
        for _ in range(int(demand[length])):
            room = [f for f in free if f >= length]
            gap = min(room) if room else len(demand) - 1
            if room:
                free.remove(gap)
            free.append(gap - length)
    return len(free)


def test_patterns_hold_every_piece_in_few_sequences():
    rng = np.random.default_rng(4)
    for trial in range(12):
        capacity = int(rng.choice([7, 20, 60]))
        demand = rng.integers(0, 30, capacity + 1) * (rng.random(capacity + 1) < rng.choice([0.2, 0.6, 1.0]))
        demand[0] = 0
        found, bound = packing.patterns(demand)
        assert (spent(found, demand) == demand).all()
        total = sum(times for _, times in found)
        assert bound - 1e-6 <= total <= max(best_fit(demand) + 1, 1.03 * bound)


def test_the_bound_is_below_the_best_packing():
    demand = np.zeros(11, np.int64)
    demand[[6, 7]] = [5, 4]  # none of these fit together
    found, bound = packing.patterns(demand)
    assert sum(n for _, n in found) == 9 and bound <= 9 + 1e-9


def check_packed(rows, texts, tokenizer, capacity):
    """Every document whole, every sequence gapless."""
    spans, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for places in spans.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(places)) and sum(places[-1]) <= capacity
    want = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[doc_id, n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((d, *p) for d, ps in by_doc.items() for p in ps) == want


def test_packing_is_whole(spark, docs, none, tokenizer):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for capacity in (64, 2048):
        got = packing.pack(docs, path, ["doc_id"], capacity)
        assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        rows = got.collect()
        check_packed(rows, texts, tokenizer, capacity)
        sequences = len({r.sequence_id for r in rows})
        assert sequences <= 1.02 * -(-sum(r.length for r in rows) // capacity) + 1
    assert packing.pack(none, path, ["doc_id"]).count() == 0


def test_a_length_that_most_pieces_have(spark, tokenizer):
    rows = [(i, "") for i in range(500)] + [(None, None)] * 3 + [(7, "a b c")] * 5 + [(8, "word " * 90_000 + "🙂")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("number", F.lit(1)).repartition(7)
    check_packed(packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], 128).collect(), rows, tokenizer, 128)


# resampling


def test_crc_of_spans_of_any_length():
    rng = random.Random(1)
    data = np.frombuffer(rng.randbytes(70_000), np.uint8)
    spans = [(a := rng.randrange(50_000), a + rng.choice([1, 2, 63, 64, 65, 128, 129, 191, 192, 1000, 19_999])) for _ in range(400)]
    got = resample.crc_spans(data, np.array([a for a, _ in spans]), np.array([b for _, b in spans]))
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in spans]
    assert len(resample.crc_spans(data, np.array([], int), np.array([], int))) == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]).encode() for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, known):
    bucket = lambda f: zlib.crc32(f) % known.buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    b, all_s, all_t = known.buckets, sum(s.values()), sum(t.values())
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (all_s + b) / ((s[k] + 1) * (all_t + b)))) for k in set(s) | set(t)}
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{known.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    near = sorted((r for r in rows if r[5] >= known.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(near[: len(near) * known.percent // 100]):
        row[4] = rank + 1
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("percent", [5, 50, 100])
def test_resampling_is_what_the_contract_says(spark, docs, percent):
    known = resample.Settings(percent=percent)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(["日本語 を 話す " * 20, "x" * 5000 + " y", "A-b_c'd 1,000", "ÄÖ Ä ö", "\x00 \x7f", "w " * 40_000])]
    target = [rows[3][1], "One two THREE", None, "", "日本語 を"]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash")).withColumn("row", F.lit("clash")).repartition(4)
    got = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), known)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target, known)


def test_resampling_of_nothing(spark, none, docs):
    assert resample.resample(none, docs).count() == 0
    short = spark.createDataFrame([(1, "too short"), (None, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_features, r.rank) for r in resample.resample(short, none).collect()} == {(1, 3, None), (None, 0, None)}


def test_one_row_many_times(spark):
    rows = [(5, "the same long row " * 10)] * 300 + [(i, f"another row {i} " * 10) for i in range(100)]
    got = resample.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(rows[:1], "doc_id long, text string"), resample.Settings(percent=60)).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 241)) and len(got) == 400
