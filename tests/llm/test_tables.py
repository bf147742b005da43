"""Operators on whole tables: leaks, mixture, archives, the pipeline, and the registered queries."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import zstandard as zstd
from pyspark.sql import functions as F

import corpus_pipeline
from llm.data import SCHEMA, documents, prose
from meterlake.llm import decontaminate, mixing, warc
from meterlake.llm.queries import QUERIES, SQL
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice([b"x", b"y", b"z"]) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, p in enumerate(a):
            for j, q in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if p == q else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == table[-1][-1]


def leak_case(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, 30 + i, "en")) for i in range(12)] + [(50, None), (51, ""), (52, "..."), (53, prose(rng, 30, "fr"))]
    rows = [(i, prose(rng, 150, "en")) for i in range(40)]
    for i in range(12):  # whole, with other punctuation, and paraphrased
        words = items[i][1].split(" ")
        rows.append((100 + i, " ".join([prose(rng, 50), items[i][1], prose(rng, 200)])))
        rows.append((200 + i, " ".join([prose(rng, 90), items[i][1].replace(".", " ;").upper(), prose(rng, 20)])))
        for k in rng.sample(range(len(words) - 12), len(words) // 7):
            words[k] = "foo"
        rows.append((300 + i, " ".join([prose(rng, 33), *words, prose(rng, 20)])))
    rows += [(400, None), (401, ""), (None, items[0][1]), (402, "short"), (402, "short")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash")), spark.createDataFrame(items, "item_id long, text string"), items


def test_items_of_any_script_are_found(spark):
    items = ["Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива", "μῆνιν ἄειδε θεὰ Πηληϊάδεω Ἀχιλῆος οὐλομένην", "吾輩は猫である。名前はまだ無い。", "كان يا ما كان في قديم الزمان ملك"]
    rows = [(i, f"{prose(random.Random(i), 30)} {text} и еще") for i, text in enumerate(items)] + [(9, "彼は「吾輩は猫である。名前はまだ無い。」と書いた"), (10, prose(random.Random(10), 60))]
    benchmark = spark.createDataFrame([*enumerate(items), (7, "。、 !"), (8, None)], "item_id long, text string")
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(4)} | {(9, 2)}


def reworded(rng, words, answer):
    """Every other word or so replaced, neighbours swapped here and there, the answer as it is."""
    out = [w if rng.random() < 0.58 else f"syn{rng.randrange(9999)}" for w in words]
    for k in rng.sample(range(len(out) - 1), 2):
        out[k], out[k + 1] = out[k + 1], out[k]
    return " ".join(out) + ". " + " ".join(answer)


def test_paraphrases_that_only_the_latent_search_finds(spark):
    rng = random.Random(31)
    some = lambda n, tag="w": [f"{tag}{rng.randrange(4000)}" for _ in range(n)]
    parts = [(i, some(36), some(5)) for i in range(60)]
    items = [(i, " ".join(words) + ". " + " ".join(answer)) for i, words, answer in parts]
    rows = [(i, " ".join([*some(rng.randint(20, 90), "f"), reworded(rng, words, answer), *some(rng.randint(20, 90), "f")])) for i, words, answer in parts]
    rows += [(1000 + i, " ".join([*some(60, "f"), *rng.sample([w for _, ws, _ in parts for w in ws], 80)])) for i in range(60)]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    known = decontaminate.Settings()
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, benchmark).collect()}
    without = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark, decontaminate.Settings(latent=2.0)).collect()}
    assert all(d == i for d, i in got)  # no text made of many items' words
    below = {pair for pair, r in got.items() if r.sequence < known.paraphrase}
    assert without == set(got) - below and len(below) >= 20
    assert all(r.cosine > 0 and r.answer >= known.answer for r in got.values())
    # of all that has half of its item's words in sequence, by brute force
    half = {i for i, text in rows[:60] if decontaminate.common_subsequence(decontaminate.words_of(items[i][1].encode()), decontaminate.words_of(text.encode())) >= 21}
    assert len(half & {d for d, _ in got}) >= 0.9 * len(half)


@pytest.mark.parametrize("n", [200, 2000, pytest.param(20_000, marks=pytest.mark.skipif(not os.environ.get("METERLAKE_ALL"), reason="two minutes"))])
def test_recall_does_not_fall_with_the_number_of_items(spark, n):
    rng = random.Random(n)
    some = lambda k: " ".join(f"w{rng.randrange(30_000)}" for _ in range(k))
    items = [(i, some(rng.randint(20, 60))) for i in range(n)]
    probes = rng.sample(items, 100)
    rows = [(i, " ".join([some(rng.randint(0, 90)), text, some(rng.randint(0, 90))])) for i, text in probes]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), decontaminate.Settings(power_steps=0))
    assert {r.doc_id for r in got.filter("doc_id = item_id and sequence = 1").collect()} == {i for i, _ in probes}


def test_no_whole_copy_is_lost_among_many_items(spark):
    rng = random.Random(21)
    some = lambda n: " ".join(f"w{rng.randrange(6000)}" for _ in range(n))
    items = [(i, some(600 if i % 50 == 0 else 40)) for i in range(1000)]
    rows = [(i, " ".join([some(rng.randint(0, 90)), text, some(rng.randint(0, 90))])) for i, text in items]
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got.filter("doc_id = item_id and sequence = 1").count() == len(items)


def test_candidates_lose_nothing_that_brute_force_finds():
    rng = random.Random(22)
    known = decontaminate.Settings(stretch=64)
    items = [(i, prose(rng, rng.choice([1, 3, 8, 20, 40, 120]))) for i in range(60)]
    used = np.unique([decontaminate.feature(w, known) for _, t in items for w in decontaminate.words_of(t.encode())])
    idf = np.array([rng.random() + 0.1 for _ in range(known.features)])
    index = decontaminate.index_of(items, idf, used, rng.random() * np.ones((len(used), 4), np.float32), known)
    found = 0
    for _ in range(60):
        words = decontaminate.words_of(prose(rng, 300).encode())
        for copied in rng.sample(index.words, 3):  # with words lost and put in between
            kept = [w for w in copied if rng.random() > 0.25]
            at = rng.randrange(len(words))
            words[at:at] = [x for w in kept for x in ([w, b"new"] if rng.random() < 0.1 else [w])]
        want = set()
        for item, wanted in enumerate(index.words):
            n, short = len(wanted), len(wanted) < known.min_words
            for start in range(0, len(words), known.span):
                here = words[max(0, start - n) : start + 2 * max(known.span, n)]
                share = decontaminate.common_subsequence(wanted, here) / n
                answered = sum(w in here for w in index.answers[item]) / len(index.answers[item])
                if share >= (1.0 if short else known.near) or not short and share >= known.paraphrase and answered >= known.answer:
                    want.add(item)
        assert set(decontaminate.search(words, index, known)) == want
        found += len(want)
    assert found > 100


def test_leaks_are_found_and_clean_documents_left(spark, none):
    docs, benchmark, items = leak_case(spark)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == {(100 * k + i, i) for i in range(12) for k in (1, 2, 3)} | {(None, 0)}
    blocks = decontaminate.leaks(docs, benchmark, decontaminate.Settings(block=5))
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == got
    assert decontaminate.leaks(none, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_exponent_meets_entropy_and_repeats(spark):
    tokens = {"a": 8000, "b": 900, "c": 90, "d": 10}
    shares = spark.createDataFrame([(k, v / 9000) for k, v in tokens.items()], "source string, share double")

    def by_hand(a):
        z = sum((v / 9000) ** a for v in tokens.values())
        w = [(v / 9000) ** a / z for v in tokens.values()]
        return -sum(x * math.log(x) for x in w) / math.log(4), max(x / (v / 9000) for x, v in zip(w, tokens.values(), strict=True))

    a = mixing.exponent(shares, mixing.Settings(entropy=0.8, repeats=1e9))
    assert by_hand(a)[0] == pytest.approx(0.8, abs=1e-6)
    b = mixing.exponent(shares, mixing.Settings(entropy=1.0, repeats=5))
    assert by_hand(b)[1] == pytest.approx(5, abs=1e-4)
    assert mixing.exponent(shares, mixing.Settings(entropy=0.01)) == 1.0


def test_mixture_spends_each_budget(spark, docs, none):
    rows = [(i, prose(random.Random(i), 5 + i % 30), "en", "big" if i % 10 else ("small" if i % 20 else None)) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("block", F.lit("clash"))
    s = mixing.Settings(entropy=0.9, repeats=8, block_tokens=500)
    got = mixing.mix(frame, s).collect()
    size = {i: len(t.split()) for i, t, _, _ in rows}
    total = sum(size.values())
    spent, uses = defaultdict(int), Counter((r.doc_id, r.epoch) for r in got)
    assert max(uses.values()) == 1
    for r in got:
        assert r.n_tokens == size[r.doc_id] and 0 <= r.slot < 1
        spent[r.source] += r.n_tokens
    weight = {r.source: r.weight for r in got}
    assert sum(weight.values()) == pytest.approx(1)
    for source, w in weight.items():
        assert 0 <= spent[source] - round(w * total) <= 35
    # all passes but the last are whole, and passes differ in order
    small = [r for r in got if r.source == "small"]
    last = max(r.epoch for r in small)
    assert last >= 1
    ids = lambda e: [r.doc_id for r in sorted(small, key=lambda r: r.slot) if r.epoch == e]
    assert sorted(ids(0)) == [i for i, _, _, s in rows if s == "small"]
    assert ids(0)[: len(ids(1))] != ids(1)
    assert got == mixing.mix(frame, s).collect() or Counter(got) == Counter(mixing.mix(frame, s).collect())
    assert mixing.mix(none).count() == 0
    assert {r.doc_id for r in mixing.mix(docs, s).collect()} <= {d[0] for d in documents()}


def pages(spark):
    rows = [(i, f"http://x/{i}", f"<html>{i % 7}" + "é" * (i % 3)) for i in range(60)]
    rows += [(60, None, None), (61, "http://y\r\nEvil: 1", ""), (62, "u", "<p>\r\n\r\nWARC/1.1\r\n" + "z" * 200_000), (None, "n", "<html>only"), (63, "r", "twice"), (63, "r", "twice"), (64, "s", "twice")]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string")


def test_archives(spark):
    rows, frame = pages(spark)
    got = warc.round_trip(frame).collect()
    assert all(r.problem is None for r in got)
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
    texts = {i: html or "" for i, _, html in rows}
    for r in got:
        payload = texts[r.page_id].encode()
        top = last[texts[r.page_id]]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        response = r.page_id == top or r.page_id is None
        assert r.record_type == ("response" if response else "revisit")
        assert r.refers_to == (None if response else top)
        assert bytes(r.payload) == (payload if response else b"")
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_archives_are_zstandard_files(spark, folder):
    _, frame = pages(spark)
    warc.write(frame.repartition(2), str(folder / "out"))
    for path in (folder / "out").glob("part-*"):
        content = path.read_bytes()
        size = int.from_bytes(content[4:8], "little")
        assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_FRAME
        dictionary = zstd.ZstdCompressionDict(content[8 : 8 + size], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        whole = zstd.ZstdDecompressor(dict_data=dictionary).stream_reader(content[8 + size :], read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\nWARC-Type") == len(list(warc.frames(content)))


def one(problem_of, data):
    frame = zstd.ZstdCompressor().compress(data)
    return [warc.parse(d)[2] if d is not None else p for d, p in warc.frames(problem_of(frame))]


def test_damage_is_reported():
    good = warc.record(1, "u", b"abc", warc.digest32(b"abc"), None, False)
    whole = lambda f: f
    assert one(whole, good) == [None]
    assert one(lambda f: f + f, good) == [None, None]
    assert "cut off" in one(lambda f: f[:-3], good)[0]
    assert "frame" in one(lambda f: f + b"garbage!!", good)[1]
    assert "Content-Length" in one(whole, good.replace(b"Content-Length: 3", b"Content-Length: 4"))[0]
    assert "digest" in one(whole, good.replace(b"abc", b"abd"))[0]
    assert "missing" in one(whole, good.replace(b"WARC-Date", b"Else"))[0]
    assert one(whole, b"junk")[0] == "no WARC header"
    assert list(warc.frames(b"")) == []


def test_pipeline_stages(spark, docs, folder):
    _, benchmark, items = leak_case(spark)
    benchmark.write.parquet(str(folder / "benchmark.parquet"))
    leak = spark.createDataFrame([(500, prose(random.Random(2), 40) + " " + items[3][1], "en", "s0", 1, "b", "c", 1, "g", 1), (501, "mail me at@home.example.org " + prose(random.Random(3), 40), "en", "s0", 1, "b", "c", 1, "g", 1)], SCHEMA)
    docs.unionByName(leak).write.parquet(str(folder / "documents.parquet"))
    now = spark.read.parquet(str(folder / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(folder))
        now.write.parquet(str(folder / name))
        now = spark.read.parquet(str(folder / name))
        seen.append({r.doc_id for r in now.select("doc_id").collect()})
        if name != "mixture":
            assert now.columns == corpus_pipeline.COLUMNS
    language, near, clean, masked, mixed = seen
    assert language == {d[0] for d in documents()} - {85, 86, 87, 90} | {500, 501}
    assert near & set(range(60, 80)) == {60} and not near & {80, 81, 82} and near >= set(range(60)) | {500, 501}
    assert near - clean == {500} and masked == clean and mixed <= clean
    text = spark.read.parquet(str(folder / "personal_data")).filter("doc_id = 501").first()
    assert "<EMAIL>" in text.text and "@" not in text.text and text.n_chars == len(text.text)
    assert corpus_pipeline.run(spark, str(folder)).count() == now.count()


def test_rows_that_share_an_id_or_have_none_stand_for_themselves(spark, folder):
    _, benchmark, items = leak_case(spark)
    benchmark.write.parquet(str(folder / "shared" / "benchmark.parquet"))
    rng = random.Random(31)
    texts = [prose(rng, 60) for _ in range(12)]
    leak = texts[0] + " " + items[3][1]
    rows = [(None, t) for t in texts[:5]] + [(7, t) for t in texts[5:8]] + [(None, leak), (7, texts[9] + " " + items[4][1])]
    rows += [(None, texts[1]), (7, texts[6]), (6, texts[7]), (None, texts[7]), (None, ""), (None, None), (8, texts[10]), (8, texts[10])]
    docs = spark.createDataFrame([(d, t, "en", f"s{i % 2}", 1) for i, (d, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    near = corpus_pipeline.keep_one_of_near(spark, docs, str(folder / "shared"))
    want = Counter(set(rows) - {(7, texts[7]), (None, texts[7])})
    assert Counter((r.doc_id, r.text) for r in near.collect()) == want
    clean = corpus_pipeline.drop_leaks(spark, docs, str(folder / "shared"))
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r in rows if r[1] not in (leak, rows[9][1]))


#: The columns that each query has to return, with their types, and the table of which it returns every row's key once.
CONTRACTS = {
    "op1_decontamination": ("doc_id bigint, item_id bigint", None),
    "op2_language": ("doc_id bigint, held_out boolean, lang_pred string, score double", "documents"),
    "op3_tokens": ("doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", "documents"),
    "op4_pii": ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", "documents"),
    "op5_substrings": ("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string", "documents"),
    "op6_jaccard": ("doc_id bigint, n_shingles bigint, component_id bigint", "documents"),
    "op7_quality": ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean", "documents"),
    "op8_toxicity": ("doc_id bigint, held_out boolean, score double, predicted int", "documents"),
    "op9_mixing": ("doc_id bigint, source string", None),
    "op10_warc": ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint", "pages"),
    "op11_conversations": ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string", "conversations"),
    "op12_packing": ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint", "documents"),
    "op13_resampling": ("doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint", "documents"),
}


@pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")
@pytest.mark.parametrize("name", list(QUERIES))
def test_registered_query_keeps_its_contract(spark, name):
    out = QUERIES[name](spark, SF)
    columns, source = CONTRACTS[name]
    types = dict(out.dtypes)
    assert {c: types.get(c) for c, _ in map(str.split, columns.split(", "))} == dict(map(str.split, columns.split(", ")))
    key = columns.split(" ")[0]
    got = Counter(r[0] for r in out.select(key).collect())
    assert got
    if source:
        rows = [r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()]
        assert set(got) == set(rows)
        if name != "op12_packing":
            assert got == (Counter(set(rows)) if source == "conversations" else Counter(rows))


@pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")
@pytest.mark.parametrize("name", list(SQL))
def test_registered_query_matches_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None
