"""Operators on single texts: language, tokens, personal data, quality, toxicity."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.data import documents, prose
from meterlake.llm import language, pii, quality, tokens, toxicity

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
COUNTS = tokens.Counts(LIBRARY, tokens.proven(LIBRARY))


def test_language(spark, docs, none):
    got = {r.doc_id: r for r in language.identify(docs, docs, ["doc_id"]).collect()}
    assert all(got[i].lang_pred == ("en", "fr", "de")[i % 3] for i in range(60))
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (85, 86, 87, 90))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(none, docs, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language.identify(docs, none, ["doc_id"]).collect()} == {"und"}


def test_backoff_asks_shorter_grams_only_when_longer_ones_are_unknown():
    known = language.Settings(order=3)
    model = language.Model(["a", "b"], {}, {"<xy": np.array([9, 1]), "x": np.array([1, 9])}, known)
    assert model.backoff("xyz").argmax() == 0
    assert model.backoff("zx").argmax() == 1
    assert not model.backoff("qqq").any()


def test_language_on_held_out_rows(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 20, lang), lang) for i, lang in enumerate(["en", "fr", "de"] * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(frame.filter("doc_id >= 90"), frame.filter("doc_id < 90"), ["doc_id", "lang"])
    assert got.filter("lang <> lang_pred").count() == 0


ODD = ["", "ΟΔΟΣ Σ ΣΑΣ", "İstanbul", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x85z w", "don't I'LL we'Re", "①②三 4٣", "日本語テキスト", "é é", "ﬁ ﬀ", "😀😀 a😀b", "​zero‍", "!!''s'", "ß ẞ", "a b　c", "\x00\x01a", "'S'T", "½²Ǆ", "<|"]


@pytest.mark.parametrize("text", ODD)
def test_tokens_of_odd_texts(text):
    assert COUNTS.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_tokens_of_any_text(text):
    assert COUNTS.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_token_counts(docs, none):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, VOCABULARY, ["doc_id"], 100).collect())
    want = Counter()
    for d in documents():
        n = len(LIBRARY.encode(d[1] or "", add_special_tokens=False).ids)
        want[d[0], len((d[1] or "").encode()), n, n > 100] += 1
    assert got == want
    assert tokens.count_tokens(none, VOCABULARY, ["doc_id"], 100).count() == 0


PLAIN = {0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 2: r"[0-9]([\x20-]?[0-9])+", 3: r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            n = len(pii.digits_of(m[0]))
            fits = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 14 <= n <= 19 and pii.luhn(pii.digits_of(m[0])), 10 <= n <= 15)
            if fits[kind]:
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="a1.@-+ 45()%_é\n", max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "found", "kind"),
    [
        ("mail joe (at) example [dot] com now", "joe (at) example [dot] com", "email"),
        ("write to joe at example dot com please", "joe at example dot com", "email"),
        ("jоhn@exаmple.com!", "jоhn@exаmple.com", "email"),
        ("ｊｏｅ＠example．com", "ｊｏｅ＠example．com", "email"),
        ("call plus one five five five one two three four five six seven.", "plus one five five five one two three four five six seven", "phone"),
        ("card 4539 one four eight eight zero three four three six four six seven ok", "4539 one four eight eight zero three four three six four six seven", "card"),
        ("host one nine two dot one six eight dot zero dot one up", "one nine two dot one six eight dot zero dot one", "ip"),
        ("4​539148803436467", "4​539148803436467", "card"),
    ],
)
def test_disguises_map_back_to_the_source(text, found, kind):
    spans = pii.added_spans(text, pii.base_spans(text))
    assert [(text[a:b], pii.KINDS[k]) for a, b, k in spans] == [(found, kind)]
    assert pii.masked(text, spans) == text.replace(found, f"<{kind.upper()}>")


@pytest.mark.parametrize(
    ("text", "found", "kind"),
    [
        ("call +1 415 five five five 2671", "+1 415 five five five 2671", "phone"),
        ("call +1 415 555 26 seven one", "+1 415 555 26 seven one", "phone"),
        ("host 192 dot 168 dot 10 dot 5", "192 dot 168 dot 10 dot 5", "ip"),
        ("host 10.0.0 . five", "10.0.0 . five", "ip"),
        ("write john@example dot com", "john@example dot com", "email"),
    ],
)
def test_disguises_with_few_signs(text, found, kind):
    assert [(text[a:b], pii.KINDS[k]) for a, b, k in pii.added_spans(text, pii.base_spans(text))] == [(found, kind)]


PIECES = ["one", "Two", "five", "oh", "double ", "plus ", "1", "42", " dot ", "dot", " at ", "@", ".", " . ", "-", ", ", " ", "(", ")", "[at]", "john", "com", "x", "\n", "é", "ſix"]


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=24).map("".join))
def test_gate_never_hides_what_a_transducer_changes(text):
    glyphs = pii.unglyph(pii.Tape(text))
    changed = any(tape.text != text for tape in (glyphs, pii.undigit(glyphs), pii.unat(glyphs)))
    assert pii.disguised(text) or not changed


@pytest.mark.parametrize("text", ["look at the dot matrix", "he is at home. Then dot", "one two three four", "the one and two of them at noon", "a@b", ""])
def test_clean_texts_get_no_span(text):
    assert pii.base_spans(text) + pii.added_spans(text, []) == []


def test_personal_data_of_all_rows(docs, none):
    rows = pii.detect(docs, ["doc_id"], with_text=True).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in documents())
    assert {r.masked for r in rows if r.doc_id == 86} == {None}
    assert pii.detect(none, ["doc_id"]).count() == 0


def statistics_by_hand(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside))


def test_statistics(spark, docs):
    rng = random.Random(4)
    more = [(1000 + i, "".join(rng.choice(["a ", "b ", "é\n", "# ", "|", "\t"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter(tuple(r) for r in quality.statistics(frame, ["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    assert got == Counter((d, *statistics_by_hand(t)) for d, t in [r[:2] for r in documents()] + more)


def test_quality(spark, docs, none):
    rows = quality.judge(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in documents())
    assert all(not r.kept for r in rows if r.base_failed)
    assert {r.doc_id for r in rows if r.base_failed} >= {83, 84, 85, 86, 87, 88, 90}
    assert quality.judge(none).count() == 0


def test_outliers_are_rejected_and_others_kept(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(60, 200)), "en", "a" if i % 3 else None) for i in range(400)]
    rows += [(1000 + i, prose(rng, 100).replace(" ", "### "), "en", "a") for i in range(12)]
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i] for i in range(12))
    assert sum(not got[i] for i in range(400)) == 0


def test_chi_squared():
    assert quality.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality.chi2_cdf(4.3515, 5) == pytest.approx(0.5, abs=1e-4)


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(rng, 60).split(" ")
        if i % 4 == 0:
            words[rng.randrange(60)] = rng.choice(["idiot", "zurgh", "blaffa", "blaffo"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_toxicity_on_held_out_rows(spark, docs, none):
    learn = spark.createDataFrame(toxic_rows(400, 1), "doc_id long, text string, toxic int")
    grammar = toxicity.fit(learn)
    test = spark.createDataFrame(toxic_rows(200, 2), "doc_id long, text string, toxic int")
    assert toxicity.score(test, grammar, ["toxic"]).filter("toxic <> predicted").count() == 0
    rows = toxicity.score(docs, grammar, ["doc_id"]).collect()
    assert len(rows) == len(documents())
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, grammar, ["doc_id"]).count() == 0
    assert toxicity.fit(none.withColumn("toxic", F.lit(1))).words["idiot"] > 0


def test_composed_machines_are_the_single_ones():
    rng = random.Random(4)
    known = toxicity.Settings(negation_scope=2, target_reach=3)
    for single, whole in zip(toxicity.parts(known), toxicity.grammar_of(known), strict=True):
        for _ in range(300):
            symbols, quoted = [rng.choice([0, 0, 0, rng.randrange(toxicity.SYMBOLS)]) for _ in range(rng.randint(0, 25))], rng.random() < 0.3
            each = [m.run(symbols, quoted) for m in single]
            product = [(math.prod(i for i, _ in at), math.prod(t for _, t in at)) for at in zip(*each, strict=True)]
            assert np.allclose(np.array(whole.run(symbols, quoted)).ravel(), np.array(product).ravel())


def plain_clause(words, quoted, tagger):
    """The rules of the grammar, looked up around each word."""
    s, symbols, total = tagger.grammar.settings, tagger.symbols(words), 0.0
    has = lambda i, bit: 0 <= i < len(symbols) and symbols[i] & bit
    for i, word in enumerate(words):
        factor = s.negated if any(has(j, toxicity.NEGATION) for j in range(i - s.negation_scope, i + 1)) else 1.0
        factor *= s.reported if quoted or any(has(j, toxicity.REPORT) for j in range(i + 1)) else 1.0
        if has(i, toxicity.INSULT):
            aimed = [any(has(j, toxicity.TARGET) for j in around) for around in (range(i - s.target_reach, i + 1), range(i, i + s.target_reach + 1))]
            total += tagger[word] * factor * s.targeted ** sum(aimed)
        if has(i, toxicity.THREAT) and any(has(j, toxicity.TARGET) for j in range(i + 1, len(words))):
            total += s.threat * factor
    return total


def test_clauses_against_their_rules():
    rng = random.Random(5)
    tagger = toxicity.Tagger(toxicity.Grammar(words={"idiot": 4.0, "scum": 2.5}))
    pool = "idiot scum you he kill not by no means said according to so called voy a matar beat up one two three four five six".split()
    for _ in range(2000):
        words, quoted = rng.choices(pool, k=rng.randint(0, 14)), rng.random() < 0.2
        assert toxicity.clause_score(words, quoted, tagger) == pytest.approx(plain_clause(words, quoted, tagger))


def test_phrases_are_longest_and_whole():
    tagger = toxicity.Tagger(toxicity.Grammar())
    assert tagger.symbols("by no means no".split()) == [0, 0, toxicity.NEGATION, toxicity.NEGATION]
    assert tagger.symbols("te voy a matar tu".split()) == [toxicity.TARGET, 0, 0, toxicity.THREAT, toxicity.TARGET]
    assert tagger.symbols("far from far".split()) == [0, toxicity.NEGATION, 0]


def test_labelled_rows_are_drawn_by_id(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1000)] + [(None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)] + [(3, 0), (None, 1), (5, None), (7, 9)], "doc_id long, toxic int")
    assert toxicity.learned_from(docs, labels).count() == 1001  # one id twice, with both labels
    few = toxicity.learned_from(docs, labels, toxicity.Settings(sample=100)).collect()
    assert 50 < len(few) < 160 and all(r.toxic in (0, 1) for r in few)
    assert toxicity.learned_from(docs.limit(0), labels).count() == 0 == toxicity.learned_from(docs, labels.limit(0)).count()


def test_number_signs_are_no_letters(spark):
    rows = [(i, text) for i, text in enumerate(["½", "①②③", "² Ⅷ", "a½", "12 ½ x"])]
    learn = spark.createDataFrame([("the cat and the dog", "en"), ("a x the", "en")] * 5, "text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), learn, ["doc_id"]).collect()}
    assert got == {0: "und", 1: "und", 2: "und", 3: "en", 4: "en"}


def test_clauses_not_words():
    tagger = toxicity.Tagger(toxicity.Grammar(words={"idiot": 4.0}))
    score = lambda text: toxicity.text_score(text, tagger)
    assert score("you are an idiot") > score("an idiot came") > score("not an idiot") > 0
    assert score("an idiot came") > score("he said an idiot came. fine") - 4 * 0.31
    assert score("they said an idiot") < score("they saw an idiot")
    assert score("I will kill you") > 0 == score("I kill time") == score("")
