"""Language identification by word-first backoff.

A word that the model knows is scored by its log frequency in each language. An unknown word backs off to its character
n-grams: the longest order of which the model knows any gram gives the mean log frequency of those grams, shorter orders
are asked only when a longer one knows none. The language of a text is the one with the largest sum over its words.

The model is fitted on a bounded sample of labelled rows: at most ``sample`` rows per language are expected, drawn by a
hash of the row, so its size does not grow with the corpus. Texts are scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import reader, uniform

WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    sample: int = 2000
    """Rows of each language that the model is fitted on, in expectation."""
    min_word: int = 2
    """Times a word must occur in the sample to be known."""
    min_gram: int = 3
    order: int = 5
    """Length of the longest n-gram; word ends count as a character."""
    smoothing: float = 0.1
    seed: int = 11
    cache: int = 200_000
    """Unknown words that a task remembers."""


NUMBERS = re.compile(r"[^\W\d_a-zß-öø-ɏ]")
"""Candidates for signs that count as alphanumeric without being letters, such as fractions and Roman numerals."""


def words_of(text: bytes | None) -> list[str]:
    """Lower-case runs of letters; number signs are none, so a text of them alone has no word."""
    if not text:
        return []
    low = text.decode("utf-8", "replace").lower()
    if not low.isascii() and (signs := {c for c in NUMBERS.findall(low) if not c.isalpha()}):
        low = low.translate(dict.fromkeys(map(ord, signs), " "))
    return WORDS.findall(low)


def grams_of(word: str, order: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


class Model:
    """Log frequencies of words and n-grams by language."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray], settings: Settings):
        self.langs, self.settings = langs, settings
        self.words, self.word_scores = self._scores(words)
        self.grams, self.gram_scores = self._scores(grams)

    def _scores(self, counts: dict[str, np.ndarray]) -> tuple[dict[str, int], np.ndarray]:
        rows = np.array(list(counts.values()), dtype=np.float64).reshape(len(counts), len(self.langs))
        s = self.settings.smoothing
        totals = rows.sum(axis=0) + s * max(len(counts), 1)
        return {k: i for i, k in enumerate(counts)}, np.log((rows + s) / totals).astype(np.float32)

    def backoff(self, word: str) -> np.ndarray:
        for order in range(self.settings.order, 0, -1):
            known = [i for g in grams_of(word, order) if (i := self.grams.get(g)) is not None]
            if known:
                return self.gram_scores[known].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)


class Scorer(dict):
    """Row of each word in a matrix of scores; an unknown word's row is made when it is first met."""

    def __init__(self, model: Model):
        super().__init__(model.words)
        self.model, self.known = model, len(model.words)
        self.rows = np.zeros((self.known + model.settings.cache + 1, len(model.langs)), np.float32)
        self.rows[: self.known] = model.word_scores

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.model.backoff(word)
        self[word] = at
        return at

    def total(self, words: list[str]) -> np.ndarray:
        if len(self) - self.known > self.model.settings.cache:
            self.clear()
            self.update(self.model.words)
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.rows[at].sum(axis=0, dtype=np.float64)


def _count(langs_at: str, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in reader(batches):
            by: dict[str, Counter] = {}
            for lang, text in zip(batch.column(langs_at).to_pylist(), found, strict=True):
                by.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by.items():
                grams: Counter = Counter()
                for word, n in words.items():
                    for order in range(1, settings.order + 1):
                        for gram in grams_of(word, order):
                            grams[gram] += n
                for kind, counts in ((0, words), (1, grams)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(counts)), pa.array([kind] * len(counts), pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                        names=["lang", "kind", "item", "n"],
                    )

    return run


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows with ``text`` and a non-null ``lang``; rows without a text or a lang are ignored."""
    rows = rows.select(F.col("lang").cast("string").alias("lang"), "text").filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], {}, {}, settings)
    shares = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, settings.sample / n))))
    sample = rows.filter(uniform(settings.seed, F.col("text")) < shares[F.col("lang")])
    counts = (
        sample.mapInArrow(_count("lang", settings), "lang string, kind int, item string, n long")
        .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
        .groupBy("kind", "item").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("n"))
        .filter(F.col("n") >= F.when(F.col("kind") == 0, settings.min_word).otherwise(settings.min_gram))
        .select("kind", "item", "by")
    )
    langs = sorted(sizes)
    items: tuple[dict, dict] = ({}, {})
    for kind, item, by in counts.toLocalIterator():
        items[kind][item] = np.array([by.get(lang, 0) for lang in langs], np.float32)
    return Model(langs, *items, settings)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score``, of every row.

    ``lang_pred`` is a language of the model, ``und`` for a null text, a text without a letter, or a model without
    languages; ties go to the language that sorts first. ``score`` is the posterior of the predicted language, its log
    odds divided by the square root of the number of words, as words are not independent; 0 for ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scorer = Scorer(known)
        for batch, found in reader(batches, "__text"):
            langs, scores = [], []
            for text in found:
                words = words_of(text)
                if not words or not known.langs:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = scorer.total(words)
                best = int(total.argmax())
                langs.append(known.langs[best])
                scores.append(float(1 / np.exp((total - total[best]) / np.sqrt(len(words))).sum()))
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def identify(docs: DataFrame, learn_from: DataFrame, keep: list[str], settings: Settings = Settings()) -> DataFrame:
    return predict(docs, fit(learn_from, settings), keep)
