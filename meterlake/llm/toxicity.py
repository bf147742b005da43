"""Toxicity by a weighted finite-state pattern grammar.

Clauses are scored, not words. A first transducer, a trie over words, reads a clause and writes one symbol per word: the
set of classes that end there, of insult, threat, target, negation and report. Threats, negations and reports are
phrases of one to four words. Insults are words and stems learned from labelled rows, with weights, beside a fixed list.

Further transducers read the symbols and multiply the insults and threats by weights that depend on what stands around them:

* negation: for a few words after a negation both count less;
* report: after a phrase of reported speech, and in a clause with quotation marks, both count less;
* aim: an insult within a few words of a target counts more;
* address: a threat counts only where a target follows.

Each is a table of states, arcs and weights; those that read a clause forwards are composed once into one table, those that
read it backwards into another, and a clause is one run over each. Its score is the sum of its weighted insults and
threats. A text's score is the sum over its clauses, put through a logistic function fitted on the same labelled rows.

Null and empty texts score as a text without an insult. Rows that repeat are scored alike; an id that is labelled twice,
also with contradicting labels, gives two rows to learn from. Other columns are not read. Without labelled rows of both
classes, also in empty tables, the fixed lists and an untrained logistic function decide. Texts are scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import reader, staged, uniform

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")
QUOTED = re.compile(r"[\"“”„«»]")

# Seed words of the classes, in the languages of the corpus.
INSULTS = "idiot moron stupid scum trash loser pathetic worthless disgusting clown dumb imbecile fool scumbag jerk bastard idiota imbécil estúpido basura idiote imbécile stupide ordure dumm abschaum vollidiot widerlich".split()
THREATS = "kill hurt destroy murder beat strangle burn matar golpear destruir tuer frapper détruire töten schlagen vernichten umbringen".split() + [
    "beat up", "burn down", "come after", "find out where", "make sure that", "voy a matar", "voy a por", "vas a pagar", "vais te tuer", "vais tuer", "vas payer", "werde dich töten", "bringe dich um", "mach dich fertig",
]
TARGETS = "you your yours youre u he she they them him her this these tu te toi vous votre usted ustedes ellos du dich dir euch ihr sie".split()
NEGATIONS = "not no never neither nor isn aren wasn don doesn nicht kein keine nie niemals pas jamais nunca jamás tampoco".split() + [
    "by no means", "not at all", "in no way", "anything but", "far from", "auf keinen fall", "ganz und gar nicht", "pas du tout", "en aucun cas", "para nada", "de ninguna manera",
]
REPORTS = "said says say wrote writes claimed claims reported quoted called sagte schrieb behauptete dit écrit affirme dijo escribió afirma".split() + [
    "according to", "as reported by", "in the words of", "so called", "laut", "wie es heißt", "selon", "d après", "soi disant", "según", "en palabras de", "así llamado",
]


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000
    """Labelled rows that the lexicon and the logistic function are fitted on, in expectation: a bounded sample."""
    surprise: float = 14.0
    """Least number of toxic texts with a word or stem, times the logarithm of how rare toxic texts are: such a run is no chance."""
    min_odds: float = 3.0
    """Log odds from which a word or stem is an insult."""
    stems: tuple[int, ...] = (4, 5, 6)
    seed_weight: float = 3.0
    negated: float = 0.6
    negation_scope: int = 3
    reported: float = 0.7
    targeted: float = 1.3
    target_reach: int = 4
    threat: float = 3.0
    threshold: float = 0.3
    seed: int = 31


@dataclass
class Grammar:
    settings: Settings = field(default_factory=Settings)
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    slope: float = 1.5
    offset: float = -3.0

    def insult(self, word: str) -> float:
        weight = self.words.get(word, 0.0)
        for n in self.settings.stems:
            if len(word) >= n:
                weight = max(weight, self.stems.get(word[:n], 0.0))
        return weight


INSULT, THREAT, TARGET, NEGATION, REPORT = 1, 2, 4, 8, 16
SYMBOLS = 32
#: The trie: (state, word) to state; and the classes of the phrases that end in a state.
TRIE: dict[tuple[int, str], int] = {}
ENDS: dict[int, int] = {}
#: The longest word of each threat; a text without any of these and without an insult has no score.
THREATENING: set[str] = set()
for _phrases, _class in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
    for _phrase in _phrases:
        _at = 0
        for _word in _phrase.split():
            _at = TRIE.setdefault((_at, _word), len(TRIE) + 1)
        ENDS[_at] = ENDS.get(_at, 0) | _class
        if _class == THREAT:
            THREATENING.add(max(_phrase.split(), key=len))


@dataclass(frozen=True)
class Machine:
    """A deterministic weighted transducer over symbols, as tables by state and symbol."""

    starts: tuple[int, ...]
    """The state that a plain clause begins in, and a quoted one."""
    arcs: list[list[int]]
    insults: list[list[float]]
    threats: list[list[float]]

    def run(self, symbols: list[int], quoted: bool) -> list[tuple[float, float]]:
        """What each symbol's insult and threat are multiplied by."""
        state, out = self.starts[quoted], []
        for symbol in symbols:
            out.append((self.insults[state][symbol], self.threats[state][symbol]))
            state = self.arcs[state][symbol]
        return out


def machine(states: int, starts: tuple[int, int], arc: Callable[[int, int], int], insult: Callable[[int, int], float], threat: Callable[[int, int], float]) -> Machine:
    table = [[f(q, x) for x in range(SYMBOLS)] for f in (arc, insult, threat) for q in range(states)]
    return Machine(starts, *(table[i * states : (i + 1) * states] for i in range(3)))


def composed(a: Machine, b: Machine) -> Machine:
    """The machine that does what both do: pairs of states, of those that are reached, and products of weights."""
    known: dict[tuple[int, int], int] = {}
    todo = [pair for pair in zip(a.starts, b.starts, strict=True)]
    arcs, insults, threats = [], [], []
    for pair in todo:  # grows
        if pair not in known:
            known[pair] = len(known)
            p, q = pair
            arcs.append([(a.arcs[p][x], b.arcs[q][x]) for x in range(SYMBOLS)])
            insults.append([a.insults[p][x] * b.insults[q][x] for x in range(SYMBOLS)])
            threats.append([a.threats[p][x] * b.threats[q][x] for x in range(SYMBOLS)])
            todo += arcs[-1]
    return Machine(tuple(known[pair] for pair in zip(a.starts, b.starts, strict=True)), [[known[pair] for pair in row] for row in arcs], insults, threats)


def parts(s: Settings) -> tuple[list[Machine], list[Machine]]:
    """The single machines, those that read forwards and those that read backwards."""

    def after(bit: int, reach: int, fades: bool) -> Callable[[int, int], int]:
        return lambda q, x: reach if x & bit else max(0, q - 1) if fades else q

    def near(bit: int, factor: float) -> Callable[[int, int], float]:
        return lambda q, x: factor if q or x & bit else 1.0

    def one(q: int, x: int) -> float:
        return 1.0

    negated, reported = near(NEGATION, s.negated), near(REPORT, s.reported)
    negation = machine(s.negation_scope + 1, (0, 0), after(NEGATION, s.negation_scope, True), negated, negated)
    report = machine(2, (0, 1), after(REPORT, 1, False), reported, reported)
    aim = machine(s.target_reach + 1, (0, 0), after(TARGET, s.target_reach, True), near(TARGET, s.targeted), one)
    address = machine(2, (0, 0), after(TARGET, 1, False), one, lambda q, x: float(q))
    return [negation, report, aim], [aim, address]


def grammar_of(s: Settings) -> tuple[Machine, Machine]:
    """The machines that read forwards, composed, and those that read backwards."""
    forwards, backwards = parts(s)
    return reduce(composed, forwards), reduce(composed, backwards)


class Tagger(dict):
    """Insult weight of each word; 0 for most."""

    LIMIT = 300_000

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.forwards, self.backwards = grammar_of(grammar.settings)

    def __missing__(self, word: str) -> float:
        weight = self.grammar.insult(word)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = weight
        return weight

    def symbols(self, words: list[str]) -> list[int]:
        """Classes at each word, a phrase's at its last one: of phrases the longest, and no other within it."""
        out = [INSULT if self[word] else 0 for word in words]
        at = 0
        while at < len(words):
            state, end, classes, step = 0, at + 1, 0, at
            while step < len(words) and (state := TRIE.get((state, words[step]), -1)) >= 0:
                step += 1
                if state in ENDS:
                    end, classes = step, ENDS[state]
            out[end - 1] |= classes
            at = end
        return out


def clause_score(words: list[str], quoted: bool, tagger: Tagger) -> float:
    symbols = tagger.symbols(words)
    before = tagger.forwards.run(symbols, quoted)
    behind = reversed(tagger.backwards.run(symbols[::-1], quoted))
    threat = tagger.grammar.settings.threat
    total = 0.0
    for word, symbol, (insult_a, threat_a), (insult_b, threat_b) in zip(words, symbols, before, behind, strict=True):
        if symbol & INSULT:
            total += tagger[word] * insult_a * insult_b
        if symbol & THREAT:
            total += threat * threat_a * threat_b
    return total


def text_score(text: str, tagger: Tagger) -> float:
    """Sum of the scores of the clauses that hold an insult or a threat."""
    low, total = text.lower(), 0.0
    words = set(WORD.findall(low))
    if not any(map(tagger.__getitem__, words)) and THREATENING.isdisjoint(words):
        return 0.0
    for clause in CLAUSE.split(low):
        words = WORD.findall(clause)
        if any(map(tagger.__getitem__, words)) or not THREATENING.isdisjoint(words):
            total += clause_score(words, bool(QUOTED.search(clause)), tagger)
    return total


def probability(total: float, grammar: Grammar) -> float:
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, grammar.slope * math.log1p(total) + grammar.offset))))


def _features(stems: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in reader(batches):
            by = (Counter(), Counter())
            for toxic, text in zip(batch.column("toxic").to_pylist(), found, strict=True):
                words = set(WORD.findall((text or b"").decode("utf-8", "replace").lower()))
                by[toxic].update({(0, w) for w in words} | {(1, w[:n]) for w in words for n in stems if len(w) >= n})
            for toxic, counts in enumerate(by):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic] * len(counts), pa.int32()), pa.array([k for k, _ in counts], pa.int32()), pa.array([w for _, w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["toxic", "kind", "item", "n"],
                )

    return run


def learned_from(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``text, toxic`` of a bounded sample of labelled rows.

    The ids are drawn by hash and written before any text is touched, so that the texts meet a table of about
    ``sample`` ids, whose size Spark then knows, instead of all labels; the texts drawn are written once.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)")
    share = min(1.0, settings.sample / max(1, known.count()))
    ids = staged(known.filter(uniform(settings.seed, F.col("id")) < share), "toxic-ids")
    return staged(docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id")).select("text", "toxic").filter("text is not null"), "toxic-texts")


def fit(sample: DataFrame, settings: Settings = Settings()) -> Grammar:
    """Fit on rows with ``text`` and ``toxic`` (0 or 1; rows with another label are ignored). All of them are read, three times."""
    sample = sample.select("text", F.col("toxic").cast("int").alias("toxic")).filter("text is not null and toxic in (0, 1)")
    grammar = Grammar(settings, dict.fromkeys(INSULTS, settings.seed_weight))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return grammar
    toxic_share = (F.col("toxics") + 0.5) / (sizes[1] + 1)
    clean_share = (F.col("cleans") + 0.5) / (sizes[0] + 1)
    found = (
        sample.mapInArrow(_features(settings.stems), "toxic int, kind int, item string, n long")
        .groupBy("kind", "item").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxics"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("cleans"))
        .filter(F.col("toxics") * math.log(sum(sizes.values()) / sizes[1]) >= settings.surprise)
        .withColumn("odds", F.log(toxic_share) - F.log(clean_share)).filter(F.col("odds") >= settings.min_odds)
        .select("kind", "item", "odds")
    )
    for kind, item, odds in found.toLocalIterator():
        lexicon = grammar.stems if kind else grammar.words
        lexicon[item] = max(lexicon.get(item, 0.0), float(odds))
    points = score(sample, grammar, ["toxic"]).select("total", "toxic").groupBy(F.round("total", 2).alias("total"), "toxic").agg(F.count("*").alias("n")).toPandas()
    grammar.slope, grammar.offset = logistic(np.log1p(points["total"].to_numpy()), points["toxic"].to_numpy(float), points["n"].to_numpy(float))
    return grammar


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (not below 0) and offset by Newton's steps, with a ridge so that separable rows give finite values."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - ridge * beta * [1, 0]
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([ridge, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])), float(beta[1])


def score(docs: DataFrame, grammar: Grammar, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``total`` (sum over clauses), ``score`` and ``predicted`` of every row; null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    schema = docs.select(*keep).schema.add("total", "double").add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        tagger = Tagger(known)
        for batch, found in reader(batches, "__text"):
            totals = [text_score(t.decode("utf-8", "replace"), tagger) if t else 0.0 for t in found]
            scores = [probability(t, known) for t in totals]
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(totals, pa.float64()), pa.array(scores, pa.float64()), pa.array([int(s >= known.settings.threshold) for s in scores], pa.int32())],
                names=schema.names,
            )

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)
