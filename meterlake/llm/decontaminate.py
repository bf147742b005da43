"""Benchmark decontamination: latent semantic retrieval, an exact word-count filter, and the longest common subsequence.

Benchmark passages are weighted by TF-IDF (document frequencies over all documents) and reduced by a randomised singular
value decomposition that Spark computes over the passages: a random range, power steps, and the small factor; its rank
follows the number of items. Every document is cut into overlapping windows of about the items' lengths, and the
items whose cosine with a window is high in that space are candidates: these are paraphrases, which may lack so many of
the item's words, or have them in another order, that no count of words finds them.

No fixed rank tells many items apart, so a second path loses no copy however many items there are: a stretch that has most
of an item's words lacks at most a known number of them, so of the item's rarest words, taken that number and a few
more, at least those few must stand there, which an inverted list over these words finds. The candidates are the union.

All are checked by the longest common subsequence of words and by the item's answer words, in windows that follow the
item's length: a large part in sequence is a leak by itself, a smaller one where the answer is there too, and a part that is
smaller still where the cosine is high besides. The benchmark is the stated query set; it is searched in blocks of
bounded size against all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import reader

FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
SENTENCE = re.compile(r"[.!?\n。！？]+")
# Scripts that put no space between words: each of their letters is a word.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
PAUSE = re.compile("[\u3000-\u3004\u3008-\u3020\u30fb\uff01-\uff0f\uff1a-\uff20]")


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 16
    """Hashed words; bounds every matrix that is shared."""
    spare: float = 0.125
    """Share of an item's words that are indexed beyond those a leak may lack; a stretch needs as many of the indexed words."""
    rank: int = 64
    """Dimensions of the latent space at least; an eighth of the items beyond that, up to four times as many."""
    oversample: int = 8
    power_steps: int = 2
    span: int = 32
    """Words between the starts of windows; a window has twice these or twice the item's words, whichever is more."""
    stretch: int = 4096
    """Words of a document that are looked up together."""
    near: float = 0.8
    """Share of an item's words in the common subsequence that is a leak by itself."""
    paraphrase: float = 0.65
    """Share that is a leak where the answer's words are there too."""
    latent: float = 0.75
    """Cosine from which an item is a candidate."""
    reworded: float = 0.5
    """Share in sequence that is a leak where the cosine is ``latent`` and the answer's words are there too."""
    latent_words: int = 12
    """Items with fewer words are too short for a cosine to tell anything."""
    answer: float = 0.8
    min_words: int = 5
    """Items with fewer words must occur whole."""
    block: int = 20_000
    """Items that are searched together."""
    seed: int = 7


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-case words; whatever is ASCII and neither letter nor digit separates them, and so does East Asian punctuation."""
    if not text:
        return []
    if not text.isascii():
        lower = text.decode("utf-8", "replace").lower()
        if UNSPACED.search(lower):
            lower = UNSPACED.sub(r" \g<0> ", PAUSE.sub(" ", lower))
        text = lower.encode()
    return text.translate(FOLD).split()


def feature(word: bytes, settings: Settings) -> int:
    return zlib.crc32(word) % settings.features


def answer_of(text: str) -> list[bytes]:
    """Words of the last sentence that has any."""
    return next((w for s in reversed(SENTENCE.split(text)) if (w := words_of(s.encode()))), [])


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, by bit vectors: one step per word of ``b``."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for word in b:
        if word in places and (hit := row & places[word]):
            row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def frequencies(docs: DataFrame, vocabulary: frozenset[bytes], settings: Settings) -> tuple[np.ndarray, int]:
    """Number of documents that hold each feature of the vocabulary, over all documents, and their number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, n = shared.value, Counter(), 0
        for batch, found in reader(batches):
            n += batch.num_rows
            for text in found:
                counts.update({feature(w, settings) for w in known.intersection(words_of(text))})
        counts[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["f", "n"])

    out, total = np.zeros(settings.features), 0
    for f, n in docs.select("text").mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        if f < 0:
            total = n
        else:
            out[f] = n
    return out, total


def passage_rows(words: list[bytes], idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and normalised weights of a passage."""
    counts = Counter(feature(w, settings) for w in words)
    ids = np.fromiter(counts, np.int64, len(counts))
    weights = np.fromiter(counts.values(), np.float64, len(counts)) * idf[ids]
    norm = np.linalg.norm(weights)
    return ids, weights / norm if norm else weights


def decompose(passages: DataFrame, idf: np.ndarray, used: np.ndarray, rank: int, settings: Settings) -> np.ndarray:
    """Right singular vectors of the passages' TF-IDF matrix, used features by rank, by a randomised range finder.

    Each step multiplies the matrix's Gram matrix with a thin matrix: every task adds up its passages' part, Spark sums
    the parts by block of features, and the driver only keeps the thin matrix, whose size is fixed by the settings.
    """
    spark, width = passages.sparkSession, min(rank + settings.oversample, len(used))
    rng = np.random.default_rng(settings.seed)
    step = 1024

    def gram(thin: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((idf, used, thin.astype(np.float32)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own_idf, own_used, own_thin = shared.value
            parts: dict[int, np.ndarray] = {}
            for _, found in reader(batches):
                for text in found:
                    ids, weights = passage_rows(words_of(text), own_idf, settings)
                    ids = np.searchsorted(own_used, ids)
                    seen = weights @ own_thin[ids]
                    for block in np.unique(ids // step):
                        here = ids // step == block
                        part = parts.setdefault(int(block), np.zeros((step, width)))
                        part[ids[here] % step] += weights[here, None] * seen
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([p.tobytes() for p in parts.values()], pa.binary())], names=["block", "part"])

        def add(pdf):
            total = sum(np.frombuffer(p).reshape(step, width) for p in pdf["part"])
            return pdf.head(1).assign(part=[total.tobytes()])

        out = np.zeros((-(-len(used) // step) * step, width))
        summed = passages.mapInArrow(run, "block int, part binary").groupBy("block").applyInPandas(add, "block int, part binary")
        for block, part in summed.toLocalIterator():
            out[block * step : (block + 1) * step] = np.frombuffer(part).reshape(step, width)
        shared.destroy()
        return out[: len(used)]

    thin = rng.standard_normal((len(used), width))
    for _ in range(settings.power_steps + 1):
        thin, _ = np.linalg.qr(gram(thin))
    small = thin.T @ gram(thin)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return (thin @ vectors[:, np.argsort(values)[::-1][:rank]]).astype(np.float32)


@dataclass
class Index:
    """What a task needs to search one block of items."""

    ids: list
    words: list[list[bytes]]
    sets: list[set[bytes]]
    answers: list[list[bytes]]
    latent: np.ndarray
    rows: dict[bytes, int]
    matrix: np.ndarray
    starts: np.ndarray
    """Where the list of each word begins in ``lists``."""
    lists: np.ndarray
    """Items that are indexed by a word, word after word."""
    least: np.ndarray
    """Places with indexed words of an item that a stretch needs to leak it."""
    reach: np.ndarray
    """Words of the stretch in which an item is looked for: a window and the item's length before it."""
    classes: list[tuple[int, np.ndarray]]
    """Lengths of windows for the latent search, each with the items that are looked for in them."""


def rank_of(items: int, settings: Settings) -> int:
    return min(4 * settings.rank, max(settings.rank, items // 8))


def wanted_words(n: int, settings: Settings) -> int:
    """How many of an item's n words a leak has in sequence at least."""
    return n if n < settings.min_words else math.ceil(min(settings.near, settings.paraphrase) * n - 1e-9)


def window_of(n: int, settings: Settings) -> int:
    return 2 * max(settings.span, n)


def index_of(items: list[tuple], idf: np.ndarray, used: np.ndarray, basis: np.ndarray, settings: Settings) -> Index:
    """An item stands in the index by its rarest words, so many that no leak can do without ``least`` of them."""
    words = [words_of(text.encode()) for _, text in items]
    vocabulary = sorted({w for ws in words for w in ws})
    rows = {w: i for i, w in enumerate(vocabulary)}
    features = np.array([feature(w, settings) for w in vocabulary], np.int64)
    weights = idf[features]
    matrix = (basis[np.searchsorted(used, features)] * weights[:, None]).astype(np.float32)
    latent = np.stack([matrix[[rows[w] for w in ws]].sum(axis=0) for ws in words])
    norms = np.linalg.norm(latent, axis=1, keepdims=True)
    owners, least = [], []
    for item, ws in enumerate(words):
        lacking, counts, held = len(ws) - wanted_words(len(ws), settings), Counter(rows[w] for w in ws), 0
        for row in sorted(counts, key=lambda r: (-weights[r], r)):
            if held >= lacking + max(1, settings.spare * len(ws)):
                break
            owners.append((row, item))
            held += counts[row]
        least.append(held - lacking)
    by_row, lists = np.array(sorted(owners), np.int64).T
    reach = np.array([len(ws) + window_of(len(ws), settings) for ws in words])
    sizes = np.array([max(settings.span, 1 << (len(ws) - 1).bit_length()) if len(ws) >= settings.latent_words else 0 for ws in words])
    classes = [(int(size), np.flatnonzero(sizes == size)) for size in np.unique(sizes[sizes > 0])]
    return Index(
        [i for i, _ in items], words, [set(ws) for ws in words], [answer_of(text) for _, text in items], latent / np.maximum(norms, 1e-9), rows, matrix,
        np.searchsorted(by_row, np.arange(len(vocabulary) + 1)), lists, np.array(least), reach, classes,
    )


def candidates(rows: np.ndarray, index: Index, settings: Settings) -> set[tuple[int, int]]:
    """Items and starts of windows that hold enough of the item's indexed words; no other window can leak the item."""
    out: set[tuple[int, int]] = set()
    known = np.flatnonzero(rows >= 0)
    first, last = index.starts[rows[known]], index.starts[rows[known] + 1]
    known, first, sizes = known[last > first], first[last > first], (last - first)[last > first]
    for begin in range(0, len(rows), settings.stretch):
        a, b = np.searchsorted(known, [begin, begin + settings.stretch + int(index.reach.max())])
        if a == b:
            continue
        n = sizes[a:b]
        shift = np.repeat(first[a:b] - (np.cumsum(n) - n), n)
        items, at = index.lists[np.arange(len(shift)) + shift], np.repeat(known[a:b], n)
        enough = (np.bincount(items, minlength=len(index.least)) >= index.least)[items]
        items, at = items[enough], at[enough]
        order = np.argsort(items, kind="stable")  # places stay in order within an item
        items, at = items[order], at[order]
        end = np.arange(len(items)) + index.least[items] - 1
        inside = np.flatnonzero(end < len(items))
        inside = inside[(items[end[inside]] == items[inside]) & (at[end[inside]] - at[inside] < index.reach[items[inside]])]
        for i in inside:
            item, length = int(items[i]), len(index.words[items[i]])
            low = max(0, (int(at[end[i]]) - window_of(length, settings)) // settings.span + 1)
            high = min(int(at[i]) + length, len(rows) - 1) // settings.span
            out.update((item, w * settings.span) for w in range(low, high + 1))
    return out


def latent_candidates(rows: np.ndarray, index: Index, settings: Settings) -> set[tuple[int, int]]:
    """Items and starts of windows whose cosine in the latent space reaches ``latent``.

    A window is a difference of two running sums of its words' vectors, so windows of every length cost one row each.
    """
    out: set[tuple[int, int]] = set()
    longest = max((size for size, _ in index.classes), default=0)
    all_known = np.flatnonzero(rows >= 0)
    for begin in range(0, len(rows) if longest else 0, settings.stretch):
        known = all_known[slice(*np.searchsorted(all_known, [begin, begin + settings.stretch + longest]))]
        sums = np.zeros((len(known) + 1, index.matrix.shape[1]), np.float32)
        np.cumsum(index.matrix[rows[known]], axis=0, out=sums[1:])
        starts = np.arange(begin, min(begin + settings.stretch, len(rows)), settings.span)
        firsts = np.searchsorted(known, starts)
        for size, items in index.classes:
            lasts = np.searchsorted(known, starts + size)
            full = np.flatnonzero(lasts - firsts >= settings.reworded * settings.latent_words)
            windows = sums[lasts[full]] - sums[firsts[full]]
            lengths = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            cosines = windows @ index.latent[items].T
            at, which = np.nonzero(cosines >= settings.latent * np.maximum(lengths, 1e-6)[:, None])
            out.update(zip(items[which].tolist(), starts[full[at]].tolist(), strict=True))
    return out


def search(words: list[bytes], index: Index, settings: Settings) -> dict[int, tuple[float, float, float]]:
    """For each item that the words leak: cosine, share of its words in sequence, share of its answer's words."""
    get = index.rows.get
    rows = np.array([get(w, -1) for w in words])
    out: dict[int, tuple[float, float, float]] = {}
    latent = latent_candidates(rows, index, settings)
    for item, start in sorted(candidates(rows, index, settings) | latent):
        wanted = index.words[item]
        begin, end = max(0, start - len(wanted)), start + window_of(len(wanted), settings)
        here = words[begin:end]
        held = index.sets[item].intersection(here)
        near = (item, start) in latent
        least = math.ceil(settings.reworded * len(wanted)) if near else wanted_words(len(wanted), settings)
        # the common subsequence cannot be longer than the places of the item whose words are here
        if sum(w in held for w in wanted) < least:
            continue
        short = len(wanted) < settings.min_words
        answered = sum(w in held for w in index.answers[item]) / len(index.answers[item])
        share = common_subsequence(wanted, here) / len(wanted)
        enough = settings.reworded if near else settings.paraphrase
        if share >= (1.0 if short else settings.near) or not short and share >= enough and answered >= settings.answer:
            own = rows[start : start + window_of(len(wanted), settings)]
            window = index.matrix[own[own >= 0]].sum(axis=0)
            found = (float(window @ index.latent[item] / max(np.linalg.norm(window), 1e-9)), share, answered)
            out[item] = max(out.get(item, found), found, key=lambda f: f[1:])
    return out


def indexes(docs: DataFrame, benchmark: DataFrame, settings: Settings) -> Iterator[Broadcast]:
    """The index of each block of items, shared with all tasks. Items without a word are in none."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    n_items = items.count()
    blocks = max(1, -(-n_items // settings.block))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()]
        rows = [r for r in rows if words_of(r[1].encode())]
        if not rows:
            continue
        vocabulary = frozenset(w for _, text in rows for w in words_of(text.encode()))
        used = np.unique([feature(w, settings) for w in vocabulary])
        df, n = frequencies(docs, vocabulary, settings)
        idf = np.log((n + 1) / (df + 1)) + 0.1
        yield spark.sparkContext.broadcast(index_of(rows, idf, used, decompose(own, idf, used, rank_of(len(rows), settings), settings), settings))


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id, cosine, sequence, answer``: a row for each document that leaks an item.

    ``cosine`` is that of the item and the window it was found in. Null and wordless texts leak nothing, and items
    without a word are never leaked. Items with equal texts are found together; ties of stretches go to the one with the
    longer sequence, then the more of the answer. Long texts are searched whole, in stretches; an empty table of either
    kind gives no row, and other columns are not read. Repeated rows of a document are each searched and give one row for each item.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out: DataFrame | None = None
    schema = "doc_id long, item_id long, cosine double, sequence double, answer double"
    for shared in indexes(docs, benchmark, settings):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch, found in reader(batches):
                hits = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                    words = words_of(text)
                    if words:
                        hits += [(doc, index.ids[i], *f) for i, f in search(words, index, settings).items()]
                if hits:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*hits, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "cosine", "sequence", "answer"])

        found = docs.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("sequence", "answer", "cosine")).alias("best")).select("doc_id", "item_id", "best.cosine", "best.sequence", "best.answer")


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows that leak no item. Each row is judged by its own text, whatever id it has."""
    out = docs
    for shared in indexes(docs.select("text"), benchmark, settings):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, found in reader(batches):
                yield batch.filter(pa.array([not (words and search(words, shared.value, settings)) for words in map(words_of, found)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
