"""Quality rules with robust multivariate outliers, in built-in expressions only.

Each text gives a vector of transformed statistics. For every pair of language and source a minimum-covariance-
determinant estimate is made of the vectors: from a start by medians, concentration steps keep the share ``half`` of
rows nearest to the estimate and estimate again from them; a last step takes all rows within a quantile. Rows whose
squared Mahalanobis distance is beyond a quantile are rejected. Pairs with few rows share one estimate with the other
small sources of their language, or with all small ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import staged

SPACE = "[\\x20\\x09-\\x0D]"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
DIMS = 5
VECTOR = [f"x{i}" for i in range(DIMS)]


@dataclass(frozen=True)
class Settings:
    least_rows: int = 100
    """Rows that an estimate needs."""
    half: float = 0.75
    """Share of rows that a concentration step keeps."""
    steps: int = 3
    inner: float = 0.975
    """Quantile within which the last step takes rows."""
    cut: float = 0.99999
    """Quantile beyond which a row is an outlier."""
    floors: tuple[float, ...] = (0.5, 0.06, 0.15, 0.1, 0.05)
    """Least standard deviations: what differs by less is the same, and most texts have no symbol or repeat at all."""
    min_words: int = 10
    max_repeat_percent: int = 20


def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of chi squared with k degrees, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-15:
        n += 1
        term *= half / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What a covariance of the nearest share of a normal sample is to be multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``; a null text has no words."""
    text = F.coalesce(F.col("__text"), F.lit(""))
    step = docs.select(*keep, F.col("text").alias("__text")).select(
        *keep,
        F.array_remove(F.split(text, SPACE + "+"), "").alias("__words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, BLANKS, "")) > 0).alias("__lines"),
    )
    base = [*keep, "word_chars", "n_symbols"]
    step = step.select(
        *base,
        F.size("__words").cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__codes"),
    )
    base += ["n_words", "n_dup_lines"]
    # windows of five words as hashes; where all differ, nothing repeats
    step = step.select(
        *base,
        F.when(
            F.col("n_words") > 4,
            F.transform(
                F.slice("__codes", F.lit(1), F.greatest(F.size("__codes") - 4, F.lit(0))),
                lambda c, i: F.xxhash64(c, *(F.get("__codes", i + k) for k in range(1, 5))),
            ),
        ).otherwise(F.array().cast("array<long>")).alias("__windows"),
    )
    step = step.select(
        *base,
        F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__sorted"),
    )
    step = step.select(
        *base,
        F.array_sort(
            F.transform(
                F.filter("__sorted", lambda p, i: (p["h"] == F.get("__sorted", i - 1)["h"]) | (p["h"] == F.get("__sorted", i + 1)["h"])),
                lambda p: p["i"],
            )
        ).alias("__at"),
    )
    covered = F.transform("__at", lambda p, i: F.least(F.lit(5), F.coalesce(F.get("__at", i + 1) - p, F.lit(5))))
    repeats = F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0)).cast("long")
    return step.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeats.alias("n_repeat_words"))


def vector() -> list[Column]:
    """The transformed statistics; rates are shrunk by a constant so that short texts do not scatter."""
    words = F.col("n_words")
    return [
        F.log1p(words.cast("double")),
        F.log((F.col("word_chars") + 300) / (words + 50)),
        F.log1p(F.lit(5.0) * F.col("n_symbols") / (words + 50)),
        F.log1p(F.lit(10.0) * F.col("n_dup_lines") / (words + 50)),
        F.log1p(F.lit(1.0) * F.col("n_repeat_words") / (words + 50)),
    ]


def groups(rows: DataFrame, settings: Settings) -> DataFrame:
    """``gl, gs, g``: for each language and source the group that its rows are estimated with, null if even the rest of all is small."""
    pairs = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pairs = staged(pairs.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), "n"), "quality-groups")
    langs = pairs.filter(F.col("n") < settings.least_rows).groupBy(F.col("gl").alias("ll")).agg(F.sum("n").alias("m"))
    rest = langs.filter(F.col("m") < settings.least_rows).agg(F.sum("m").alias("r")).first()["r"] or 0
    return pairs.join(langs, F.col("gl").eqNullSafe(F.col("ll")), "left").select(
        "gl", "gs",
        F.when(F.col("n") >= settings.least_rows, F.to_json(F.struct("gl", "gs")))
        .when(F.col("m") >= settings.least_rows, F.to_json(F.struct("gl")))
        .when(F.lit(rest >= settings.least_rows), F.lit("rest")).alias("g"),
    )


def factor(floors: tuple[float, ...], scale: float) -> list[tuple[str, Column]]:
    """The Cholesky factor of the scaled covariance with floors on its diagonal, entry by entry as columns to add in order."""
    entries = []
    for i in range(DIMS):
        for j in range(i + 1):
            inner = F.col(f"c{i}{j}") * scale + (floors[i] ** 2 if i == j else 0.0)
            for k in range(j):
                inner = inner - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            entries.append((f"l{i}{j}", F.sqrt(F.greatest(inner, F.lit(1e-9))) if i == j else inner / F.col(f"l{j}{j}")))
    return entries


def moments(rows: DataFrame, settings: Settings, share: float) -> DataFrame:
    """Per group the mean and the factor of the covariance of the rows, corrected for their being the nearest ``share``."""
    covariances = [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i in range(DIMS) for j in range(i + 1)]
    out = rows.groupBy("g").agg(*(F.avg(x).alias(f"m{i}") for i, x in enumerate(VECTOR)), *covariances)
    for name, entry in factor(settings.floors, consistency(share)):
        out = out.withColumn(name, entry)
    out = out.select(F.col("g").alias("eg"), *(f"m{i}" for i in range(DIMS)), *(f"l{i}{j}" for i in range(DIMS) for j in range(i + 1)))
    return staged(out, "quality-estimates")


def distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with ``d2``, the squared Mahalanobis distance to their group's estimate, by forward substitution."""
    out = rows.join(estimates, F.col("g") == F.col("eg"), "left")
    total = F.lit(0.0)
    for i in range(DIMS):
        z = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return out.withColumn("d2", total).select(*rows.columns, "d2")


def nearest(rows: DataFrame, share: float) -> DataFrame:
    """Rows whose ``d2`` is within the group's quantile, from counts of fine slices of its logarithm: the same in every run."""
    sliced = rows.withColumn("slice", F.floor(F.log(F.col("d2") + 1e-6) * 64))
    counts = sliced.groupBy("g", "slice").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("g").orderBy("slice")
    cuts = counts.select("g", "slice", F.coalesce(F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"), F.sum("n").over(Window.partitionBy("g")).alias("all"))
    cuts = cuts.filter(F.col("below") < share * F.col("all")).groupBy("g").agg(F.max("slice").alias("last")).withColumnRenamed("g", "cg")
    cuts = staged(cuts, "quality-cuts")  # one row per group, so that no join gathers a group's rows by its key
    return sliced.join(cuts, F.col("g") == F.col("cg")).filter("slice <= last").select(*rows.columns)


def start(rows: DataFrame, settings: Settings) -> DataFrame:
    """Centre and spread by counts: the rows nearest to the group's middle, coordinate by coordinate."""
    middles = rows.groupBy("g").agg(*(F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"q{i}") for i, x in enumerate(VECTOR)))
    middles = staged(middles.withColumnRenamed("g", "mg"), "quality-middles")
    terms = [F.pow((F.col(x) - F.col(f"q{i}")[1]) / F.greatest(F.lit(settings.floors[i]), (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349), 2) for i, x in enumerate(VECTOR)]
    return rows.join(middles, F.col("g") == F.col("mg")).withColumn("d2", sum(terms[1:], terms[0])).select(*rows.columns, "d2")


def judge(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, the statistics, ``base_failed``, ``kept``, ``distance``.

    ``base_failed`` marks texts with fewer words than ``min_words`` or with more than ``max_repeat_percent`` of them in
    repeated windows. The others are rejected if their squared distance is beyond the quantile ``cut``; estimates are
    made from them alone. ``distance`` is null for failed rows and for rows without an estimate, which are kept. A null
    language or source is a value like any other; repeated rows are judged alike.
    """
    own = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    rows = statistics(own, ["doc_id", "lang", "source"])
    failed = (F.col("n_words") < settings.min_words) | (100 * F.col("n_repeat_words") > settings.max_repeat_percent * F.col("n_words"))
    rows = staged(rows.withColumn("base_failed", failed), "quality-statistics")
    own_group = F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs"))
    live = rows.filter("not base_failed").select("*", *(c.alias(x) for c, x in zip(vector(), VECTOR, strict=True)))
    live = staged(live.join(groups(live, settings), own_group).drop("gl", "gs", "lang", "source"), "quality-vectors")
    vectors = live.filter("g is not null").select("g", *VECTOR)
    near = nearest(start(vectors, settings), settings.half)
    for _ in range(settings.steps):
        estimates = moments(near, settings, settings.half)
        near = nearest(distance(vectors, estimates), settings.half)
    estimates = moments(near, settings, settings.half)
    inner = distance(vectors, estimates).filter(F.col("d2") <= chi2_quantile(settings.inner, DIMS))
    estimates = moments(inner, settings, settings.inner)

    judged = distance(live, estimates).unionByName(rows.filter("base_failed"), allowMissingColumns=True)
    inside = F.coalesce(F.col("d2") <= chi2_quantile(settings.cut, DIMS), F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), F.sqrt("d2").alias("distance"),
    )
