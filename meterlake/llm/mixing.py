"""Mixing of sources by temperature.

A source's weight is its share of tokens raised to an exponent and normalised. Exponent 1 keeps the corpus as it is, 0
gives every source the same. The exponent is found by bisection: the largest at which the weights reach a target
entropy, but not so small that a source would be repeated more often than a limit allows.

Weights become rows by block permutations. Each pass over a source ("epoch") visits its blocks in an order of its own,
and the documents of a block in an order of their own; the last pass ends in the block in which the source's budget of
tokens ends. Blocks are small, so no step sorts a whole source in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import staged, uniform



@dataclass(frozen=True)
class Settings:
    entropy: float = 0.97
    """Target entropy as a part of the largest possible, the logarithm of the number of sources."""
    repeats: float = 4.0
    """Passes over a source that the weights may ask for."""
    budget: float = 1.0
    """Tokens of the mixture as a multiple of the corpus's tokens."""
    block_tokens: int = 65_536
    """Tokens of a block, in expectation."""
    grid: int = 17
    rounds: int = 8
    """Each round of the bisection narrows the exponent to one of grid - 1 slices."""
    seed: int = 23


def n_tokens(text: Column) -> Column:
    """Words of a text, as the measure of its tokens; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")), F.lit(0)).cast("long")


def measure(sources: DataFrame, exponents: list[float], settings: Settings) -> list[tuple[float, float, float]]:
    """(exponent, entropy as a part of the largest, most passes over a source) in one pass over the sources' sums."""
    tried = sources.select(F.log("share").alias("logs"), "share", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    top = tried.groupBy("a").agg(F.sum(F.exp(F.col("a") * F.col("logs"))).alias("z"), F.sum(F.exp(F.col("a") * F.col("logs")) * F.col("a") * F.col("logs")).alias("m"), F.max(F.exp((F.col("a") - 1) * F.col("logs"))).alias("r"), F.count("*").alias("k"))
    rows = top.select("a", "k", (F.log("z") - F.col("m") / F.col("z")).alias("h"), (F.lit(settings.budget) * F.col("r") / F.col("z")).alias("passes")).collect()
    return sorted((r["a"], 1.0 if r["k"] == 1 else r["h"] / math.log(r["k"]), r["passes"]) for r in rows)


def exponent(sources: DataFrame, settings: Settings) -> float:
    """The exponent in [0, 1], by bisection over a grid; ``sources`` has one row per source with its ``share``.

    Entropy falls and passes fall as the exponent grows. The result is the largest exponent that reaches the entropy
    (0 if none does), raised to the smallest that keeps the limit of passes (1 if none does). Nothing but the grid's
    measures reaches the driver.
    """

    def search(good, upward: bool) -> float:
        low, high = 0.0, 1.0
        for _ in range(settings.rounds):
            grid = [low + (high - low) * i / (settings.grid - 1) for i in range(settings.grid)]
            marks = [(a, good(h, r)) for a, h, r in measure(sources, grid, settings)]
            if not marks:
                return 1.0
            kept = [i for i, (_, ok) in enumerate(marks) if ok]
            if upward:  # good below some exponent
                if not kept or kept[-1] == len(marks) - 1:
                    return marks[kept[-1]][0] if kept else low
                low, high = marks[kept[-1]][0], marks[kept[-1] + 1][0]
            else:  # good above some exponent
                if not kept or kept[0] == 0:
                    return marks[kept[0]][0] if kept else high
                low, high = marks[kept[0] - 1][0], marks[kept[0]][0]
        return low if upward else high

    slack = 1e-12
    by_entropy = search(lambda h, r: h >= settings.entropy - slack, upward=True)
    by_repeats = search(lambda h, r: r <= settings.repeats + slack, upward=False)
    return max(by_entropy, by_repeats)


def weigh(sizes: DataFrame, settings: Settings) -> DataFrame:
    """One row per source: ``source, tokens, docs, share, exponent, weight, budget, passes``.

    A null source is a source of its own. Sources without tokens have no weight and are left out.
    """
    sums = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")).filter("tokens > 0")
    sums = staged(sums, "mixing-sources")
    total = sums.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    shares = sums.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    a = exponent(shares, settings)
    norm = shares.agg(F.sum(F.pow("share", F.lit(a))).alias("z")).first()["z"] or 1.0
    weighed = shares.withColumn("exponent", F.lit(a)).withColumn("weight", F.pow("share", F.lit(a)) / F.lit(norm))
    return weighed.withColumn("budget", F.round(F.col("weight") * F.lit(settings.budget * total)).cast("long")).withColumn("passes", F.col("budget") / F.col("tokens"))


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mixture: one row for each time a document is used.

    Columns ``doc_id, source, n_tokens, epoch, block, slot, exponent, weight, text_hash``; the last is ``xxhash64`` of the
    text, which with the id finds the row's text again, also where ids are null or shared. ``slot`` in [0, 1) is the place of the
    document in its source's schedule; reading all rows by slot mixes the sources evenly. Documents without a word are
    left out, as they have no tokens to spend. Repeated rows are documents of their own. A document enters the last
    pass when the tokens before it, in that pass's order, are below what is left of the budget; so each source gets its
    budget, over by less than one document.
    """
    seed = settings.seed
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_tokens(F.col("text")).alias("n_tokens"), F.xxhash64("text").alias("fp"))
    sizes = staged(sizes.filter("n_tokens > 0"), "mixing-sizes")
    weights = staged(weigh(sizes, settings), "mixing-weights")

    plan = weights.select(
        F.col("source").alias("s"), "exponent", "weight", F.floor("passes").alias("whole"),
        (F.col("budget") - F.floor("passes") * F.col("tokens")).alias("rest"), "passes",
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / settings.block_tokens)).alias("blocks"), "tokens",
    )
    placed = sizes.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "fp"), F.col("blocks")).cast("long"))
    used = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int"))))
    used = used.filter((F.col("epoch") < F.col("whole")) | (F.col("rest") > 0))

    # where each block begins in each pass of its source, from the blocks' sums
    order = uniform(seed + 1, F.col("epoch"), F.col("block"))
    blocks = used.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("size")).withColumn("turn", order)
    before = Window.partitionBy("source", "epoch").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(F.col("source").alias("bs"), F.col("epoch").alias("be"), F.col("block").alias("bb"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    used = used.join(starts, F.col("source").eqNullSafe(F.col("bs")) & (F.col("epoch") == F.col("be")) & (F.col("block") == F.col("bb"))).drop("bs", "be", "bb")

    inside = Window.partitionBy("source", "epoch", "block").orderBy(uniform(seed + 2, F.col("epoch"), F.col("doc_id"), F.col("fp")), "doc_id", "fp").rowsBetween(Window.unboundedPreceding, -1)
    used = used.withColumn("at", F.col("start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    used = used.filter((F.col("epoch") < F.col("whole")) | (F.col("at") < F.col("rest")))
    slot = (F.col("epoch") * F.col("tokens") + F.col("at")) / (F.col("whole") * F.col("tokens") + F.greatest(F.col("rest"), F.lit(0)) + F.col("n_tokens"))
    return used.select("doc_id", "source", "n_tokens", F.col("epoch").cast("int").alias("epoch"), "block", slot.alias("slot"), "exponent", "weight", F.col("fp").alias("text_hash"))
