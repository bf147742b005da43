"""Registered queries of the numbered operators: each over its whole table, in the form of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import conversations, decontaminate, jaccard, language, mixing, packing, pii, quality, resample, substrings, tokens, toxicity, warc
from meterlake.llm.common import held_out, shipped, staged, table
from meterlake.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

VOCABULARY = "word_bpe_49k.json"
PACKING_VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 2048


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return language.identify(marked, docs.filter(~held_out(F.col("doc_id"))), ["doc_id", "held_out"])


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), ["doc_id"], TOKEN_LIMIT)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"), ["doc_id"]).drop("masked")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), 20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = jaccard.join_near(table(spark, sf_dir, "documents"), jaccard.Settings(words=3, percent=90))
    return near.select("doc_id", "n_shingles", "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    learn = toxicity.learned_from(docs, labels)
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return toxicity.score(marked, toxicity.fit(learn), ["doc_id", "held_out"]).drop("total")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.digests(damaged, staged(conversations.audits(damaged), "audits"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_VOCABULARY), ["doc_id"], TOKEN_LIMIT)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: shipped(f)
    for f in (op1_decontamination, op2_language, op3_tokens, op4_pii, op5_substrings, op6_jaccard, op7_quality, op8_toxicity, op9_mixing, op10_warc, op11_conversations, op12_packing, op13_resampling)
}
