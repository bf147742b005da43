"""The corpus pipeline: language, near duplicates, benchmark leaks, personal data, mixture.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return the
columns of the table of documents. Columns that a caller's table has beside those are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, jaccard, language, mixing, pii
from meterlake.llm.common import shipped, staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of a language that the corpus is labelled with; texts without a letter and texts between languages go."""
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, docs, COLUMNS)
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, once; texts without words link with none and stay.

    A row is known by its id and text, so different texts that share an id or have none do not stand for each other. Rows
    without an id come after those with one; rows with equal id and text are one, with the smallest other columns.
    """
    docs = docs.select(*COLUMNS)
    near = jaccard.join_near(docs, jaccard.Settings(words=5, percent=80, text_keys=True))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = near.filter("component is not null").groupBy("component").agg(F.min(row).alias("row")).select("row.doc_id", "row.text_key")
    kept = kept.unionByName(near.filter("component is null").select("doc_id", "text_key").distinct())
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    keyed = docs.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    found = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & F.col("key").eqNullSafe(F.col("kept_key")))
    once = found.groupBy("doc_id", "key").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row"))
    return once.select("doc_id", "row.text", "row.lang", "row.source", "row.n_chars")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; each row is judged by its own text."""
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by their kinds."""
    found = pii.detect(docs.select(*COLUMNS), ["doc_id", "lang", "source", "n_chars"], with_text=True)
    text = F.col("masked")
    return found.select("doc_id", text.alias("text"), "lang", "source", F.coalesce(F.length(text).cast("long"), F.col("n_chars").cast("long")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: which document stands where, how often."""
    return mixing.mix(docs.select(*COLUMNS))


STAGES = [
    ("language", shipped(keep_languages)),
    ("near_duplicates", shipped(keep_one_of_near)),
    ("decontamination", shipped(drop_leaks)),
    ("personal_data", shipped(mask_personal)),
    ("mixture", shipped(mix_sources)),
]

#: Models, retrieval and floating-point bisection have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


@shipped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
