"""A corpus pipeline: toxic texts out, repeated lines out, near copies out, test items out, then a mix.

Each stage takes the documents the one before it kept and returns the columns of ``documents``; the
last one returns the mix with sizes, targets and copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm import decontamination, line_dedup, minhash_dedup, mixing, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language; an unknown language has 0.7."""
    docs = docs.select(*COLUMNS)
    net = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).filter(~F.col("flagged")).select(*COLUMNS)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later occurrences of three-line windows removed and n_chars counted anew."""
    out = line_dedup.remove_repeated_lines(docs.select(*COLUMNS))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*COLUMNS)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the least id, of each group of near copies: five-word shingles, similarity
    of 0.8 or more."""
    docs = docs.select(*COLUMNS)
    return minhash_dedup.keep_one(docs, words=5, percent=80).select(*COLUMNS)


def remove_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``."""
    return decontamination.decontaminate(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and copies."""
    return mixing.mix(docs.select(*COLUMNS)).filter("copies > 0")


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", remove_lines),
    ("near dedup", remove_copies),
    ("decontamination", remove_test_items),
    ("mixing", mix_sources),
]

# The first stage is a trained classifier, which SQL cannot express; see tests/llm for brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
