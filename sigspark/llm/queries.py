"""Registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    ball_tree,
    common,
    decontamination,
    license_scan,
    line_dedup,
    merkle,
    minhash_dedup,
    mixing,
    pii,
    run_length_dedup,
    substring_dedup,
    token_files,
    tokens,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn, sql: str | None = None):
    QUERIES[fn.__name__] = fn
    if sql is not None:
        ORACLES[fn.__name__] = sql
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector."""
    vectors = table(spark, folder, "embeddings").withColumn("v", ball_tree.whole_components())
    return ball_tree.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


query(op1_exact_topk, ball_tree.SQL)


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document; labels of held-out rows are never learnt."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    net = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, net).select(
        "doc_id",
        F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "flagged",
    )


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents contain."""
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of each document."""
    docs = table(spark, folder, "documents").select("doc_id", "source", mixing.word_count().alias("words"))
    out = mixing.mix(docs, F.col("words"))
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups: three-word shingles, similarity of 0.85 or more."""
    out = minhash_dedup.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words outside every repeated 35-word window."""
    out = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without later occurrences of three-line windows."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


query(op7_line_dedup, line_dedup.SQL.format(docs="documents"))


@query
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in lines, paragraphs and whole texts."""
    return license_scan.scan(table(spark, folder, "documents"))


@query
def op9_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes outside every repeated 200-byte string."""
    out = run_length_dedup.remove_repeated_bytes(table(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and places of personal data."""
    found = pii.find(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(name: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(k.name) for k in pii.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.notation(base), 256).alias("base_sha256"),
        pii.notation(F.col("spans")).alias("spans"),
    )


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, rated by the whole corpus."""
    paths = [tokens.vocabulary_path(name) for name in (tokens.BYTE_BPE, tokens.PIECE_BPE)]
    digests = common.store(alignment.align(table(spark, folder, "documents"), *paths, digest=True))
    rated = alignment.rate(digests, alignment.pair_counts(digests))
    return rated.withColumn("n_links", F.col("n_groups")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document proved in the manifest; where 5 divides the id's crc32, with a changed text."""
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    proofs = merkle.audit(docs, tampered)
    return proofs.withColumn("proof_sha256", F.sha2(merkle.proof_text(), 256)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


query(op12_merkle_manifest, merkle.SQL)


@query
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, written to token files and read back."""
    path = token_files.new_folder(spark)
    token_files.write(table(spark, folder, "documents"), path, tokens.vocabulary_path(tokens.BYTE_BPE))
    return token_files.read(spark, path)
