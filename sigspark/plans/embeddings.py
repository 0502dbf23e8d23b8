"""Text embeddings from a user-supplied encoder, and a cache keyed by text."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.corpus import path_exists

# texts, max_length -> matrix with one row per text
Encoder = Callable[[Sequence[str], "int | None"], np.ndarray]


# One for each call of embed, kept by a worker process for its later tasks.
_ENCODERS: dict[str, Encoder] = {}


def embed(
    text: Column | str,
    encoder_factory: Callable[[], Encoder],
    *,
    batch_size: int = 32,
    max_length: int | None = None,
) -> Column:
    """Embedding of each text. The factory runs once per worker process, on the executor; only the
    text column goes to Python, in Arrow batches. ``max_length`` is handed to the encoder."""
    name = uuid.uuid4().hex

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _ENCODERS:
            _ENCODERS[name] = encoder_factory()
        encode = _ENCODERS[name]
        for texts in batches:
            values = texts.fillna("").tolist()
            parts = [
                np.asarray(encode(values[i : i + batch_size], max_length), dtype=np.float32)
                for i in range(0, len(values), batch_size)
            ]
            yield pd.Series([row for part in parts for row in part], dtype=object)

    return run(F.col(text) if isinstance(text, str) else text)


def hashing_encoder(width: int = 64) -> Callable[[], Encoder]:
    """A small deterministic encoder: signed word hashes, L2-normalised."""

    def factory() -> Encoder:
        word = re.compile(r"\w+")

        def encode(texts: Sequence[str], max_length: int | None) -> np.ndarray:
            out = np.zeros((len(texts), width), dtype=np.float32)
            for row, text in enumerate(texts):
                for token in word.findall(text.lower())[:max_length]:
                    code = zlib.crc32(token.encode())
                    out[row, code % width] += 1.0 if code & 0x10000 else -1.0
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms == 0, 1, norms)

        return encode

    return factory


def embed_cached(
    df: DataFrame,
    cache: str,
    encoder_id: str,
    encoder_factory: Callable[[], Encoder],
    *,
    text: str = "text",
    out: str = "embedding",
    **options,
) -> DataFrame:
    """``df`` with embeddings from a Parquet cache; only texts the cache lacks are encoded.

    Keys are text hashes per encoder, so the cache cannot be mistaken for that of other texts,
    and copies of a text are encoded once.
    """
    spark = df.sparkSession
    folder = f"{cache.rstrip('/')}/encoder={encoder_id}"
    keyed = df.withColumn("_key", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    # Copies of a text collapse before the shuffle.
    missing = keyed.groupBy("_key").agg(F.first(text).alias("_text"))
    schema = "_key string, _vector array<float>"
    if path_exists(spark, folder):
        known = spark.read.schema(schema).parquet(folder).select("_key")
        missing = missing.join(known, "_key", "left_anti")
    missing.select("_key", embed("_text", encoder_factory, **options).alias("_vector")).write.mode(
        "append"
    ).parquet(folder)
    # A failed earlier run may have left a key twice.
    vectors = spark.read.schema(schema).parquet(folder).dropDuplicates(["_key"])
    return (
        keyed.join(vectors, "_key", "left").withColumnRenamed("_vector", out).drop("_key")
    )


def check_alignment(features: DataFrame, labels: DataFrame, key: str = "doc_id") -> None:
    """Raise unless both sides hold exactly the same keys, each once."""
    sides = features.select(key, F.lit(1).alias("_f"), F.lit(0).alias("_l")).unionByName(
        labels.select(key, F.lit(0).alias("_f"), F.lit(1).alias("_l"))
    )
    wrong = (
        sides.groupBy(key)
        .agg(F.sum("_f").alias("_f"), F.sum("_l").alias("_l"))
        .filter((F.col("_f") != 1) | (F.col("_l") != 1))
    )
    first = wrong.limit(1).collect()
    if first:
        raise ValueError(
            f"{key} {first[0][key]} occurs {first[0]['_f']} times in the features and "
            f"{first[0]['_l']} times in the labels"
        )


def join_features(features: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Features and labels of the same texts, joined on the key after checking both sides."""
    check_alignment(features, labels, key)
    return features.join(labels, key)
