"""News feed documents: reading, and the gate that keeps error payloads away from good data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .. import schemas


def read_headline_feed(
    spark: SparkSession, paths: str | Sequence[str], *, lines: bool = False
) -> DataFrame:
    """Headline rows of ``{items, feed: [...]}`` documents, with ``origin`` and ``pos``.

    Rows arrived in the order of ``(origin, pos)``: the file's name, which sorts by fetch window, and
    the place in the file. A document file is one record to Spark, so it is read by one task and its
    places are counted. Land large feeds as JSON lines, one article and its ``pos`` per line, and pass
    ``lines=True``: those files are split freely, so a place has to be part of the line.
    """
    origin = F.col("_metadata.file_name").alias("origin")
    if lines:
        schema = StructType([StructField("pos", LongType(), True), *schemas.HEADLINE.fields])
        return spark.read.schema(schema).json(paths).select(origin, "*")
    documents = spark.read.schema(schemas.HEADLINE_FEED).option("multiLine", True).json(paths)
    return documents.select(origin, F.posexplode("feed").alias("pos", "_a")).select(
        "origin", F.col("pos").cast("long").alias("pos"), "_a.*"
    )


def read_api_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole API responses, one row per file, with the path kept as ``origin``."""
    return (
        spark.read.schema(schemas.API_FEED)
        .option("multiLine", True)
        .json(paths)
        .withColumn("origin", F.col("_metadata.file_path"))
    )


def split_payloads(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good documents, and quarantined ones with a ``reason``.

    A document with an error key, or without ``feed``, is bad; an empty feed is good.
    """
    reason = F.coalesce(
        *[
            F.when(F.col(key).isNotNull(), F.concat(F.lit(f"{key}: "), F.col(key)))
            for key in schemas.ERROR_KEYS
        ],
        F.when(F.col("feed").isNull(), F.lit("missing feed")),
    )
    tagged = documents.withColumn("reason", reason)
    good = tagged.filter(F.col("reason").isNull()).drop("reason", *schemas.ERROR_KEYS)
    bad = tagged.filter(F.col("reason").isNotNull()).drop("feed")
    return good, bad


def api_articles(documents: DataFrame) -> DataFrame:
    """Article rows of good API documents."""
    return documents.select("origin", F.posexplode("feed").alias("pos", "_a")).select(
        "origin", F.col("pos").cast("long").alias("pos"), "_a.*"
    )


def feed_metadata(documents: DataFrame, order: str) -> DataFrame:
    """First non-empty definition texts over the documents, in ``order``; one row."""

    def first_text(name: str):
        seen = F.nullif(F.col(name), F.lit(""))
        # min_by skips rows whose ordering is null, so empty texts never win.
        return F.coalesce(
            F.min_by(seen, F.when(seen.isNotNull(), F.col(order))), F.lit("")
        ).alias(name)

    return documents.agg(
        first_text("sentiment_score_definition"), first_text("relevance_score_definition")
    )
