"""Incremental, restartable feed ingest: landed JSON lines to a keep-first Parquet table.

The checkpoint is the progress record. Each micro-batch removes its own copies, drops keys that
earlier batches wrote, and replaces its own ``batch_id=N`` folder, so a batch that is played again
after a failure gives the same table. The key holds the time stamp, hence only the days that occur
in a batch can hold copies of it: older days are never read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions import lexicons as lx
from ..functions.times import parse_seen_time
from ..operators.ingest import HEADLINE_KEY, filter_feed, keep_first
from ..sources.corpus import path_exists

LANDED = StructType(
    [StructField("pos", schemas.LABELLED_SENTENCE["doc_id"].dataType, True)]
    + list(schemas.HEADLINE.fields)
    + [StructField(key, StringType(), True) for key in schemas.ERROR_KEYS]
)

NO_DAY = "none"


def _day() -> Column:
    """Partition value of a row: its day, or ``none`` when the time is blank or unreadable."""
    seen = parse_seen_time("seendate", on_error="null")
    return F.coalesce(F.date_format(seen, "yyyy-MM-dd"), F.lit(NO_DAY))


def _written_before(spark: SparkSession, output: str, batch_id: int, days: list[str]) -> DataFrame | None:
    """Keys other batches wrote for these days; only the folders of the days are listed."""
    folders = [f"{output}/day={d}" for d in days]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders:
        return None
    schema = StructType([StructField(k, StringType(), True) for k in HEADLINE_KEY])
    schema = schema.add("day", "string").add("batch_id", "long")
    return (
        spark.read.schema(schema)
        .option("basePath", output)
        .parquet(*folders)
        .select(*HEADLINE_KEY, "batch_id", "day")
        .filter(F.col("batch_id") != batch_id)
    )


def write_batch(
    batch: DataFrame,
    batch_id: int,
    output: str,
    quarantine: str,
    terms: Mapping[str, Sequence[str]] | DataFrame,
    order: Sequence[str],
) -> None:
    """One micro-batch: quarantine error payloads, filter, keep first, append unseen keys.

    The table is laid out by day, then batch; a replayed batch replaces its own folders only."""
    spark = batch.sparkSession
    batch = batch.persist()
    is_error = F.coalesce(*[F.col(k) for k in schemas.ERROR_KEYS]).isNotNull()
    batch.filter(is_error).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")

    rows = filter_feed(batch.filter(~is_error).drop(*schemas.ERROR_KEYS), terms)
    fresh = keep_first(rows, HEADLINE_KEY, order).withColumns(
        {"ticker": F.upper("ticker"), "day": _day(), "batch_id": F.lit(batch_id).cast("long")}
    )
    fresh = fresh.persist()
    try:
        # One entry per calendar day in the batch.
        days = [r["day"] for r in fresh.select("day").distinct().collect()]
        seen = _written_before(spark, output, batch_id, days)
        new = fresh
        if seen is not None:
            def key(df: DataFrame, side: str) -> DataFrame:
                return df.select("*", *[
                    F.coalesce(F.col(k), F.lit("")).alias(f"_{side}{i}") for i, k in enumerate(HEADLINE_KEY)
                ])

            left, right = key(fresh, "l"), key(seen, "r").select("_r0", "_r1")
            new = left.join(
                right, (F.col("_l0") == F.col("_r0")) & (F.col("_l1") == F.col("_r1")), "left_anti"
            ).drop("_l0", "_l1")
        (
            new.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id")
            .parquet(output)
        )
    finally:
        fresh.unpersist()
        batch.unpersist()


def ingest_feed(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    *,
    quarantine: str | None = None,
    terms: Mapping[str, Sequence[str]] | DataFrame = lx.SEARCH_TERMS,
    order: Sequence[str] = ("origin", "pos"),
    max_files_per_batch: int | None = None,
    origin: Column | None = None,
) -> StreamingQuery:
    """Process everything landed since the last run, then stop.

    Of the copies in one batch the first in ``order`` stays: by file, then place in the file. ``origin`` says
    what names a row's file and sorts by arrival; by default the file's own name."""
    reader = spark.readStream.schema(LANDED)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    bad = quarantine or f"{output.rstrip('/')}_quarantine"
    source = F.col("_metadata.file_name") if origin is None else origin
    return (
        reader.json(landing)
        .select("*", source.alias("origin"))
        .writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, batch_id, output, bad, terms, order)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, output: str) -> DataFrame:
    schema = StructType([StructField("pos", LANDED["pos"].dataType, True), *schemas.HEADLINE.fields])
    schema = schema.add("origin", "string")
    return spark.read.schema(schema.add("day", "string").add("batch_id", "long")).parquet(output)


def dedupe_stream(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str
) -> DataFrame:
    """Keep-first on an unbounded stream with bounded state: copies arriving later than ``delay``
    after the first one are not recognised."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
