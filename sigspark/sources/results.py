"""Result documents of model runs, one ``results.json`` per subset folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions import lexicons as lx


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """One row per ``<root>/<subset>/results.json`` with its subset name."""
    return (
        spark.read.schema(schemas.RESULTS)
        .option("multiLine", True)
        .json(f"{root.rstrip('/')}/*/results.json")
        .withColumn(
            "subset", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/results\.json$", 1)
        )
    )


def subset_order(subset: Column | str, canonical: Sequence[str] = lx.SUBSETS) -> Column:
    """Sort key: canonical subsets in their order, all others after them (then by name)."""
    subset = F.col(subset) if isinstance(subset, str) else subset
    place = F.array_position(F.array(*[F.lit(s) for s in canonical]), subset)
    return F.when(place > 0, place).otherwise(F.lit(len(canonical) + 1))


def write_results(results: DataFrame, path: str, *, by: Sequence[str] = ("subset",)) -> None:
    """Write result documents as JSON lines, one folder per subset (and run)."""
    results.write.mode("overwrite").partitionBy(*by).json(path)


def read_written_results(
    spark: SparkSession, path: str, *, by: Sequence[str] = ("subset",)
) -> DataFrame:
    """Read back what ``write_results`` wrote."""
    folders = [StructField(name, StringType(), True) for name in by]
    return spark.read.schema(StructType([*schemas.RESULTS, *folders])).json(path)
