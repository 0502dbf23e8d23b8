"""Labelled sentences, ticker lists and the saved train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_labelled(
    spark: SparkSession, path: str, subset: str | None = None, *, fmt: str = "parquet"
) -> DataFrame:
    """Labelled sentences; ``subset`` prunes to one ``subset=`` partition folder."""
    reader = spark.read.schema(schemas.LABELLED_SENTENCE)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    df = reader.format(fmt).load(path)
    return df if subset is None else df.filter(F.col("subset") == subset)


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """One ticker per line: trimmed, upper case, blank lines and repeats dropped; none is an error."""
    tickers = (
        spark.read.text(path)
        .select(F.upper(F.trim(F.regexp_replace("value", r"^\x{feff}", ""))).alias("ticker"))
        .filter(F.col("ticker") != "")
        .distinct()
    )
    if tickers.isEmpty():
        raise ValueError(f"no tickers in {path}")
    return tickers


SPLIT_KEYS = ("subset", "seed", "test_size")


def write_split(split: DataFrame, path: str, *, subset: str, seed: int, test_size: float) -> None:
    """Save a split (it carries a ``part`` column) under its subset, seed and test size."""
    key = {"subset": subset, "seed": str(seed), "test_size": f"{test_size:g}"}
    (
        split.drop(*SPLIT_KEYS)
        .withColumns({k: F.lit(v) for k, v in key.items()})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SPLIT_KEYS)
        .parquet(path)
    )


def read_split(
    spark: SparkSession, path: str, *, subset: str, seed: int, test_size: float
) -> DataFrame | None:
    """The saved split for exactly these settings, or None."""
    folder = f"{path}/subset={subset}/seed={seed}/test_size={test_size:g}"
    if not path_exists(spark, folder):
        return None
    return spark.read.parquet(folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_label_names(spark: SparkSession, label_names: list[str], path: str) -> None:
    rows = [(i, name) for i, name in enumerate(label_names)]
    spark.createDataFrame(rows, "label int, label_name string").coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def read_label_names(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    return spark.read.schema("label int, label_name string").json(path)
