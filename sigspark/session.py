"""Session settings the operators rely on, and access to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes (broadcast, skew split, coalescing) and drops empty branches.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "sigspark", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        # Building columns is several times faster without a Python stack trace for each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only a local session, where every task runs on this machine, may fall back to a temporary
    folder; a cluster without the setting is an error rather than a silent local path.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="sigspark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the checkpoint folder; packed columns take a part of a checkpoint's room."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
