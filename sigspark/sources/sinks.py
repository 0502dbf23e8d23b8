"""Writers for datasets and for one-row metric records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_METRIC_FORMATS = (".json", ".csv")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write a metrics frame as JSON or CSV by the extension of ``path``; others are an error.

    The result is a Spark output folder of that name holding one file: metric frames have one row
    per evaluation, so a single task is enough.
    """
    suffix = next((s for s in _METRIC_FORMATS if path.lower().endswith(s)), None)
    if suffix is None:
        raise ValueError(f"metrics go to {' or '.join(_METRIC_FORMATS)}, not {path}")
    writer = metrics.coalesce(1).write.mode("overwrite")
    if suffix == ".json":
        writer.json(path)
    else:
        writer.option("header", True).csv(path)


def write_dataset(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> None:
    """Write article, daily, prediction, summary or confusion tables."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
