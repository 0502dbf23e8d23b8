"""Daily price files: one CSV per ticker, or one JSON document keyed by date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

_TICKER_IN_NAME = r"prices_(.+)\.(?:csv|json)$"


def _with_ticker(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "ticker", F.upper(F.regexp_extract(F.col("_metadata.file_name"), _TICKER_IN_NAME, 1))
    )


def read_price_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Price CSV files named ``prices_<TICKER>.csv``; one scan over all of them."""
    df = spark.read.schema(schemas.PRICE).option("header", True).csv(paths)
    return _with_ticker(df).select("ticker", *schemas.PRICE_COLUMNS)


def series_to_rows(documents: DataFrame, *keep: str) -> DataFrame:
    """Explode the date-keyed map of price documents into rows; unreadable numbers become null.

    The closing price doubles as ``adjusted_close``, which this format does not carry.
    """
    fields = schemas.PRICE_SERIES_FIELDS
    rows = documents.select(*keep, F.explode(schemas.PRICE_SERIES_KEY).alias("_day", "_v"))

    def number(field: str):
        return F.nanvl(F.col("_v").getField(field).try_cast("double"), F.lit(None).cast("double"))

    return rows.select(
        *keep,
        F.to_date("_day").alias("date"),
        *[number(f).alias(n) for f, n in zip(fields[:4], ("open", "high", "low", "close"))],
        number(fields[3]).alias("adjusted_close"),
        number(fields[4]).alias("volume"),
    )


def read_price_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    documents = _with_ticker(
        spark.read.schema(schemas.PRICE_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(paths)
    )
    checked = documents.withColumn(
        schemas.PRICE_SERIES_KEY,
        F.when(
            F.coalesce(F.size(schemas.PRICE_SERIES_KEY), F.lit(0)) > 0,
            F.col(schemas.PRICE_SERIES_KEY),
        ).otherwise(
            F.raise_error(F.concat(F.lit("no daily series for "), F.col("ticker"))).cast(
                schemas.PRICE_DOCUMENT[0].dataType
            )
        ),
    )
    return series_to_rows(checked, "ticker")


def _files(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """Price files in one folder by ticker, from a directory listing (no file is opened)."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/prices_*.{suffix}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    names = [(s.getPath().getName(), s.getPath().toString()) for s in found]
    return {name[len("prices_") : -len(suffix) - 1].upper(): path for name, path in names}


def read_prices(spark: SparkSession, folder: str, tickers: Sequence[str]) -> DataFrame:
    """Prices of the requested tickers: CSV where there is one, else JSON, else an error."""
    wanted = list(dict.fromkeys(t.upper() for t in tickers))
    csv, json = _files(spark, folder, "csv"), _files(spark, folder, "json")
    missing = [t for t in wanted if t not in csv and t not in json]
    if missing:
        raise FileNotFoundError(f"no price file in {folder} for: {', '.join(missing)}")
    from_csv = [csv[t] for t in wanted if t in csv]
    from_json = [json[t] for t in wanted if t not in csv]
    parts = []
    if from_csv:
        parts.append(read_price_csv(spark, from_csv))
    if from_json:
        parts.append(read_price_json(spark, from_json))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_benchmark(spark: SparkSession, folder: str, ticker: str = "SPY") -> DataFrame | None:
    """Prices of the benchmark ticker, or None when there is no CSV for it."""
    path = _files(spark, folder, "csv").get(ticker.upper())
    return None if path is None else read_price_csv(spark, path)


def slice_dates(df: DataFrame, start: str | None, end: str | None, column: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, both included and both optional."""
    if start is not None:
        df = df.filter(F.col(column) >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(F.col(column) <= F.to_date(F.lit(end)))
    return df


def normalise_prices(raw: DataFrame) -> DataFrame:
    """Vendor rows (symbol, date, open … volume) to the price layout; blank symbols are dropped."""
    return raw.filter(F.coalesce(F.col("symbol"), F.lit("")) != "").select(
        F.upper("symbol").alias("ticker"),
        F.to_date("date").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("close").cast("double").alias("adjusted_close"),
        F.col("volume").cast("double").alias("volume"),
    )


def write_prices(prices: DataFrame, path: str, *, fmt: str = "parquet", salts: int = 1) -> None:
    """Price rows in one folder per ticker, sorted by date inside each file.

    ``salts`` > 1 spreads each ticker over that many files when one ticker is very large.
    """
    salt = F.pmod(F.xxhash64("ticker", F.year("date")), F.lit(salts))
    writer = (
        prices.repartition("ticker", salt)
        .sortWithinPartitions("ticker", "date")
        .write.mode("overwrite")
        .partitionBy("ticker")
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
