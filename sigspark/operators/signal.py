"""Daily sentiment, price features and forward returns per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..functions.sentiment import volume_weighted
from .asof import asof_join
from .order import group_median

# Column names of the daily tables.
PRICE_FEATURES = (
    "daily_return",
    "lag_return_1",
    "lag_return_3",
    "rolling_return_mean_5",
    "rolling_return_mean_10",
    "rolling_vol_5",
    "rolling_vol_10",
)

CLASSIFIER_FEATURES = (
    "sentiment_std",
    "max_abs_sentiment",
    "article_count",
    "day_of_week",
    "rolling_sentiment_3",
    "rolling_sentiment_5",
    "sentiment_change",
    "sentiment_acceleration",
    *PRICE_FEATURES,
)

REGRESSOR_FEATURES = (
    "article_count",
    "day_of_week",
    "rolling_sentiment_3",
    "rolling_sentiment_5",
    *PRICE_FEATURES,
)

BENCHMARK = "SPY"
HORIZON_DAYS = 2


def _by_day(day: str) -> WindowSpec:
    return Window.partitionBy("ticker").orderBy(day)


def _rolling(function, column: str, rows: int, day: str) -> Column:
    """``function`` over the last ``rows`` rows; null until all of them hold a value."""
    frame = _by_day(day).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(column).over(frame) == rows, function(column).over(frame))


def daily_return(price: str = "adjusted_close", day: str = "date") -> Column:
    before = F.lag(price).over(_by_day(day))
    return F.try_divide(F.col(price) - before, before)


def price_features(prices: DataFrame) -> DataFrame:
    """Returns, lagged returns, rolling mean and volatility per ticker, in one sorted pass."""
    by_day = _by_day("date")
    return (
        prices.select("ticker", "date", "adjusted_close")
        .withColumn("daily_return", daily_return())
        .select(
            "ticker",
            "date",
            "daily_return",
            F.lag("daily_return", 1).over(by_day).alias("lag_return_1"),
            F.lag("daily_return", 3).over(by_day).alias("lag_return_3"),
            _rolling(F.avg, "daily_return", 5, "date").alias("rolling_return_mean_5"),
            _rolling(F.avg, "daily_return", 10, "date").alias("rolling_return_mean_10"),
            _rolling(F.stddev_samp, "daily_return", 5, "date").alias("rolling_vol_5"),
            _rolling(F.stddev_samp, "daily_return", 10, "date").alias("rolling_vol_10"),
        )
    )


def daily_aggregate(articles: DataFrame) -> DataFrame:
    """One row per ticker and publication day: exact median, sample deviation (0 for one
    article), largest absolute score, and row count."""
    keys = ["ticker", "published_date"]
    dated = articles.select(
        "ticker", F.to_date("published_time").alias("published_date"), "sentiment_score"
    )
    spread = [
        F.coalesce(F.stddev_samp("sentiment_score"), F.lit(0.0)).alias("sentiment_std"),
        F.max(F.abs("sentiment_score")).alias("max_abs_sentiment"),
        F.count(F.lit(1)).alias("article_count"),
    ]
    middle = group_median(dated.filter("ticker is not null and published_date is not null"), keys, "sentiment_score", "sentiment_score")
    daily = dated.groupBy(*keys).agg(*spread).join(middle, keys, "left")
    return daily.select(
        *keys, "sentiment_score", "sentiment_std", "max_abs_sentiment", "article_count"
    )


def daily_features(daily: DataFrame) -> DataFrame:
    """Add weekday (Monday = 0), rolling means over 3 and 5 rows, change and acceleration."""
    day = "published_date"
    return (
        daily.withColumn("day_of_week", F.weekday(day))
        .withColumns(
            {
                "rolling_sentiment_3": _rolling(F.avg, "sentiment_score", 3, day),
                "rolling_sentiment_5": _rolling(F.avg, "sentiment_score", 5, day),
                "sentiment_change": F.col("sentiment_score")
                - F.lag("sentiment_score").over(_by_day(day)),
            }
        )
        .withColumn(
            "sentiment_acceleration",
            F.col("sentiment_change") - F.lag("sentiment_change").over(_by_day(day)),
        )
    )


def attach_price_features(
    daily: DataFrame, features: DataFrame, *, tolerance_days: int = 3, strict: bool = False
) -> DataFrame:
    """Latest price features on or before the day, at most ``tolerance_days`` old.

    ``strict`` leaves the publication day itself out.
    """
    return asof_join(
        daily, features, "ticker", "published_date", "date", PRICE_FEATURES,
        exact=not strict, tolerance_days=tolerance_days, left_unique=True,
    )


def add_weighted_score(daily: DataFrame) -> DataFrame:
    return daily.withColumn(
        "weighted_sentiment_score", volume_weighted("sentiment_score", "article_count")
    )


def apply_thresholds(
    daily: DataFrame, *, min_articles: int = 0, min_abs_sentiment: float = 0.0
) -> DataFrame:
    """Drop thin or weak days. Call it after the rolling features, which need all days."""
    if min_articles > 0:
        daily = daily.filter(F.col("article_count") >= min_articles)
    if min_abs_sentiment > 0:
        daily = daily.filter(F.abs("sentiment_score") >= min_abs_sentiment)
    return daily


def forward_returns(
    probes: DataFrame,
    prices: DataFrame,
    horizon_days: int = HORIZON_DAYS,
    *,
    day: str = "published_date",
    out: str = "next_day_return",
) -> DataFrame:
    """Return from the first trading day after ``day`` to ``horizon_days`` trading days later.

    ``probes`` must be unique per (ticker, day). Null when the horizon runs past the last price,
    when a price is missing, or when the horizon is not positive.
    """
    if horizon_days <= 0:
        return probes.withColumn(out, F.lit(None).cast("double"))
    by_day = _by_day("date")
    paths = prices.select(
        "ticker",
        "date",
        F.col("adjusted_close").alias("_entry"),
        F.lead("adjusted_close", horizon_days).over(by_day).alias("_exit"),
    )
    return (
        asof_join(
            probes, paths, "ticker", day, "date", ["_entry", "_exit"],
            direction="forward", exact=False, left_unique=True,
        )
        .withColumn(out, F.try_divide(F.col("_exit") - F.col("_entry"), F.col("_entry")))
        .drop("_entry", "_exit")
    )


def attach_forward_returns(
    daily: DataFrame,
    prices: DataFrame,
    benchmark: DataFrame | None = None,
    horizon_days: int = HORIZON_DAYS,
) -> DataFrame:
    """Add ``next_day_return`` and, with a benchmark, ``benchmark_return`` and ``excess_return``.

    The benchmark return is worked out for every day of the benchmark's calendar, not for the days
    of the articles, so the articles are not read again for it. That table has one row per day and
    is broadcast. All days before the first benchmark price share the day before it.
    """
    out = forward_returns(daily, prices, horizon_days)
    if benchmark is None:
        return out
    one = F.lit("benchmark").alias("ticker")
    span = benchmark.agg(
        F.date_sub(F.min("date"), 1).alias("_first"), F.date_sub(F.max("date"), 1).alias("_last")
    )
    days = span.select(one, F.explode(F.sequence("_first", "_last")).alias("_day"))
    market = forward_returns(
        days, benchmark.select(one, "date", "adjusted_close"), horizon_days,
        day="_day", out="benchmark_return",
    ).drop("ticker")
    return (
        out.withColumn("_first", span.select("_first").scalar())
        .withColumn(
            "_day",
            F.when(F.col("published_date") < F.col("_first"), F.col("_first")).otherwise(F.col("published_date")),
        )
        .join(F.broadcast(market), "_day", "left")
        .withColumn("excess_return", F.col("next_day_return") - F.col("benchmark_return"))
        .drop("_day", "_first")
    )


def direction(target: Column | str) -> Column:
    """1 when the target is above zero, else 0."""
    return (F.col(target) if isinstance(target, str) else target).__gt__(0).cast("int")


def require_columns(df: DataFrame, columns) -> list[str]:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return list(columns)


def present_columns(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def drop_missing(df: DataFrame, columns) -> DataFrame:
    """Rows that hold a value (neither null nor NaN) in all the columns."""
    return df.na.drop(subset=list(columns))
