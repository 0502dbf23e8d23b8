"""News to returns: from scored articles and prices to the evaluated daily signal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import signal
from ..operators.metrics import signal_eval


@dataclass(frozen=True)
class SignalOptions:
    horizon_days: int = signal.HORIZON_DAYS
    tolerance_days: int = 3
    weight_by_article_count: bool = False
    min_articles: int = 0
    min_abs_sentiment: float = 0.0

    @property
    def score_column(self) -> str:
        return "weighted_sentiment_score" if self.weight_by_article_count else "sentiment_score"


def daily_dataset(
    articles: DataFrame,
    prices: DataFrame,
    benchmark: DataFrame | None = None,
    options: SignalOptions = SignalOptions(),
) -> DataFrame:
    """Daily features, price features and forward returns, one row per ticker and day.

    After the daily aggregate all windows share the ticker as their key, so Spark shuffles the
    daily rows and the prices by ticker and not the articles.
    """
    daily = signal.daily_features(signal.daily_aggregate(articles))
    daily = signal.attach_price_features(
        daily, signal.price_features(prices), tolerance_days=options.tolerance_days
    )
    if options.weight_by_article_count:
        daily = signal.add_weighted_score(daily)
    daily = signal.apply_thresholds(
        daily, min_articles=options.min_articles, min_abs_sentiment=options.min_abs_sentiment
    )
    return signal.attach_forward_returns(daily, prices, benchmark, options.horizon_days)


def target_column(dataset: DataFrame) -> str:
    """The excess return when a benchmark was available, else the plain forward return."""
    return "excess_return" if "excess_return" in dataset.columns else "next_day_return"


def evaluate(dataset: DataFrame, options: SignalOptions = SignalOptions()) -> DataFrame:
    return signal_eval(dataset, options.score_column, target_column(dataset))
