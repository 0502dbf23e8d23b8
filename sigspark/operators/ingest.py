"""Request planning, feed filtering and keep-first merging of feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.times import compact_time, day_end_arg, day_start_arg
from .articles import literal_lists

HEADLINE_KEY = ("url", "seendate")
API_KEY = ("url", "time_published")


# --- planning ---------------------------------------------------------------------------------


def windows_between(start: Column, end: Column, window_days: int) -> Column:
    """Array of first days of the consecutive ``window_days`` blocks from start to end."""
    if window_days <= 0:
        raise ValueError("window_days must be at least 1")
    step = F.make_dt_interval(F.lit(window_days))
    empty = F.array().cast("array<date>")
    return F.when(end >= start, F.sequence(start, end, step)).otherwise(empty)


def window_plan(ranges: DataFrame, window_days: int, *keep: str) -> DataFrame:
    """Cut each (start_date, end_date) row into blocks; the last block is clipped.

    Adds the block dates and the time arguments the two feed services take.
    """
    first = F.explode(windows_between(F.col("start_date"), F.col("end_date"), window_days))
    return (
        ranges.withColumn("window_start", first)
        .withColumn(
            "window_end",
            F.least(F.date_add("window_start", window_days - 1), F.col("end_date")),
        )
        .select(
            *keep,
            "window_start",
            "window_end",
            compact_time("window_start").alias("start_arg"),
            compact_time("window_end").alias("end_arg"),
            day_start_arg("window_start").alias("time_from"),
            day_end_arg("window_end").alias("time_to"),
        )
    )


def request_plan(tickers: DataFrame, start: str, end: str, window_days: int) -> DataFrame:
    """Every (window, ticker) request from ``start`` to ``end``, in window and ticker order.

    ``tickers`` carries (ticker, ticker_index).
    """
    span = {"start_date": F.to_date(F.lit(start)), "end_date": F.to_date(F.lit(end))}
    return window_plan(tickers.withColumns(span), window_days, *tickers.columns)


def business_days(start: Column, end: Column) -> Column:
    """Mondays to Fridays from start to end, both included, by arithmetic on whole weeks."""
    days = F.datediff(end, start) + 1
    weeks, rest = F.floor(days / 7), F.pmod(days, F.lit(7))
    tail = F.aggregate(
        F.sequence(F.lit(0), F.lit(6)),
        F.lit(0),
        lambda acc, i: acc
        + F.when((i < rest) & (F.pmod(F.weekday(start) + i, F.lit(7)) < 5), 1).otherwise(0),
    )
    return F.when(end >= start, weeks * 5 + tail).otherwise(F.lit(0)).cast("long")


def estimate_news_calls(
    start: Column,
    end: Column,
    tickers: Column,
    window_days: int,
    *,
    per_ticker: bool = False,
    with_news: bool = True,
    with_prices: bool = True,
    cap: int | None = None,
) -> Column:
    """Requests a run would make; raises above ``cap`` or when the range is empty."""
    days = F.datediff(end, start) + 1
    windows = tickers if per_ticker else F.ceil(days / F.lit(window_days))
    calls = (windows if with_news else F.lit(0)) + (tickers if with_prices else F.lit(0))
    return _checked(calls.cast("long"), days > 0, cap)


def estimate_price_calls(
    start: Column, end: Column, tickers: Column, page_rows: int, *, cap: int | None = None
) -> Column:
    """Pages of a paged price download, assuming one row per business day and ticker."""
    n = F.greatest(tickers, F.lit(1))
    pages = F.ceil(business_days(start, end) * n / F.lit(page_rows))
    return _checked((pages * n).cast("long"), end >= start, cap)


def _checked(calls: Column, valid: Column, cap: int | None) -> Column:
    out = F.when(valid, calls).otherwise(
        F.raise_error(F.lit("end date before start date")).cast("long")
    )
    if cap is not None:
        out = F.when(
            calls > cap,
            F.raise_error(F.concat(F.lit(f"more than {cap} calls: "), calls.cast("string"))).cast(
                "long"
            ),
        ).otherwise(out)
    return out


# --- filtering --------------------------------------------------------------------------------


def search_predicate(terms: Column | str) -> Column:
    """Terms as one search expression: ``(a OR "b c")``. No usable term is an error."""
    terms = F.col(terms) if isinstance(terms, str) else terms
    usable = F.filter(F.transform(terms, lambda t: F.trim(t)), lambda t: t != "")
    quoted = F.transform(
        usable, lambda t: F.when(F.contains(t, F.lit(" ")), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t)
    )
    return F.when(
        F.size(usable) > 0, F.concat(F.lit("("), F.array_join(quoted, " OR "), F.lit(")"))
    ).otherwise(F.raise_error(F.lit("no usable search term")).cast("string"))


def default_terms(
    ticker: Column | str, terms: Mapping[str, Sequence[str]] = lx.SEARCH_TERMS
) -> Column:
    """Search terms of a ticker; the upper-cased ticker itself when none are known."""
    symbol = F.upper(F.col(ticker) if isinstance(ticker, str) else ticker)
    return F.coalesce(literal_lists(terms, symbol), F.array(symbol))


def matches_terms(text: Column, terms: Column) -> Column:
    lowered = F.lower(text)
    return F.exists(terms, lambda t: F.contains(lowered, F.lower(t)))


def filter_feed(
    feed: DataFrame, terms: Mapping[str, Sequence[str]] | DataFrame = lx.SEARCH_TERMS
) -> DataFrame:
    """Drop rows without title and url, and rows in whose title and url no search term occurs.

    ``terms`` is a small mapping or a table (ticker, terms array<string>).
    """
    title = F.coalesce(F.col("title"), F.lit(""))
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = feed.filter((title != "") | (url != ""))
    if isinstance(terms, DataFrame):
        table = terms.select(F.upper("ticker").alias("_t"), F.col("terms").alias("_terms"))
        rows = rows.join(table, F.upper("ticker") == F.col("_t"), "left").drop("_t")
        known = F.coalesce(F.col("_terms"), F.array(F.upper("ticker")))
        return rows.filter(matches_terms(F.concat_ws(" ", title, url), known)).drop("_terms")
    return rows.filter(matches_terms(F.concat_ws(" ", title, url), default_terms("ticker", terms)))


# --- keep-first merging -----------------------------------------------------------------------


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``; a missing key part counts as the empty string.

    A group aggregate rather than a row number: copies collapse before the shuffle, so a key with
    very many copies costs no more than one row per input task.
    """
    blank = {f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)}
    return (
        df.withColumns(blank)
        .groupBy(*blank)
        .agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def merge_feeds(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Union of two feeds, one row per key, existing rows before incoming ones."""
    both = existing.withColumn("_source", F.lit(0)).unionByName(
        incoming.withColumn("_source", F.lit(1)), allowMissingColumns=True
    )
    return keep_first(both, keys, ["_source", *order]).drop("_source")


def merge_definitions(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """First non-empty definition text of two one-row metadata frames."""
    names = ("sentiment_score_definition", "relevance_score_definition")
    return existing.select(
        *[
            F.coalesce(
                F.nullif(F.col(n), F.lit("")), incoming.select(n).scalar(), F.lit("")
            ).alias(n)
            for n in names
        ]
    )


def feed_items(feed: DataFrame) -> DataFrame:
    """The ``items`` field recomputed from the rows, as text."""
    return feed.agg(F.count(F.lit(1)).cast("string").alias("items"))
