"""From feed rows to article rows: ticker set, relevance gate, keyword filter, time parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.text import contains_any
from ..functions.times import parse_seen_time


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def literal_lists(mapping: Mapping[str, Sequence[str]], key: Column) -> Column:
    """The list a small fixed mapping holds for ``key``, or null."""
    pairs = []
    for name, values in mapping.items():
        pairs += [F.lit(name.upper()), F.array(*[F.lit(v) for v in values])]
    if not pairs:
        return F.lit(None).cast("array<string>")
    return F.try_element_at(F.create_map(*pairs), key)


def is_relevant(
    title: Column, ticker: Column, aliases: Column, *, word_boundary: bool = False
) -> Column:
    """True when the title holds the ticker or one of its aliases, ignoring case.

    Plain substrings by default ("shop" is found in "shopping"); ``word_boundary`` asks for whole
    words.
    """
    lowered = F.lower(title)

    def found(word: Column) -> Column:
        if not word_boundary:
            return F.contains(lowered, word)
        # Blank out everything but letters and digits, then look for the padded word.
        def clean(c):
            return F.concat(F.lit(" "), F.regexp_replace(c, r"[^\p{L}\p{Nd}]+", " "), F.lit(" "))

        return F.contains(clean(lowered), clean(word))

    none = F.array().cast("array<string>")
    return found(F.lower(ticker)) | F.exists(
        F.coalesce(aliases, none), lambda a: found(F.lower(a))
    )


def entity_gate(
    feed: DataFrame,
    aliases: Mapping[str, Sequence[str]] | DataFrame = lx.TICKER_ALIASES,
    *,
    title: str = "title",
    ticker: str = "ticker",
    word_boundary: bool = False,
) -> DataFrame:
    """Rows whose title names their ticker.

    ``aliases`` is a small mapping, planned as a literal map, or a table (ticker, aliases
    array<string>) that is joined; its size decides whether Spark broadcasts it.
    """
    symbol = F.upper(_text(ticker))
    if isinstance(aliases, DataFrame):
        table = aliases.select(F.upper("ticker").alias("_t"), F.col("aliases").alias("_aliases"))
        feed = feed.join(table, symbol == F.col("_t"), "left").drop("_t")
        keep = is_relevant(_text(title), symbol, F.col("_aliases"), word_boundary=word_boundary)
        return feed.filter(keep).drop("_aliases")
    return feed.filter(
        is_relevant(
            _text(title), symbol, literal_lists(aliases, symbol), word_boundary=word_boundary
        )
    )


def keyword_filter(df: DataFrame, keywords: Sequence[str], column: str = "text") -> DataFrame:
    return df.filter(contains_any(column, keywords)) if keywords else df


def in_tickers(df: DataFrame, tickers: DataFrame | Sequence[str]) -> DataFrame:
    """Rows whose upper-cased ticker is in the set."""
    if isinstance(tickers, DataFrame):
        wanted = tickers.select(F.upper("ticker").alias("_t")).distinct()
        return df.join(wanted, F.upper("ticker") == F.col("_t"), "left_semi")
    return df.filter(F.upper("ticker").isin([t.upper() for t in tickers]))


def to_articles(
    feed: DataFrame,
    tickers: DataFrame | Sequence[str],
    *,
    keywords: Sequence[str] = (),
    aliases: Mapping[str, Sequence[str]] | DataFrame = lx.TICKER_ALIASES,
    on_error: str = "raise",
    word_boundary: bool = False,
) -> DataFrame:
    """Article rows of a headline feed.

    Cheap tests come before time parsing. ``on_error="null"`` keeps rows with an unreadable time
    with a null ``published_time`` (see ``unreadable_times``) instead of failing.
    """
    rows = in_tickers(feed, tickers).filter(F.trim(_text("seendate")) != "")
    rows = entity_gate(rows, aliases, word_boundary=word_boundary)
    rows = keyword_filter(rows, keywords, "title")
    return rows.select(
        F.upper("ticker").alias("ticker"),
        parse_seen_time("seendate", on_error=on_error).alias("published_time"),
        _text("title").alias("title"),
        F.lit("").alias("summary"),
        _text("title").alias("text"),
        _text("url").alias("url"),
    )


def unreadable_times(feed: DataFrame) -> DataFrame:
    """Rows with a time that fits neither format, for a quarantine table."""
    return feed.filter(
        (F.trim(_text("seendate")) != "")
        & parse_seen_time("seendate", on_error="null").isNull()
    )
