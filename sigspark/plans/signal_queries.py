"""Daily signal, price features, as-of joins and forward returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import sentiment as se
from ..functions import text as tx
from ..functions.times import parse_seen_time
from ..operators import articles as ar
from ..operators import signal
from ..operators.asof import asof_join
from ..operators.order import group_quantiles
from ..sources.prices import normalise_prices, series_to_rows, slice_dates
from ..schemas import PRICE_SERIES_FIELDS, PRICE_SERIES_KEY
from . import inputs, signal_study
from .registry import TOKEN, day_text, query, rounded, sql_list

DAY = "strftime(published_date, '%Y-%m-%d') AS published_date"
DAILY = ("sentiment_score", "sentiment_std", "max_abs_sentiment")
ROLLING = ("rolling_sentiment_3", "rolling_sentiment_5", "sentiment_change", "sentiment_acceleration")


def _r(names) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def _show(df, *columns, day="published_date"):
    return df.select(
        "ticker", day_text(day).alias(day), *[rounded(c).alias(c) for c in columns]
    )


def _daily(spark, folder):
    return signal.daily_aggregate(inputs.articles(spark, folder))


@query(
    "daily_aggregate",
    f"SELECT ticker, {DAY}, {_r(DAILY)}, article_count FROM daily",
    needs="daily",
)
def daily_aggregate(spark, folder):
    return _daily(spark, folder).select(
        "ticker", day_text("published_date").alias("published_date"),
        *[rounded(c).alias(c) for c in DAILY], "article_count",
    )


@query(
    "daily_features",
    f"SELECT ticker, {DAY}, CAST(day_of_week AS BIGINT) AS day_of_week, article_count, {_r(DAILY + ROLLING)} FROM dfeat",
    needs="dfeat",
)
def daily_features(spark, folder):
    return signal.daily_features(_daily(spark, folder)).select(
        "ticker", day_text("published_date").alias("published_date"),
        F.col("day_of_week").cast("long").alias("day_of_week"), "article_count",
        *[rounded(c).alias(c) for c in DAILY + ROLLING],
    )


@query(
    "price_features",
    f"SELECT ticker, strftime(date, '%Y-%m-%d') AS date, {_r(signal.PRICE_FEATURES)} FROM pfeat",
    needs="pfeat",
)
def price_features(spark, folder):
    return _show(
        signal.price_features(inputs.prices(spark, folder)), *signal.PRICE_FEATURES, day="date"
    )


ASOF = (
    "SELECT d.ticker, strftime(published_date, '%Y-%m-%d') AS published_date, {cols} FROM daily d "
    "ASOF LEFT JOIN pfeat p ON d.ticker = p.ticker AND d.published_date {op} p.date"
)


def _asof_cols(days: int) -> str:
    return ", ".join(
        f"CASE WHEN published_date - date <= {days} THEN round({c}, 6) + 0.0 END AS {c}"
        for c in signal.PRICE_FEATURES
    )


@query("asof_backward_tol", ASOF.format(cols=_asof_cols(3), op=">="), needs="daily pfeat")
def asof_backward_tol(spark, folder):
    features = signal.price_features(inputs.prices(spark, folder))
    return _show(
        signal.attach_price_features(_daily(spark, folder), features), *signal.PRICE_FEATURES
    )


@query("asof_backward_strict", ASOF.format(cols=_asof_cols(3), op=">"), needs="daily pfeat")
def asof_backward_strict(spark, folder):
    features = signal.price_features(inputs.prices(spark, folder))
    return _show(
        signal.attach_price_features(_daily(spark, folder), features, strict=True),
        *signal.PRICE_FEATURES,
    )


@query(
    "asof_article_rows",
    "SELECT ticker, count(*) AS n, count(adjusted_close) AS matched, round(avg(adjusted_close), 2) AS mean_close FROM "
    "(SELECT a.ticker, CASE WHEN CAST(published_time AS DATE) - date <= 3 THEN adjusted_close END AS adjusted_close "
    "FROM articles a ASOF LEFT JOIN prices p ON a.ticker = p.ticker AND CAST(a.published_time AS DATE) >= p.date) GROUP BY ticker",
    needs="articles prices",
)
def asof_article_rows(spark, folder):
    """As-of join of the articles themselves: many rows per ticker and day."""
    dated = inputs.articles(spark, folder).withColumn("day", F.to_date("published_time"))
    joined = asof_join(
        dated, inputs.prices(spark, folder), "ticker", "day", "date", ["adjusted_close"],
        tolerance_days=3,
    )
    return joined.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("adjusted_close").alias("matched"),
        F.round(F.avg("adjusted_close"), 2).alias("mean_close"),
    )


@query(
    "forward_return",
    f"SELECT ticker, {DAY}, round(next_day_return, 6) + 0.0 AS next_day_return FROM fwd",
    needs="fwd",
)
def forward_return(spark, folder):
    out = signal.attach_forward_returns(_daily(spark, folder), inputs.prices(spark, folder))
    return _show(out, "next_day_return")


RETURNS = ("next_day_return", "benchmark_return", "excess_return")


@query("excess_return", f"SELECT ticker, {DAY}, {_r(RETURNS)} FROM excess", needs="excess")
def excess_return(spark, folder):
    out = signal.attach_forward_returns(
        _daily(spark, folder), inputs.prices(spark, folder), inputs.benchmark(spark, folder)
    )
    return _show(out, *RETURNS)


@query(
    "weighted_score",
    f"SELECT ticker, {DAY}, round(sentiment_score * ln(article_count + 1), 6) + 0.0 AS weighted_sentiment_score FROM daily",
    needs="daily",
)
def weighted_score(spark, folder):
    return _show(signal.add_weighted_score(_daily(spark, folder)), "weighted_sentiment_score")


@query(
    "threshold_filter",
    f"SELECT ticker, {DAY}, {_r(ROLLING)} FROM dfeat WHERE article_count >= 3 AND abs(sentiment_score) >= 0.25",
    needs="dfeat",
)
def threshold_filter(spark, folder):
    kept = signal.apply_thresholds(
        signal.daily_features(_daily(spark, folder)), min_articles=3, min_abs_sentiment=0.25
    )
    return _show(kept, *ROLLING)


@query(
    "direction_target",
    f"SELECT ticker, {DAY}, CASE WHEN excess_return > 0 THEN 1 ELSE 0 END AS direction FROM excess "
    "WHERE excess_return IS NOT NULL",
    needs="excess",
)
def direction_target(spark, folder):
    out = signal.attach_forward_returns(
        _daily(spark, folder), inputs.prices(spark, folder), inputs.benchmark(spark, folder)
    )
    rows = signal.drop_missing(out, ["excess_return"])
    return rows.select(
        "ticker", day_text("published_date").alias("published_date"),
        signal.direction("excess_return").alias("direction"),
    )


# --- the whole study --------------------------------------------------------------------------

FLAGSHIP = """SELECT count(*) AS n, round(corr(s, t), 6) AS pearson_corr,
round(corr(rs, rt), {digits}) AS spearman_corr,
round(avg(CASE WHEN (s > 0) = (t > 0) THEN 1.0 ELSE 0.0 END), 6) AS directional_accuracy,
round(avg(abs(t - s)), 6) AS mae FROM (SELECT s, t,
rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rs,
rank() OVER (ORDER BY t) + (count(*) OVER (PARTITION BY t) - 1) / 2.0 AS rt
FROM (SELECT {score} AS s, excess_return AS t FROM excess WHERE {where})
WHERE s IS NOT NULL AND t IS NOT NULL)"""


def _study(spark, folder, options=signal_study.SignalOptions()):
    dataset = signal_study.daily_dataset(
        inputs.articles(spark, folder), inputs.prices(spark, folder),
        inputs.benchmark(spark, folder), options,
    )
    if options.weight_by_article_count:
        # Engines differ in the last bit of ln(): rounding keeps equal products equal in the ranks.
        dataset = dataset.withColumn(options.score_column, F.round(options.score_column, 9))
    out = signal_study.evaluate(dataset, options)
    return out.select("n", *[rounded(c).alias(c) for c in out.columns[1:]])


@query("signal_eval", FLAGSHIP.format(digits=6, score="sentiment_score", where="true"), needs="excess")
def signal_eval(spark, folder):
    return _study(spark, folder)


@query(
    "signal_eval_weighted",
    FLAGSHIP.format(
        digits=6,
        score="round(sentiment_score * ln(article_count + 1), 9)",
        where="article_count >= 2 AND abs(sentiment_score) >= 0.1",
    ),
    needs="excess",
)
def signal_eval_weighted(spark, folder):
    return _study(
        spark,
        folder,
        signal_study.SignalOptions(
            weight_by_article_count=True, min_articles=2, min_abs_sentiment=0.1
        ),
    )


DATASET = ("sentiment_score",) + ROLLING + signal.PRICE_FEATURES + RETURNS


@query(
    "daily_dataset",
    f"SELECT e.ticker, strftime(e.published_date, '%Y-%m-%d') AS published_date, "
    + ", ".join(f"round(f.{c}, 6) + 0.0 AS {c}" for c in ("sentiment_score",) + ROLLING)
    + ", "
    + ", ".join(
        f"CASE WHEN f.published_date - p.date <= 3 THEN round(p.{c}, 6) + 0.0 END AS {c}"
        for c in signal.PRICE_FEATURES
    )
    + ", "
    + ", ".join(f"round(e.{c}, 6) + 0.0 AS {c}" for c in RETURNS)
    + " FROM excess e JOIN dfeat f ON e.ticker = f.ticker AND e.published_date = f.published_date "
    "ASOF LEFT JOIN pfeat p ON f.ticker = p.ticker AND f.published_date >= p.date",
    needs="excess dfeat pfeat",
)
def daily_dataset(spark, folder):
    dataset = signal_study.daily_dataset(
        inputs.articles(spark, folder), inputs.prices(spark, folder),
        inputs.benchmark(spark, folder),
    )
    return _show(dataset, *DATASET)


# --- scores -----------------------------------------------------------------------------------


@query(
    "expected_sentiment",
    "SELECT vec_id, round((c - a) / (a + b + c), 6) + 0.0 AS sentiment_score FROM (SELECT vec_id, "
    + ", ".join(
        f"list_sum([abs(x::DOUBLE) FOR x, i IN embedding IF (i - 1) % 3 = {k}]) AS {n}" for k, n in enumerate("abc")
    )
    + " FROM embeddings)",
)
def expected_sentiment(spark, folder):
    out = se.add_sentiment_score(
        inputs.probabilities(spark, folder), "proba", ["negative", "neutral", "positive"]
    )
    return out.select("vec_id", rounded("sentiment_score").alias("sentiment_score"))


@query(
    "label_score",
    "SELECT o_orderpriority AS priority, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN -2.0::DOUBLE "
    "WHEN '2' THEN 1.0::DOUBLE WHEN '3' THEN 0.0::DOUBLE WHEN '4' THEN -1.0::DOUBLE ELSE 2.0::DOUBLE END AS score, "
    "count(*) AS n FROM orders GROUP BY 1, 2",
)
def label_score(spark, folder):
    first = F.substring("o_orderpriority", 1, 1)
    name = (
        F.when(first == "1", "Very_Negative")
        .when(first == "2", " slightly bullish")
        .when(first == "3", "NEUTRAL")
        .when(first == "4", "Downward")
        .otherwise("strong positive")
    )
    return (
        inputs.table(spark, folder, "orders")
        .select(F.col("o_orderpriority").alias("priority"), se.label_score(name).alias("score"))
        .groupBy("priority", "score")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- articles and prices ----------------------------------------------------------------------

FEED_FILTERED = (
    "SELECT pos, upper(ticker) AS ticker, title FROM feed WHERE {where} AND "
    "(contains(lower(title), lower(ticker)) OR (upper(ticker) = 'AAPL' AND contains(lower(title), 'apple')) "
    "OR (upper(ticker) = 'SHOP' AND contains(lower(title), 'shopify')) OR (upper(ticker) = 'JNJ' AND "
    "(contains(lower(title), 'johnson & johnson') OR contains(lower(title), 'johnson and johnson'))))"
)


@query("entity_gate", FEED_FILTERED.format(where="true"), needs="feed")
def entity_gate(spark, folder):
    return ar.entity_gate(inputs.headline_feed(spark, folder)).select(
        "pos", F.upper("ticker").alias("ticker"), "title"
    )


@query(
    "news_to_articles",
    "SELECT pos, ticker, title, url, strftime(coalesce(try_strptime(seendate, '%Y%m%d%H%M%S'), "
    "try_strptime(seendate, '%Y%m%dT%H%M%SZ')), '%Y-%m-%d %H:%M:%S') AS published FROM ("
    + FEED_FILTERED.format(
        where="seendate <> '' AND upper(ticker) IN ('AAPL', 'SHOP') AND "
        "(contains(lower(title), 'shop') OR contains(lower(title), 'rise'))"
    )
    + ") JOIN (SELECT pos, url, seendate FROM feed) USING (pos)",
    needs="feed",
)
def news_to_articles(spark, folder):
    feed = inputs.headline_feed(spark, folder)
    # The position rides in the url, so each article can be told apart.
    tagged = feed.withColumn("url", F.concat_ws("#", "url", "pos"))
    out = ar.to_articles(tagged, ["aapl", "shop"], keywords=["SHOP", "rise"])
    return out.select(
        F.substring_index("url", "#", -1).cast("long").alias("pos"),
        "ticker",
        "title",
        F.substring_index("url", "#", 1).alias("url"),
        F.date_format("published_time", "yyyy-MM-dd HH:mm:ss").alias("published"),
    )


SHIFT_DAYS = 9000
NEWS_TICKERS = {"AAPL": "T0", "SHOP": "T1", "JNJ": "T2"}
SCORED_DAYS = f"""WITH tok AS (SELECT CASE upper(ticker) WHEN 'AAPL' THEN 'T0' WHEN 'SHOP' THEN 'T1' ELSE 'T2' END AS ticker,
CAST(coalesce(try_strptime(seendate, '%Y%m%d%H%M%S'), try_strptime(seendate, '%Y%m%dT%H%M%SZ')) AS DATE) - {SHIFT_DAYS} AS published_date,
regexp_extract_all(lower(title || ' ' || ({sql_list(inputs.PHRASES)})[pos % 4 + 1]), {TOKEN}) AS tok FROM feed JOIN ("""
SCORED_DAYS += FEED_FILTERED.format(where="seendate <> '' AND upper(ticker) IN ('AAPL', 'SHOP', 'JNJ')").replace(
    "SELECT pos, upper(ticker) AS ticker, title", "SELECT pos"
)
SCORED_DAYS += f""") USING (pos)),
scored_days AS (SELECT ticker, published_date, median(s) AS sentiment_score FROM (SELECT *,
(len(list_intersect(list_distinct(tok), {sql_list(lx.POSITIVE)})) - len(list_intersect(list_distinct(tok), {sql_list(lx.NEGATIVE)})))
/ greatest(len(tok), 1)::DOUBLE AS s FROM tok) GROUP BY 1, 2),
scored_fwd AS (SELECT d.*, (p.exit - p.entry) / nullif(p.entry, 0) AS next_day_return FROM scored_days d
ASOF LEFT JOIN paths p ON d.ticker = p.ticker AND d.published_date < p.date),
excess AS (SELECT f.*, next_day_return - (b.exit - b.entry) / nullif(b.entry, 0) AS excess_return
FROM scored_fwd f ASOF LEFT JOIN bpaths b ON f.published_date < b.date) """


@query(
    "feed_to_signal",
    SCORED_DAYS + FLAGSHIP.format(digits=6, score="sentiment_score", where="true"),
    needs="feed paths bpaths",
)
def feed_to_signal(spark, folder):
    """From the headline feed to the evaluated signal: articles, lexicon scores, days, returns.

    The feed is from 2024 and the prices end in 2001, so the articles are dated back."""
    feed = inputs.headline_feed(spark, folder)
    feed = feed.withColumn("title", F.concat_ws(" ", "title", inputs.phrase("pos")))
    articles = tx.with_lexicon_features(ar.to_articles(feed, list(NEWS_TICKERS)))
    balance = F.col("positive_kw_count") - F.col("negative_kw_count")
    names = F.create_map(*[F.lit(x) for pair in NEWS_TICKERS.items() for x in pair])
    scored = articles.select(
        F.try_element_at(names, F.col("ticker")).alias("ticker"),
        (F.col("published_time") - F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")).alias("published_time"),
        (balance / F.greatest("sentence_length", F.lit(1.0))).alias("sentiment_score"),
    )
    dataset = signal_study.daily_dataset(scored, inputs.prices(spark, folder), inputs.benchmark(spark, folder))
    out = signal_study.evaluate(dataset)
    return out.select("n", *[rounded(c).alias(c) for c in out.columns[1:]])


@query(
    "normalise_prices",
    "SELECT upper('t' || (o_custkey % 5)) AS ticker, strftime(o_orderdate, '%Y-%m-%d') AS date, "
    "o_totalprice AS adjusted_close, o_totalprice AS close FROM orders "
    "WHERE o_custkey % 7 <> 0 AND o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1999-06-02'",
)
def normalise_prices_query(spark, folder):
    raw = inputs.table(spark, folder, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, F.concat(F.lit("t"), F.col("o_custkey") % 5))
        .otherwise(F.lit("")).alias("symbol"),
        F.col("o_orderdate").alias("date"),
        *[F.col("o_totalprice").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"),
    )
    sliced = slice_dates(normalise_prices(raw), "1996-03-01", "1999-06-01")
    return sliced.select("ticker", day_text("date").alias("date"), "close", "adjusted_close")


@query(
    "price_series_rows",
    "SELECT ticker, strftime(date, '%Y-%m-%d') AS date, CASE WHEN day(date) % 9 <> 0 THEN adjusted_close END "
    "AS adjusted_close, CASE WHEN day(date) % 9 <> 0 THEN adjusted_close END AS close, "
    "NULL::DOUBLE AS volume FROM prices",
    needs="prices",
)
def price_series_rows(spark, folder):
    """Date-keyed price documents, one per ticker (a calendar bounds each), back to rows."""
    value = F.when(F.dayofmonth("date") % 9 != 0, F.col("adjusted_close").cast("string"))
    fields = F.struct(
        *[value.alias(f) for f in PRICE_SERIES_FIELDS[:4]],
        F.lit(None).cast("string").alias(PRICE_SERIES_FIELDS[4]),
    )
    documents = (
        inputs.prices(spark, folder)
        .groupBy("ticker")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), fields))
            ).alias(PRICE_SERIES_KEY)
        )
    )
    return series_to_rows(documents, "ticker").select(
        "ticker", day_text("date").alias("date"), "close", "adjusted_close", "volume"
    )


@query(
    "group_quantiles",
    "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, "
    "round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY l_returnflag",
)
def quantiles(spark, folder):
    out = group_quantiles(
        inputs.table(spark, folder, "lineitem"), ["l_returnflag"], "l_extendedprice",
        {"p50": 0.5, "p90": 0.9},
    )
    return out.select("l_returnflag", rounded("p50", 4).alias("p50"), rounded("p90", 4).alias("p90"))
