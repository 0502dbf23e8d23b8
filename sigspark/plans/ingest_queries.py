"""Request planning, feed filters, keep-first merging and incremental ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import schemas
from ..operators import ingest as ig
from ..session import checkpoint_folder
from ..sources import feeds
from ..streaming.feed_stream import ingest_feed, read_ingested
from . import inputs
from .registry import day_text, query

FIRST = (
    "SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(url, ''), coalesce(seendate, '') "
    "ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
)


@query(
    "dedupe_keep_first",
    FIRST.format(cols="pos, ticker, title, url, seendate", order="pos", source="feed"),
    needs="feed",
)
def dedupe_keep_first(spark, folder):
    return ig.keep_first(inputs.headline_feed(spark, folder), ig.HEADLINE_KEY, ["pos"]).select(
        "pos", "ticker", "title", "url", "seendate"
    )


@query(
    "dedupe_per_ticker",
    "SELECT min(pos) AS pos, ticker, url, seendate FROM feed GROUP BY ticker, url, seendate",
    needs="feed",
)
def dedupe_per_ticker(spark, folder):
    keys = ("ticker", *ig.HEADLINE_KEY)
    return ig.keep_first(inputs.headline_feed(spark, folder), keys, ["pos"]).select(
        "pos", "ticker", "url", "seendate"
    )


@query(
    "merge_feeds",
    FIRST.format(cols="pos, url, seendate", order="src, pos", source="(SELECT *, "
    "CASE WHEN domain IN ('error', 'view') THEN 1 ELSE 0 END AS src FROM feed)"),
    needs="feed",
)
def merge_feeds(spark, folder):
    feed = inputs.headline_feed(spark, folder)
    incoming = F.col("domain").isin("error", "view")
    return ig.merge_feeds(
        feed.filter(~incoming), feed.filter(incoming), ig.HEADLINE_KEY, ["pos"]
    ).select("pos", "url", "seendate")


TERM_MATCH = (
    "(title <> '' OR url <> '') AND CASE upper(ticker) "
    "WHEN 'AAPL' THEN contains(lower(title || ' ' || url), 'aapl') OR contains(lower(title || ' ' || url), 'apple') "
    "WHEN 'SHOP' THEN contains(lower(title || ' ' || url), 'shop') OR contains(lower(title || ' ' || url), 'shopify') "
    "WHEN 'JNJ' THEN contains(lower(title || ' ' || url), 'jnj') OR contains(lower(title || ' ' || url), 'johnson & johnson') "
    "ELSE contains(lower(title || ' ' || url), lower(ticker)) END"
)


@query("feed_filter", f"SELECT pos, ticker, title, url FROM feed WHERE {TERM_MATCH}", needs="feed")
def feed_filter(spark, folder):
    return ig.filter_feed(inputs.headline_feed(spark, folder)).select(
        "pos", "ticker", "title", "url"
    )


RANGES = (
    "SELECT user_id, CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events GROUP BY user_id"
)


def _ranges(spark, folder):
    return (
        inputs.table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.to_date(F.min("ts")).alias("start_date"), F.to_date(F.max("ts")).alias("end_date")
        )
    )


@query(
    "window_plan",
    "SELECT user_id, strftime(w, '%Y-%m-%d') AS window_start, strftime(least(w + 6, e), '%Y-%m-%d') AS window_end, "
    "strftime(w, '%Y%m%d') || '000000' AS start_arg, strftime(least(w + 6, e), '%Y%m%d') || '000000' AS end_arg, "
    "strftime(w, '%Y%m%d') || 'T0000' AS time_from, strftime(least(w + 6, e), '%Y%m%d') || 'T2359' AS time_to FROM "
    f"(SELECT user_id, e, CAST(unnest(generate_series(s, e, INTERVAL 7 DAY)) AS DATE) AS w FROM ({RANGES}))",
)
def window_plan(spark, folder):
    plan = ig.window_plan(_ranges(spark, folder), 7, "user_id")
    return plan.withColumn("window_start", day_text("window_start")).withColumn(
        "window_end", day_text("window_end")
    )


@query(
    "request_plan",
    "SELECT ticker, ticker_index, strftime(w, '%Y-%m-%d') AS window_start, "
    "strftime(least(w + 9, DATE '2024-02-15'), '%Y-%m-%d') AS window_end FROM "
    "(SELECT upper(source) AS ticker, row_number() OVER (ORDER BY source) - 1 AS ticker_index FROM "
    "(SELECT DISTINCT source FROM documents)), "
    "(SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-15', INTERVAL 10 DAY)) AS DATE) AS w)",
)
def request_plan(spark, folder):
    from ..operators.profile import encode_labels

    names = inputs.table(spark, folder, "documents").select("source").distinct()
    tickers = encode_labels(names, "source", "ticker_index").select(
        F.upper("source").alias("ticker"), F.col("ticker_index").cast("long").alias("ticker_index")
    )
    plan = ig.request_plan(tickers, "2024-01-01", "2024-02-15", 10)
    return plan.select(
        "ticker", "ticker_index", day_text("window_start").alias("window_start"),
        day_text("window_end").alias("window_end"),
    )


CUSTOMER_RANGES = (
    "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e, "
    "count(*) AS n FROM orders GROUP BY 1"
)


def _customer_ranges(spark, folder):
    return (
        inputs.table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"),
            F.count(F.lit(1)).alias("n"),
        )
    )


BUSINESS = (
    f"SELECT o_custkey, s, e, n, count(*) FILTER (isodow(d) < 6) AS business_days FROM "
    f"(SELECT *, unnest(generate_series(s, e, INTERVAL 1 DAY)) AS d FROM ({CUSTOMER_RANGES})) "
    "GROUP BY 1, 2, 3, 4"
)


@query("business_days", f"SELECT o_custkey, business_days FROM ({BUSINESS})")
def business_days(spark, folder):
    return _customer_ranges(spark, folder).select(
        "o_custkey", ig.business_days(F.col("s"), F.col("e")).alias("business_days")
    )


@query(
    "request_estimates",
    "SELECT o_custkey, CAST(ceil((e - s + 1) / 7.0) + n AS BIGINT) AS news_calls, 2 * n AS per_ticker_calls, "
    "CAST(ceil(business_days * n / 100.0) * n AS BIGINT) AS price_calls FROM "
    f"({BUSINESS})",
)
def request_estimates(spark, folder):
    s, e, n = F.col("s"), F.col("e"), F.col("n")
    return _customer_ranges(spark, folder).select(
        "o_custkey",
        ig.estimate_news_calls(s, e, n, 7).alias("news_calls"),
        ig.estimate_news_calls(s, e, n, 7, per_ticker=True).alias("per_ticker_calls"),
        ig.estimate_price_calls(s, e, n, 100).alias("price_calls"),
    )


@query(
    "term_predicate",
    "SELECT p_partkey, '(' || array_to_string([CASE WHEN contains(t, ' ') THEN '\"' || t || '\"' ELSE t END FOR t IN "
    "[trim(x) FOR x IN [p_name, ' ' || p_brand || ' ', '  ']] IF t <> ''], ' OR ') || ')' AS predicate FROM part",
)
def term_predicate(spark, folder):
    terms = F.array("p_name", F.concat(F.lit(" "), "p_brand", F.lit(" ")), F.lit("  "))
    return inputs.table(spark, folder, "part").select(
        "p_partkey", ig.search_predicate(terms).alias("predicate")
    )


@query("feed_items", "SELECT count(*)::VARCHAR AS items FROM feed", needs="feed")
def feed_items(spark, folder):
    return ig.feed_items(inputs.headline_feed(spark, folder))


# --- landed files -----------------------------------------------------------------------------


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _api_documents(spark, folder):
    """One response per user and hour: those of every seventh user an error, of every fifth without a feed."""
    events = inputs.table(spark, folder, "events")
    article = F.struct(
        F.concat(F.lit("u"), F.col("event_type")).alias("url"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss").alias("time_published"),
        F.col("props").alias("title"),
        F.col("event_id").alias("id"),
    )
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("hour")
    responses = events.groupBy("user_id", hour).agg(F.array_sort(F.collect_list(article)).alias("feed"))
    user = F.col("user_id")
    return responses.select(
        "user_id",
        "hour",
        F.when(user % 5 != 0, F.transform("feed", lambda a: F.struct(
            a["url"].alias("url"), a["time_published"].alias("time_published"), a["title"].alias("title")
        ))).alias("feed"),
        F.when(user % 7 == 0, F.lit("slow down")).alias("Note"),
        F.when(user % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("def"), user)).alias(
            "sentiment_score_definition"
        ),
        F.lit("").alias("relevance_score_definition"),
    )


KEY = [StructField("user_id", LongType(), True), StructField("hour", StringType(), True)]


def _landed_documents(spark, folder):
    """The responses after a trip through JSON lines on shared storage."""
    path = _scratch(spark, "responses")
    _api_documents(spark, folder).write.json(path)
    return spark.read.schema(StructType([*schemas.API_FEED, *KEY])).json(path)


@query(
    "payload_gate",
    "SELECT user_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, CASE WHEN user_id % 7 = 0 "
    "THEN 'Note: slow down' WHEN user_id % 5 = 0 THEN 'missing feed' ELSE 'good' END AS reason "
    "FROM events GROUP BY ALL",
)
def payload_gate(spark, folder):
    good, bad = feeds.split_payloads(_landed_documents(spark, folder))
    return good.select("user_id", "hour", F.lit("good").alias("reason")).unionByName(
        bad.select("user_id", "hour", "reason")
    )


@query(
    "feed_metadata",
    "SELECT 'def' || min(user_id) FILTER (user_id % 2 = 1) AS sentiment_score_definition, "
    "'' AS relevance_score_definition FROM events WHERE user_id % 7 <> 0 AND user_id % 5 <> 0",
)
def feed_metadata(spark, folder):
    good, _ = feeds.split_payloads(_landed_documents(spark, folder))
    return feeds.feed_metadata(good, "user_id")


@query(
    "feed_stream_ingest",
    "SELECT pos, upper(ticker) AS ticker, url, seendate FROM ("
    + FIRST.format(cols="*", order="pos", source=f"(SELECT * FROM feed WHERE {TERM_MATCH})")
    + ")",
    needs="feed",
)
def feed_stream_ingest(spark, folder):
    """Land the feed as JSON lines and ingest it as a stream."""
    root = _scratch(spark, "feed")
    inputs.headline_feed(spark, folder).write.json(f"{root}/landing")
    ingest_feed(
        spark, f"{root}/landing", f"{root}/table", f"{root}/progress", order=("pos",)
    ).awaitTermination()
    return read_ingested(spark, f"{root}/table").select("pos", "ticker", "url", "seendate")
