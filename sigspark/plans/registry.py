"""Registered queries, and SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from . import inputs

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *, needs: str = ""):
    """Register a query. ``needs`` names the shared CTEs its SQL reads."""

    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(needs.split(), sql)
        return fn

    return register


def rounded(column, digits: int = 6):
    """Rounded, with minus zero turned into zero."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits) + F.lit(0.0)


def day_text(column):
    return F.date_format(column, "yyyy-MM-dd")


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


TOKEN = sql_text(lx.TOKEN)
# A weekend day counts as the Monday after it.
TRADING = (
    "(CAST(o_orderdate AS DATE) + CASE WHEN isodow(o_orderdate) > 5 "
    "THEN CAST(8 - isodow(o_orderdate) AS INTEGER) ELSE 0 END)"
)

CTES: dict[str, tuple[str, str]] = {
    "texts": (
        "",
        "SELECT doc_id, concat_ws(' ', text, ("
        + sql_list(inputs.PHRASES)
        + ")[doc_id % 4 + 1]) AS text FROM documents",
    ),
    "labs": (
        "",
        "SELECT doc_id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 ELSE 1 END AS label "
        "FROM labels",
    ),
    "labelled": ("texts labs", "SELECT t.doc_id, text, label FROM texts t JOIN labs USING (doc_id)"),
    "articles": (
        "",
        "SELECT 'T' || (l_suppkey % 5) AS ticker, l_shipdate AS published_time, "
        "(l_quantity - 25) / 25 AS sentiment_score, l_orderkey || '-' || l_linenumber AS url "
        "FROM lineitem",
    ),
    "prices": (
        "",
        f"SELECT 'T' || (o_custkey % 5) AS ticker, {TRADING} AS date, "
        "sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (count(*) * 100.0::DOUBLE) AS adjusted_close FROM orders "
        "GROUP BY 1, 2",
    ),
    "bench": (
        "",
        f"SELECT {TRADING} AS date, "
        "sum(CAST(round(o_totalprice * 100) AS BIGINT)) / (count(*) * 100.0::DOUBLE) AS adjusted_close "
        "FROM orders GROUP BY 1",
    ),
    "daily": (
        "articles",
        "SELECT ticker, CAST(published_time AS DATE) AS published_date, "
        "median(sentiment_score) AS sentiment_score, "
        "coalesce(stddev_samp(sentiment_score), 0.0) AS sentiment_std, "
        "max(abs(sentiment_score)) AS max_abs_sentiment, count(*) AS article_count "
        "FROM articles GROUP BY 1, 2",
    ),
    "dchange": (
        "daily",
        "SELECT *, isodow(published_date) - 1 AS day_of_week, "
        "CASE WHEN count(sentiment_score) OVER w3 = 3 THEN avg(sentiment_score) OVER w3 END AS rolling_sentiment_3, "
        "CASE WHEN count(sentiment_score) OVER w5 = 5 THEN avg(sentiment_score) OVER w5 END AS rolling_sentiment_5, "
        "sentiment_score - lag(sentiment_score) OVER w AS sentiment_change FROM daily "
        "WINDOW w AS (PARTITION BY ticker ORDER BY published_date), "
        "w3 AS (PARTITION BY ticker ORDER BY published_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), "
        "w5 AS (PARTITION BY ticker ORDER BY published_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
    ),
    "dfeat": (
        "dchange",
        "SELECT *, sentiment_change - lag(sentiment_change) OVER "
        "(PARTITION BY ticker ORDER BY published_date) AS sentiment_acceleration FROM dchange",
    ),
    "pret": (
        "prices",
        "SELECT *, (adjusted_close - lag(adjusted_close) OVER w) / nullif(lag(adjusted_close) OVER w, 0) "
        "AS daily_return FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY date)",
    ),
    "pfeat": (
        "pret",
        "SELECT ticker, date, daily_return, lag(daily_return, 1) OVER w AS lag_return_1, "
        "lag(daily_return, 3) OVER w AS lag_return_3, "
        "CASE WHEN count(daily_return) OVER w5 = 5 THEN avg(daily_return) OVER w5 END AS rolling_return_mean_5, "
        "CASE WHEN count(daily_return) OVER w10 = 10 THEN avg(daily_return) OVER w10 END AS rolling_return_mean_10, "
        "CASE WHEN count(daily_return) OVER w5 = 5 THEN stddev_samp(daily_return) OVER w5 END AS rolling_vol_5, "
        "CASE WHEN count(daily_return) OVER w10 = 10 THEN stddev_samp(daily_return) OVER w10 END AS rolling_vol_10 "
        "FROM pret WINDOW w AS (PARTITION BY ticker ORDER BY date), "
        "w5 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), "
        "w10 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)",
    ),
    "paths": (
        "prices",
        "SELECT ticker, date, adjusted_close AS entry, lead(adjusted_close, 2) OVER "
        "(PARTITION BY ticker ORDER BY date) AS exit FROM prices",
    ),
    "bpaths": (
        "bench",
        "SELECT date, adjusted_close AS entry, lead(adjusted_close, 2) OVER (ORDER BY date) AS exit "
        "FROM bench",
    ),
    "fwd": (
        "daily paths",
        "SELECT d.*, (p.exit - p.entry) / nullif(p.entry, 0) AS next_day_return FROM daily d "
        "ASOF LEFT JOIN paths p ON d.ticker = p.ticker AND d.published_date < p.date",
    ),
    "excess": (
        "fwd bpaths",
        "SELECT f.*, (b.exit - b.entry) / nullif(b.entry, 0) AS benchmark_return, "
        "next_day_return - (b.exit - b.entry) / nullif(b.entry, 0) AS excess_return "
        "FROM fwd f ASOF LEFT JOIN bpaths b ON f.published_date < b.date",
    ),
    "feed": (
        "",
        "SELECT event_id AS pos, CASE WHEN event_id % 11 = 3 THEN lower(tk) ELSE tk END AS ticker, "
        "CASE WHEN event_id % 11 = 5 THEN '' ELSE ttl END AS title, "
        "CASE WHEN event_id % 11 = 5 THEN '' ELSE 'http://news/' || user_id || '/' || event_type END AS url, "
        "CASE WHEN event_id % 11 = 7 THEN '' "
        "WHEN event_id % 11 < 6 THEN strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') "
        "ELSE strftime(date_trunc('hour', ts), '%Y%m%dT%H%M%SZ') END AS seendate, "
        "event_type AS domain FROM (SELECT *, (['AAPL','SHOP','JNJ','ZZZ'])[event_id % 4 + 1] AS tk, "
        "(['Apple shares rise','Holiday shopping starts','Johnson & Johnson wins','Markets are quiet',"
        "'zzz Corp and Shopify report'])[(event_id // 4) % 5 + 1] AS ttl FROM events)",
    ),
    "preds": (
        "labs",
        "SELECT *, (1 + (doc_id * 3) % 16 + CASE WHEN prediction = 0 THEN 8 ELSE 0 END)::DOUBLE AS r0, "
        "(1 + (doc_id * 5) % 16 + CASE WHEN prediction = 1 THEN 8 ELSE 0 END)::DOUBLE AS r1, "
        "(1 + (doc_id * 7) % 16 + CASE WHEN prediction = 2 THEN 8 ELSE 0 END)::DOUBLE AS r2 FROM "
        "(SELECT doc_id, label, CASE WHEN (doc_id * 7 + 3) % 10 < 2 "
        "THEN (label + 1 + doc_id % 2) % 3 ELSE label END AS prediction FROM labs)",
    ),
}


def with_ctes(names: list[str], sql: str) -> str:
    """Prefix ``sql`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for parent in CTES[name][0].split():
            visit(parent)
        order.append(name)

    for name in names:
        visit(name)
    if not order:
        return sql
    ctes = ", ".join(f"{n} AS ({CTES[n][1]})" for n in order)
    stripped = sql.lstrip()
    if stripped.upper().startswith("WITH "):
        return f"WITH {ctes}, {stripped[5:]}"
    return f"WITH {ctes} {stripped}"
