"""The driver tables in the roles of the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as lx

TICKERS = 5

# Added to every text so that negators, contractions, numbers and keywords occur in all classes.
PHRASES = (
    "Profit rose 12.5% and sales didn't fall.",
    "No dividend, no growth: the loss of 3 units isn't new.",
    "Revenue of $40 million never exceeded the forecast not",
    "The board has not met + earnings weren't stated - nothing else.",
)

LANG_SUBSET = dict(zip(("en", "de", "fr", "es"), lx.SUBSETS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", *extra)


def phrase(id_column: str):
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    return F.get(phrases, F.pmod(F.col(id_column), F.lit(len(PHRASES))).cast("int"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text): whole documents with a phrase appended."""
    return documents(spark, folder).select(
        "doc_id", F.concat_ws(" ", "text", phrase("doc_id")).alias("text")
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, label): 0 toxic, 2 good, 1 otherwise."""
    return table(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1).alias("label"),
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text, label)."""
    return texts(spark, folder).join(labels(spark, folder), "doc_id")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, published_time, sentiment_score, url) from line items."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("T"), F.pmod("l_suppkey", F.lit(TICKERS)).cast("string")).alias("ticker"),
        F.col("l_shipdate").alias("published_time"),
        ((F.col("l_quantity") - 25) / 25).alias("sentiment_score"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("url"),
    )


def _mean_price():
    # Summed in cents: the same on every engine, whatever the order of the rows.
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return F.sum(cents) / (F.count(F.lit(1)) * F.lit(100.0))


def trading_day(ts: str):
    """The day itself, or the Monday after a weekend day."""
    day = F.to_date(ts)
    return F.date_add(day, F.when(F.weekday(day) >= 5, 7 - F.weekday(day)).otherwise(0))


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, date, adjusted_close) on weekdays, from order totals; a weekend's orders count on the
    Monday after it."""
    return (
        table(spark, folder, "orders")
        .select(
            F.concat(F.lit("T"), F.pmod("o_custkey", F.lit(TICKERS)).cast("string")).alias("ticker"),
            trading_day("o_orderdate").alias("date"),
            "o_totalprice",
        )
        .groupBy("ticker", "date")
        .agg(_mean_price().alias("adjusted_close"))
    )


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """(date, adjusted_close) over all customers."""
    return (
        table(spark, folder, "orders")
        .select(trading_day("o_orderdate").alias("date"), "o_totalprice")
        .groupBy("date")
        .agg(_mean_price().alias("adjusted_close"))
    )


def headline_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed rows from events: many copies per (url, seendate), both time formats, blanks.

    ``pos`` is the arrival order.
    """
    ts = F.col("ts")
    compact = F.date_format(F.date_trunc("hour", ts), "yyyyMMddHHmmss")
    iso = F.date_format(F.date_trunc("hour", ts), "yyyyMMdd'T'HHmmss'Z'")
    kind = F.pmod("event_id", F.lit(11))
    ticker = F.get(
        F.array(*[F.lit(t) for t in ("AAPL", "SHOP", "JNJ", "ZZZ")]),
        F.pmod("event_id", F.lit(4)).cast("int"),
    )
    title = F.get(
        F.array(
            F.lit("Apple shares rise"),
            F.lit("Holiday shopping starts"),
            F.lit("Johnson & Johnson wins"),
            F.lit("Markets are quiet"),
            F.lit("zzz Corp and Shopify report"),
        ),
        F.pmod(F.floor(F.col("event_id") / 4), F.lit(5)).cast("int"),
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("pos"),
        F.when(kind == 3, F.lower(ticker)).otherwise(ticker).alias("ticker"),
        F.when(kind == 5, F.lit("")).otherwise(title).alias("title"),
        F.when(kind == 5, F.lit("")).otherwise(
            F.concat(F.lit("http://news/"), F.col("user_id"), F.lit("/"), F.col("event_type"))
        ).alias("url"),
        F.when(kind == 7, F.lit("")).when(kind < 6, compact).otherwise(iso).alias("seendate"),
        F.col("event_type").alias("domain"),
        F.lit("English").alias("language"),
        F.lit("").alias("sourcecountry"),
        F.lit("").alias("socialimage"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, label, prediction, proba) by arithmetic on ids: right about 8 times of 10."""
    base = labels(spark, folder)
    wrong = F.pmod(F.col("doc_id") * 7 + 3, F.lit(10)) < 2
    p = base.withColumn(
        "prediction",
        F.when(wrong, F.pmod(F.col("label") + 1 + F.pmod("doc_id", F.lit(2)), F.lit(3)))
        .otherwise(F.col("label")).cast("int"),
    )
    noise = [F.pmod(F.col("doc_id") * m, F.lit(16)) for m in (3, 5, 7)]
    raw = [
        F.lit(1) + noise[i] + F.when(F.col("prediction") == i, 8).otherwise(0) for i in range(3)
    ]
    total = raw[0] + raw[1] + raw[2]
    return p.withColumn("proba", F.array(*[r / total for r in raw]))


def model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of three models in two runs over the four subsets.

    The second run is better; the SVM has no probabilities; one run misses one subset.
    """
    base = (
        labels(spark, folder)
        .join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
        .withColumn("subset", F.get(
            F.array(*[F.lit(s) for s in lx.SUBSETS]),
            F.array_position(F.array(*[F.lit(x) for x in LANG_SUBSET]), F.col("lang")).cast("int") - 1,
        ))
    )
    grid = F.array(
        *[
            F.struct(F.lit(run).alias("run"), F.lit(name).alias("model"), F.lit(i).alias("model_no"),
                     F.lit(r).alias("run_no"))
            for r, run in enumerate(("tfidf", "encoder"))
            for i, name in enumerate(("logistic_regression", "linear_svm", "boosted_trees"))
        ]
    )
    rows = base.select("doc_id", "label", "subset", F.inline(grid)).filter(
        ~((F.col("run") == "encoder") & (F.col("subset") == lx.SUBSETS[3]))
    )
    draw = F.pmod(F.col("doc_id") * (F.col("model_no") * 2 + 3) + F.col("run_no"), F.lit(20))
    wrong = draw < (F.lit(7) - 4 * F.col("run_no") - F.pmod(F.col("model_no"), F.lit(2)))
    rows = rows.withColumn(
        "prediction",
        F.when(wrong, F.pmod(F.col("label") + 1 + F.pmod("doc_id", F.lit(2)), F.lit(3)))
        .otherwise(F.col("label")).cast("int"),
    )
    raw = [
        F.lit(1) + F.pmod(F.col("doc_id") * m, F.lit(16))
        + F.when(F.col("prediction") == i, 8).otherwise(0)
        for i, m in enumerate((3, 5, 7))
    ]
    total = raw[0] + raw[1] + raw[2]
    return rows.withColumn(
        "proba", F.when(F.col("model") != "linear_svm", F.array(*[r / total for r in raw]))
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, embedding, label)."""
    return table(spark, folder, "embeddings")


def probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, proba): every embedding component adds to one of three classes in turn; the sums of
    absolute values are normalised."""

    def part(k: int):
        own = F.filter("embedding", lambda x, i: i % 3 == k)
        return F.aggregate(own, F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))

    sums = vectors(spark, folder).select("vec_id", *[part(k).alias(f"p{k}") for k in range(3)])
    total = F.col("p0") + F.col("p1") + F.col("p2")
    return sums.select("vec_id", F.array(*[F.col(f"p{k}") / total for k in range(3)]).alias("proba"))
