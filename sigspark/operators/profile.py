"""Corpus profiles: class counts, lengths, words, keywords, numbers, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .order import row_index

from ..functions import lexicons as lx
from ..functions import text as tx


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def with_label_names(
    df: DataFrame, label_names: Sequence[str] | DataFrame, label: str = "label"
) -> DataFrame:
    """Add ``label_name``; a label without a name shows its number.

    ``label_names`` is an ordered list or a table (label, label_name).
    """
    fallback = F.col(label).cast("string")
    if isinstance(label_names, DataFrame):
        table = label_names.select(F.col("label").alias("_l"), F.col("label_name").alias("_n"))
        return (
            df.join(table, F.col(label) == F.col("_l"), "left")
            .withColumn("label_name", F.coalesce("_n", fallback))
            .drop("_l", "_n")
        )
    names = F.array(*[F.lit(n) for n in label_names])
    inside = (F.col(label) >= 0) & (F.col(label) < len(label_names))
    return df.withColumn(
        "label_name", F.when(inside, F.get(names, F.col(label))).otherwise(fallback)
    )


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, pct of all rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class from here on.
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("pct", _percent(F.col("n"), total))


def length_stats(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """Token-count average, upper median, minimum and maximum per class.

    Works on the (class, length, count) histogram, whose size the longest text bounds.
    """
    histogram = (
        df.select(label, F.size(tx.tokenize(text)).alias("_len"))
        .groupBy(label, "_len")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = Window.partitionBy(label).orderBy("_len")
    whole = Window.partitionBy(label)
    # The upper median is element n // 2 of the sorted lengths, counting from zero.
    middle = F.floor(F.col("_all") / 2) < F.col("_upto")
    return (
        histogram.withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_all", F.sum("_n").over(whole))
        .groupBy(label)
        .agg(
            F.try_divide(
                F.sum(F.col("_len") * F.col("_n")).cast("double"), F.sum("_n").cast("double")
            ).alias("avg_len"),
            F.min(F.when(middle, F.col("_len"))).cast("long").alias("median_len"),
            F.min("_len").cast("long").alias("min_len"),
            F.max("_len").cast("long").alias("max_len"),
        )
    )


def mean_length(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    return df.groupBy(label).agg(F.avg(F.size(tx.tokenize(text))).alias("avg_len"))


def length_profile(df: DataFrame, groups: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Word and character statistics per split: population deviation, interpolated percentiles.

    Word counts are small integers, so the percentile buffers hold few distinct values.
    """
    measured = df.select(
        *groups, tx.word_count(text).alias("_w"), tx.char_count(text).alias("_c")
    )
    out = measured.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_w").alias("mean_words"),
        F.stddev_pop("_w").alias("std_words"),
        F.min("_w").cast("double").alias("min_words"),
        F.percentile("_w", F.array(F.lit(0.5), F.lit(0.9))).alias("_p"),
        F.max("_w").cast("double").alias("max_words"),
        F.avg("_c").alias("mean_chars"),
        F.stddev_pop("_c").alias("std_chars"),
    )
    return out.select(
        *groups, "n", "mean_words", "std_words", "min_words",
        F.col("_p")[0].alias("p50_words"), F.col("_p")[1].alias("p90_words"),
        "max_words", "mean_chars", "std_chars",
    )


def top_per_group(
    counts: DataFrame, group: str, score: str, name: str, n: int, rank: str = "rank"
) -> DataFrame:
    """The ``n`` highest scores per group, ties by name; each task keeps only its own best n."""
    order = Window.partitionBy(group).orderBy(F.col(score).desc(), name)
    return counts.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= n)


def top_words(df: DataFrame, n: int = 15, label: str = "label", text: str = "text") -> DataFrame:
    """Most frequent tokens of the lower-cased text per class."""
    words = (
        # Outer, so that no size filter tokenises the text a second time.
        df.select(label, F.explode_outer(tx.tokenize(F.lower(text))).alias("token"))
        .filter(F.col("token").isNotNull())
        .groupBy(label, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_per_group(words, label, "n", "token", n)


def keyword_document_frequency(
    df: DataFrame,
    keywords: Sequence[str] = lx.FINANCIAL,
    n: int = 10,
    label: str = "label",
    text: str = "text",
) -> DataFrame:
    """Texts per class that hold a keyword, as count and percent of the class; top ``n``."""
    lexicon = F.array(*[F.lit(k) for k in keywords])
    found = F.array_intersect(tx.tokenize(F.lower(text)), lexicon)
    # The class total rides along as one extra "keyword", so the texts are scanned once.
    marked = F.concat(found, F.array(F.lit("")))
    counts = (
        df.select(label, F.explode_outer(marked).alias("keyword"))
        .groupBy(label, "keyword")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most keywords + 1 rows per class.
    total = F.max(F.when(F.col("keyword") == "", F.col("n"))).over(Window.partitionBy(label))
    rated = (
        counts.withColumn("class_total", total)
        .filter(F.col("keyword") != "")
        .withColumn("pct", _percent(F.col("n"), F.col("class_total")))
    )
    return top_per_group(rated, label, "n", "keyword", n)


def number_presence(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """Texts with a number, and with a percentage, per class; classes without any show 0."""
    return (
        df.groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(tx.has_number(text)).alias("has_number"),
            F.count_if(tx.has_percent(text)).alias("has_percent"),
        )
        .withColumn("number_pct", _percent(F.col("has_number"), F.col("n")))
        .withColumn("percent_pct", _percent(F.col("has_percent"), F.col("n")))
    )


def class_sample(df: DataFrame, order: str, n: int = 3, label: str = "label") -> DataFrame:
    """First ``n`` rows of each class; only n rows per class and task are shuffled."""
    by_class = Window.partitionBy(label).orderBy(order)
    return df.withColumn("sample_no", F.row_number().over(by_class)).filter(
        F.col("sample_no") <= n
    )


def rows_per_ticker(df: DataFrame) -> DataFrame:
    """(ticker, n), largest first."""
    return (
        df.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "ticker")
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def encode_labels(df: DataFrame, label: str, out: str = "label_id") -> DataFrame:
    """Text labels to 0-based positions in their sorted distinct list.

    The distinct labels are numbered in buckets of their first two bytes, so that no task sorts them
    all."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    lead = F.rpad(F.hex(F.substring(F.encode(F.col(label).cast("string"), "utf-8"), 1, 2)), 4, "0")
    return df.join(row_index(classes, [label], F.conv(lead, 16, 10).cast("int"), out=out), label, "left")
