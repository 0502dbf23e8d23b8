"""Positions, ranks, quantiles and splits in a global or per-group order.

Everything here is one idea: cut the order into buckets that follow it, count rows per bucket,
turn those few counts into offsets, and number rows inside each bucket. No window spans a whole
group, so one group holding most of the data is still spread over all buckets. There is one plan
for every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET = "_bucket"


def default_buckets(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bucket_by_value(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``, non-decreasing in numeric ``column``, with about equal row counts.

    The boundaries come from one approximate-quantile pass and are then literals, so every use of
    the result agrees on them, also when a lost partition is computed again. Infinite values are in
    the first and the last bucket.
    """
    buckets = buckets or default_buckets(df)
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = df.select(F.col(column).cast("double").alias("_v")).approxQuantile(
        "_v", probabilities, 0.25 / buckets
    )
    splits = [float("-inf"), *sorted({c for c in cuts if isfinite(c)}), float("inf")]
    if len(splits) == 2:
        return df.withColumn(BUCKET, F.lit(0))
    cutter = Bucketizer(splits=splits, inputCol="_cut", outputCol=BUCKET, handleInvalid="keep")
    cut = cutter.transform(df.withColumn("_cut", F.col(column).cast("double"))).drop("_cut")
    return cut.withColumn(BUCKET, F.col(BUCKET).cast("int"))


def hash_bits(df: DataFrame) -> int:
    """Leading bits of a hash that make about sixteen buckets for each shuffle partition."""
    return max(12, (16 * default_buckets(df)).bit_length())


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    weight: Column | int = 1,
    groups: Sequence[str] = (),
    out: str = "before",
) -> DataFrame:
    """Sum of ``weight`` over all rows of the same group that sort before the row.

    ``df`` carries ``_bucket`` following ``order``; rows of a group must differ in ``order`` and
    group columns must not be null.
    """
    groups = list(groups)
    weighted = df.withColumn("_w", F.lit(weight) if isinstance(weight, int) else weight)
    ahead = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(BUCKET)
    offsets = (
        weighted.groupBy(*groups, BUCKET)
        .agg(F.sum("_w").alias("_t"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_t").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("_t")
    )
    inside = (
        Window.partitionBy(*groups, BUCKET)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        weighted.withColumn("_inside", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
        .join(offsets, [*groups, BUCKET])
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_offset", "_inside", "_w", BUCKET)
    )


def value_counts(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct non-null value of ``column``, per group; counted before the shuffle."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
        .groupBy(*groups, column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def average_ranks(
    df: DataFrame,
    column: str,
    groups: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """(groups, value, n, avg_rank): 1-based rank of each distinct value, ties averaged."""
    counts = value_counts(df, column, groups)
    cut = bucket_by_value(counts, column, buckets)
    return prefix_sums(cut, [column], F.col("n"), groups).select(
        *groups, column, "n", (F.col("before") + (F.col("n") + 1) / 2).alias("avg_rank")
    )


def row_index(
    df: DataFrame,
    order: Sequence[str],
    coarse: Column | str,
    groups: Sequence[str] = (),
    out: str = "row_index",
) -> DataFrame:
    """0-based position in ``order``. ``coarse`` is a leading part of the order (such as the day,
    or the leading bits of a hash) that has many values, none of them holding a large share."""
    return prefix_sums(
        df.withColumn(BUCKET, F.col(coarse) if isinstance(coarse, str) else coarse),
        order,
        1,
        groups,
        out,
    )


def group_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    column: str,
    probabilities: dict[str, float],
    buckets: int | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, safe for groups of any size."""
    groups = list(groups)
    counts = value_counts(df, column, groups)
    cut = bucket_by_value(counts, column, buckets)
    ranked = prefix_sums(cut, [column], F.col("n"), groups)
    sizes = counts.groupBy(*groups).agg(F.sum("n").alias("_size"))
    placed = ranked.join(sizes, groups) if groups else ranked.withColumn("_size", sizes.scalar())

    def at(position: Column) -> Column:
        here = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
        return F.max(F.when(here, F.col(column).cast("double")))

    aggregates = []
    for name, p in probabilities.items():
        place = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)
        aggregates += [
            at(low).alias(f"_{name}_low"),
            at(high).alias(f"_{name}_high"),
            F.max(place - low).alias(f"_{name}_part"),
        ]
    out = placed.groupBy(*groups).agg(*aggregates)
    return out.select(
        *groups,
        *[
            (
                F.col(f"_{name}_low") * (1 - F.col(f"_{name}_part"))
                + F.col(f"_{name}_high") * F.col(f"_{name}_part")
            ).alias(name)
            for name in probabilities
        ],
    )


def group_median(df: DataFrame, groups: Sequence[str], column: str, out: str) -> DataFrame:
    """Exact median per group, whatever the group sizes: values are counted, then found by position."""
    return group_quantiles(df.select(*groups, column), groups, column, {out: 0.5})


# --- splits -----------------------------------------------------------------------------------


def shuffle_key(id_column: Column | str, seed: int) -> Column:
    """A 60-bit pseudo-random number from an id and a seed, the same on every run and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string"))
                   if isinstance(id_column, str)
                   else F.concat_ws(":", F.lit(str(seed)), id_column.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _shuffled_index(df: DataFrame, label: str, id_column: str, seed: int) -> DataFrame:
    keyed = df.withColumn("_key", shuffle_key(id_column, seed))
    return row_index(
        keyed,
        ["_key", id_column],
        F.shiftright("_key", 60 - hash_bits(df)),
        groups=[label],
        out="_place",
    ).drop("_key")


def stratified_split(
    df: DataFrame,
    label: str,
    id_column: str,
    *,
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``part`` (train or test): exactly ceil(test_size * n) test rows, classes in proportion.

    Each class gets the floor of its share; the rows left over go to the largest remainders, ties
    to the smaller label. Members are the first rows in a seeded hash order.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(0))
    quota = (
        sizes.withColumn("_total", F.sum("_n").over(everything))
        .withColumn("_want", F.ceil(F.round(F.col("_total") * F.lit(test_size), 9)))
        .withColumn("_share", F.col("_want") * F.col("_n") / F.col("_total"))
        .withColumn("_base", F.floor(F.round("_share", 9)))
        .withColumn("_left", F.col("_want") - F.sum("_base").over(everything))
        .withColumn(
            "_turn",
            F.row_number().over(
                everything.orderBy(F.round(F.col("_share") - F.col("_base"), 9).desc(), label)
            ),
        )
        .select(
            label,
            (F.col("_base") + F.when(F.col("_turn") <= F.col("_left"), 1).otherwise(0)).alias(
                "_quota"
            ),
        )
    )
    placed = _shuffled_index(df, label, id_column, seed)
    return (
        placed.join(quota, label)
        .withColumn(
            "part", F.when(F.col("_place") < F.col("_quota"), "test").otherwise("train")
        )
        .drop("_place", "_quota")
    )


def stratified_folds(
    df: DataFrame, label: str, id_column: str, *, k: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Add a fold number 0..k-1 that deals each class evenly over the folds."""
    if k < 2:
        raise ValueError("k must be at least 2")
    placed = _shuffled_index(df, label, id_column, seed)
    return placed.withColumn(out, F.pmod("_place", F.lit(k)).cast("int")).drop("_place")


def time_split(
    df: DataFrame, order: Sequence[str], coarse: str, *, train_share: float = 0.8
) -> DataFrame:
    """Add ``part``: the first int(train_share * n) rows in ``order`` train, the others test."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        row_index(df, order, coarse, out="_place")
        .withColumn("_n", F.floor(total * F.lit(train_share)))
        .withColumn("part", F.when(F.col("_place") < F.col("_n"), "train").otherwise("test"))
        .drop("_place", "_n")
    )


def time_folds(df: DataFrame, order: Sequence[str], coarse: str, *, splits: int = 5) -> DataFrame:
    """Expanding-window folds: (row columns, ``fold``, ``part``), one copy of a row per fold.

    Test blocks have n // (splits + 1) rows and close the order; everything before is training.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    block = F.floor(F.col("_n") / F.lit(splits + 1))
    start = F.col("_n") - (F.lit(splits) - F.col("fold")) * block
    return (
        row_index(df, order, coarse, out="_place")
        .withColumn("_n", total)
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
        .withColumn(
            "part",
            F.when(F.col("_place") < start, "train").when(
                F.col("_place") < start + block, "test"
            ),
        )
        .filter(F.col("part").isNotNull())
        .drop("_place", "_n")
    )
