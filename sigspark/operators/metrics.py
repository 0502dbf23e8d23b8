"""Signal, regression and classification metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialise
from .order import average_ranks, bucket_by_value, prefix_sums


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def spearman(df: DataFrame, a: str, b: str, buckets: int | None = None) -> DataFrame:
    """One row ``spearman_corr``: Pearson correlation of the average ranks of the complete pairs.

    Ranks have mean (n + 1) / 2 by construction, so the sums are taken around it.
    """
    df = df.select(a, b).na.drop()
    pairs = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("_c"))
    rank_a = average_ranks(df, a, (), buckets).select(a, F.col("avg_rank").alias("_ra"))
    rank_b = average_ranks(df, b, (), buckets).select(b, F.col("avg_rank").alias("_rb"))
    mean = df.agg((F.count(F.lit(1)) + 1) / 2).scalar()
    x, y = F.col("_ra") - F.col("_mean"), F.col("_rb") - F.col("_mean")
    sums = (
        pairs.join(rank_a, a)
        .join(rank_b, b)
        .withColumn("_mean", mean)
        .agg(
            F.sum(F.col("_c") * x * y).alias("xy"),
            F.sum(F.col("_c") * x * x).alias("xx"),
            F.sum(F.col("_c") * y * y).alias("yy"),
        )
    )
    return sums.select(
        F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("spearman_corr")
    )


def signal_eval(
    df: DataFrame,
    score: str,
    target: str,
    buckets: int | None = None,
) -> DataFrame:
    """One row: n, Pearson, Spearman, directional accuracy, mean absolute difference.

    Zero counts as "not up" on both sides. Without rows n is 0 and the rest null.
    """
    # Read seven times below, and small next to the articles it comes from: computed once.
    data = materialise(df.select(score, target).na.drop())
    up = (F.col(score) > 0) == (F.col(target) > 0)
    plain = data.agg(
        F.count(F.lit(1)).alias("n"),
        _no_nan(F.corr(score, target)).alias("pearson_corr"),
        F.avg(up.cast("double")).alias("directional_accuracy"),
        F.avg(F.abs(F.col(target) - F.col(score))).alias("mae"),
    )
    ranked = spearman(data, score, target, buckets)
    return plain.withColumn("spearman_corr", ranked.scalar()).select(
        "n", "pearson_corr", "spearman_corr", "directional_accuracy", "mae"
    )


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, groups: Sequence[str] = ()
) -> DataFrame:
    """n, MAE, RMSE and R² in one pass; R² is null when the actual values do not vary."""
    error = F.col(actual) - F.col(predicted)
    total = F.var_pop(actual) * F.count(F.lit(1))
    return (
        df.groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.sum(error * error).alias("_sse"),
            total.alias("_sst"),
        )
        .withColumn("r2", F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")))
        .drop("_sse", "_sst")
    )


# --- classification ---------------------------------------------------------------------------


def within(column: str, classes: Sequence[int]) -> Column:
    """The class number; one outside ``classes`` is an error. Null stays null."""
    c = F.col(column).cast("int")
    wrong = F.concat(F.lit(f"{column} outside the classes: "), c.cast("string"))
    return F.when(c.isNull() | c.isin(*[int(k) for k in classes]), c).otherwise(F.raise_error(wrong).cast("int"))


def confusion(
    df: DataFrame,
    label: str = "label",
    predicted: str = "prediction",
    classes: Sequence[int] | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """(groups, label, prediction, n) over the whole class grid, zeros included.

    Rows are counted first; the grid is built from the counts. ``classes`` fixes the classes, and a
    label or prediction outside them is an error; otherwise those seen as either are used.
    """
    groups = list(groups)
    if classes is not None:
        df = df.withColumns({c: within(c, classes) for c in (label, predicted)})
    counts = (
        df.groupBy(*groups, F.col(label).cast("int").alias("label"),
                   F.col(predicted).cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if classes is not None:
        every = F.array(*[F.lit(int(c)) for c in classes])
        base = counts.select(*groups).distinct() if groups else df.sparkSession.range(1).select()
        grid = base.withColumn("_c", every)
    else:
        grid = counts.groupBy(*groups).agg(
            F.array_distinct(
                F.concat(F.collect_set("label"), F.collect_set("prediction"))
            ).alias("_c")
        )
    grid = (
        grid.withColumn("label", F.explode("_c"))
        .withColumn("prediction", F.explode("_c"))
        .drop("_c")
    )
    return grid.join(counts, [*groups, "label", "prediction"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("long"))
    )


def confusion_wide(counts: DataFrame, classes: Sequence[int], groups: Sequence[str] = ()) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    return (
        counts.groupBy(*groups, "label")
        .pivot("prediction", list(classes))
        .agg(F.first("n"))
        .na.fill(0)
    )


def confusion_normalised(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Add ``fraction`` of the actual class; 0 for a class without rows."""
    row = Window.partitionBy(*groups, "label")
    return counts.withColumn("fraction", _ratio(F.col("n"), F.sum("n").over(row)))


def class_scores(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, label, precision, recall, f1, support, hits) from a confusion grid.

    An empty denominator gives 0.
    """
    groups = list(groups)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    # Each cell counts once for its actual class and once for its predicted class.
    sides = counts.select(
        *groups,
        F.explode(
            F.array(
                F.struct(F.col("label").alias("c"), F.col("n").alias("actual"),
                         F.lit(0).cast("long").alias("called"), hit.cast("long").alias("hits")),
                F.struct(F.col("prediction").alias("c"), F.lit(0).cast("long").alias("actual"),
                         F.col("n").alias("called"), F.lit(0).cast("long").alias("hits")),
            )
        ).alias("s"),
    )
    sums = sides.groupBy(*groups, F.col("s.c").alias("label")).agg(
        F.sum("s.actual").alias("support"),
        F.sum("s.called").alias("_called"),
        F.sum("s.hits").alias("hits"),
    )
    return (
        sums.withColumn("precision", _ratio(F.col("hits"), F.col("_called")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(2 * F.col("hits"), F.col("_called") + F.col("support")))
        .select(*groups, "label", "precision", "recall", "f1", "support", "hits")
    )


def summary_scores(scores: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and support-weighted averages; one row per group."""
    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    return scores.groupBy(*groups).agg(
        F.sum("support").alias("support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )


def class_report(scores: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Report rows: one per class, then accuracy, macro avg and weighted avg."""
    groups = list(groups)
    total = summary_scores(scores, groups)
    classes = scores.select(
        *groups, F.col("label").cast("string").alias("entry"),
        "precision", "recall", F.col("f1").alias("f1_score"), "support",
    )
    none = F.lit(None).cast("double")
    entries = F.array(
        F.struct(F.lit("accuracy").alias("entry"), none.alias("precision"), none.alias("recall"),
                 F.col("accuracy").alias("f1_score"), F.col("support")),
        *[
            F.struct(F.lit(f"{kind} avg").alias("entry"),
                     F.col(f"{kind}_precision").alias("precision"),
                     F.col(f"{kind}_recall").alias("recall"),
                     F.col(f"{kind}_f1").alias("f1_score"), F.col("support"))
            for kind in ("macro", "weighted")
        ],
    )
    return classes.unionByName(total.select(*groups, F.inline(entries)))


def roc_auc_ovr(
    df: DataFrame,
    label: str,
    proba: str,
    classes: int,
    groups: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """(groups, class, auc): one-vs-rest area under the ROC curve from average ranks.

    Scores are reduced to a (class, score) histogram before they are ranked. A class without
    positives or without negatives gets null. A list of another length than ``classes`` is an error.
    """
    groups = list(groups)
    wrong = F.concat(F.lit(f"expected {classes} probabilities, got "), F.size(proba).cast("string"))
    checked = F.when(F.size(proba) == classes, F.col(proba)).otherwise(
        F.raise_error(wrong).cast(df.schema[proba].dataType)
    )
    each = df.filter(F.col(proba).isNotNull()).select(
        *groups, F.col(label).cast("int").alias("_y"), F.posexplode(checked).alias("class", "_s")
    )
    keys = [*groups, "class"]
    counts = each.groupBy(*keys, F.col("_s").cast("double").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_y") == F.col("class")).alias("_p")
    )
    cut = bucket_by_value(counts, "_s", buckets)
    ranked = prefix_sums(cut, ["_s"], F.col("_n"), keys)
    rank = F.col("before") + (F.col("_n") + 1) / 2
    sums = ranked.groupBy(*keys).agg(
        F.sum(F.col("_p") * rank).alias("_r"), F.sum("_p").alias("_p"), F.sum("_n").alias("_n")
    )
    p, q = F.col("_p").cast("double"), (F.col("_n") - F.col("_p")).cast("double")
    return sums.select(
        *keys, F.try_divide(F.col("_r") - p * (p + 1) / 2, p * q).alias("auc")
    )


def macro_auc(per_class: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Mean over the classes; null as soon as one class has none."""
    return per_class.groupBy(*groups).agg(
        F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).alias("roc_auc_ovr")
    )


def fold_summary(
    folds: DataFrame, metrics: Sequence[str], fold: str = "fold", groups: Sequence[str] = ()
) -> DataFrame:
    """Mean and per-fold list of each metric; there are only as many rows as folds."""
    out = []
    for name in metrics:
        ordered = F.array_sort(F.collect_list(F.struct(F.col(fold), F.col(name))))
        out.append(F.avg(name).alias(f"mean_{name}"))
        out.append(ordered.getField(name).alias(f"per_fold_{name}"))
    return folds.groupBy(*groups).agg(*out)


def class_weights(df: DataFrame, label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """(label, n, weight) with weight n_total / (classes * n)."""
    counts = df.groupBy(*groups, label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(*(groups or [F.lit(0)]))
    return counts.withColumn(
        "weight",
        F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n")),
    )


def positive_weight(df: DataFrame, label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """Negatives per positive of a 0/1 label; 1 when there are no positives."""
    return df.groupBy(*groups).agg(
        F.count_if(F.col(label) == 0).alias("n_neg"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
    ).withColumn(
        "positive_weight", F.coalesce(F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos").cast("double")), F.lit(1.0))
    )


def evaluation_records(
    predictions: DataFrame,
    class_names: Sequence[str],
    groups: Sequence[str] = (),
    *,
    label: str = "label",
    predicted: str = "prediction",
    proba: str | None = None,
) -> DataFrame:
    """(groups, metrics): one record per group in the layout of a result document.

    One aggregate by cell, then one row per group with its k * k cells; the rest is arithmetic on
    that row. Groups whose probabilities are all null get no AUC; a class without a name is an error.
    """
    k = len(class_names)
    keys = list(groups) or ["_all"]
    if not groups:
        predictions = predictions.withColumn("_all", F.lit(0))
    each = F.sequence(F.lit(0), F.lit(k - 1))
    zero = F.lit(0).cast("long")
    y, p = within(label, range(k)), within(predicted, range(k))
    cells = (
        predictions.groupBy(*keys, (y * k + p).alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("_cell", "_n"))).alias("_cells"))
    )

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda acc, n: acc + n)

    def divided(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, _ratio)

    def averaged(values: str, weights: str | None = None) -> Column:
        terms = F.col(values) if weights is None else F.zip_with(values, weights, lambda v, w: v * w)
        sums = F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
        return sums / k if weights is None else _ratio(sums, F.col("_support"))

    joined = (
        cells.withColumn(
            "confusion_matrix",
            F.transform(each, lambda i: F.transform(
                each, lambda j: F.coalesce(F.try_element_at("_cells", i * k + j), zero)
            )),
        )
        .withColumns({
            "support": F.transform("confusion_matrix", total),
            "_called": F.transform(each, lambda j: total(
                F.transform("confusion_matrix", lambda row: F.get(row, j))
            )),
            "_hits": F.transform(each, lambda i: F.get(F.get("confusion_matrix", i), i)),
        })
        .withColumns({
            "precision": divided(F.col("_hits"), F.col("_called")),
            "recall": divided(F.col("_hits"), F.col("support")),
            "f1": divided(
                F.transform("_hits", lambda h: h * 2),
                F.zip_with("_called", "support", lambda a, b: a + b),
            ),
            "_support": total(F.col("support")),
        })
        .withColumns({
            "accuracy": _ratio(total(F.col("_hits")), F.col("_support")),
            **{f"macro_{c}": averaged(c) for c in ("precision", "recall", "f1")},
            **{f"weighted_{c}": averaged(c, "support") for c in ("precision", "recall", "f1")},
        })
    )
    if proba is None:
        joined = joined.withColumn("roc_auc_ovr", F.lit(None).cast("double"))
    else:
        scored = predictions.filter(F.col(proba).isNotNull())
        joined = joined.join(
            macro_auc(roc_auc_ovr(scored, label, proba, k, keys), keys), keys, "left"
        )

    def entry(p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.to_json(
            F.struct(
                p.alias("precision"), r.alias("recall"), f.alias("f1-score"),
                s.cast("double").alias("support"),
            )
        )

    names = F.array(*[F.lit(n) for n in class_names])
    class_entries = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.struct(
            F.get(names, i).alias("key"),
            entry(*[F.get(c, i) for c in ("precision", "recall", "f1", "support")]).alias("value"),
        ),
    )
    totals_entries = F.array(
        F.struct(F.lit("accuracy").alias("key"), F.col("accuracy").cast("string").alias("value")),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("key"),
                entry(
                    *[F.col(f"{kind}_{c}") for c in ("precision", "recall", "f1")],
                    F.col("_support"),
                ).alias("value"),
            )
            for kind in ("macro", "weighted")
        ],
    )
    return joined.select(
        *groups,
        F.struct(
            "accuracy",
            F.col("macro_precision").alias("precision"),
            F.col("macro_recall").alias("recall"),
            "macro_precision",
            "macro_recall",
            "macro_f1",
            "roc_auc_ovr",
            F.struct("precision", "recall", "f1").alias("per_class"),
            "confusion_matrix",
            F.map_from_entries(F.concat(class_entries, totals_entries)).alias(
                "classification_report"
            ),
        ).alias("metrics"),
    )
