"""Tables over result documents: flattening, best models, comparisons, coefficients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicons as lx
from ..sources.results import subset_order

# Report entries that are not classes.
REPORT_TOTALS = ("accuracy", "macro avg", "weighted avg", "micro avg", "samples avg")


def model_rows(results: DataFrame, *keep: str) -> DataFrame:
    """One row per model of each result document, with its position."""
    return results.select(*keep, F.posexplode("models").alias("pos", "_m")).select(
        *keep, "pos", "_m.*"
    )


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def metric_with_fallback(name: str, metrics: str = "metrics") -> Column:
    """Precision or recall: the plain value, else the report's macro average, else the mean over
    the classes."""
    m = F.col(metrics)
    macro = F.get_json_object(
        F.try_element_at(m["classification_report"], F.lit("macro avg")), f"$.{name}"
    ).cast("double")
    return F.coalesce(m[name], macro, _mean(m["per_class"][name]))


def report_classes(report: Column | str) -> Column:
    """Class names of a report: its keys without the totals, holding objects only."""
    report = F.col(report) if isinstance(report, str) else report
    objects = F.map_filter(
        report, lambda k, v: ~k.isin(*REPORT_TOTALS) & F.startswith(F.ltrim(v), F.lit("{"))
    )
    return F.map_keys(objects)


def flatten_results(results: DataFrame, *keep: str) -> DataFrame:
    """One flat row per model; missing values stay null so the columns never change."""
    m = F.col("metrics")
    return model_rows(results, *keep).select(
        *keep,
        F.col("name").alias("model"),
        m["accuracy"].alias("accuracy"),
        F.coalesce(m["precision"], m["macro_precision"]).alias("precision"),
        F.coalesce(m["recall"], m["macro_recall"]).alias("recall"),
        m["macro_f1"].alias("macro_f1"),
        m["roc_auc_ovr"].alias("roc_auc_ovr"),
    )


def best_models(
    results: DataFrame,
    keys: Sequence[str] = ("subset",),
    *,
    restrict_to: Sequence[str] | None = None,
    missing_as_zero: bool = False,
) -> DataFrame:
    """Model with the highest macro F1 per key; the earlier one wins a tie.

    A model without macro F1 is skipped, or counts as 0 with ``missing_as_zero``.
    """
    models = model_rows(results, *keys).filter(F.coalesce("name", F.lit("")) != "")
    if restrict_to is not None:
        models = models.filter(F.col("name").isin(*restrict_to))
    score = F.col("metrics")["macro_f1"]
    if missing_as_zero:
        score = F.coalesce(score, F.lit(0.0))
    return (
        models.withColumn("_f1", score)
        .filter(F.col("_f1").isNotNull() & ~F.isnan("_f1"))
        .groupBy(*keys)
        .agg(F.max_by(F.struct("name", "metrics"), F.struct("_f1", -F.col("pos"))).alias("_best"))
        .select(*keys, "_best.*")
    )


def _two_decimals(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.2f", F.bround(value, 2))).otherwise("")


def _subset_grid(spark: SparkSession, subsets: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(s, i) for i, s in enumerate(subsets)], "subset string, place int")


def _table(models: DataFrame, grid: DataFrame, *names: str, text: bool) -> DataFrame:
    m = F.col("metrics")
    values = {
        "macro_f1": m["macro_f1"],
        "roc_auc": m["roc_auc_ovr"],
        "precision": metric_with_fallback("precision"),
        "recall": metric_with_fallback("recall"),
    }
    joined = grid.join(models, "subset", "left")
    return joined.select(
        "subset",
        "place",
        *names,
        *[(_two_decimals(v) if text else v).alias(k) for k, v in values.items()],
    )


def model_subset_table(
    results: DataFrame,
    model: str,
    subsets: Sequence[str] = lx.SUBSETS,
    *,
    text: bool = True,
) -> DataFrame:
    """Metrics of one model per subset, in the given order; blank (or null) where missing."""
    # The last entry of a name wins when a document lists it twice.
    models = (
        model_rows(results, "subset")
        .filter(F.col("name") == model)
        .groupBy("subset")
        .agg(F.max_by("metrics", "pos").alias("metrics"))
    )
    grid = _subset_grid(results.sparkSession, subsets)
    return _table(models, grid, text=text).orderBy("place").drop("place")


def best_model_table(
    results: DataFrame,
    subsets: Sequence[str] = lx.SUBSETS,
    *,
    restrict_to: Sequence[str] | None = None,
    text: bool = True,
) -> DataFrame:
    """Best model and its metrics per subset, in the given order."""
    best = best_models(results, restrict_to=restrict_to).withColumnRenamed("name", "best_model")
    grid = _subset_grid(results.sparkSession, subsets)
    name = F.coalesce("best_model", F.lit("")) if text else F.col("best_model")
    return (
        _table(best, grid, "best_model", text=text)
        .withColumn("best_model", name)
        .orderBy("place")
        .drop("place")
    )


def ordered_subsets(results: DataFrame) -> DataFrame:
    """Subsets found, canonical ones first."""
    return (
        results.select("subset").distinct().orderBy(subset_order("subset"), "subset")
    )


def comparison_rows(results: DataFrame, run: str = "run") -> DataFrame:
    """Best model per run and subset with the F1 of the three classes and the confusion matrix."""
    best = best_models(results, (run, "subset"), missing_as_zero=True)
    m = F.col("metrics")
    f1 = m["per_class"]["f1"]
    return best.select(
        run,
        F.regexp_replace("subset", "sentences_", "").alias("subset"),
        F.col("name").alias("model"),
        m["accuracy"].alias("accuracy"),
        m["macro_f1"].alias("macro_f1"),
        m["roc_auc_ovr"].alias("roc_auc_ovr"),
        *[F.get(f1, F.lit(i)).alias(f"f1_{name}") for i, name in enumerate(lx.LABEL_NAMES)],
        m["confusion_matrix"].alias("confusion_matrix"),
    )


def compare_runs(
    rows: DataFrame,
    left: str,
    right: str,
    metrics: Sequence[str] = ("accuracy", "macro_f1", "f1_negative", "f1_neutral", "f1_positive"),
    run: str = "run",
) -> DataFrame:
    """Both runs side by side per subset, with right minus left; a missing side is null."""

    def side(name: str, tag: str) -> DataFrame:
        return rows.filter(F.col(run) == name).select(
            "subset",
            F.col("model").alias(f"model_{tag}"),
            *[F.col(m).alias(f"{m}_{tag}") for m in metrics],
        )

    joined = side(left, "left").join(side(right, "right"), "subset", "full_outer")
    return joined.withColumns(
        {f"{m}_delta": F.col(f"{m}_right") - F.col(f"{m}_left") for m in metrics}
    )


def metric_series(
    rows: DataFrame,
    metrics: Sequence[str] = ("macro_f1", "accuracy"),
    run: str = "run",
    canonical: Sequence[str] = tuple(s.replace("sentences_", "") for s in lx.SUBSETS),
) -> DataFrame:
    """(subset, run, metrics) over the whole subset x run grid, 0 where a run is missing."""
    # A report holds few runs; their names fit in one list.
    runs = rows.agg(F.collect_set(run)).scalar()
    grid = rows.select("subset").distinct().withColumn(run, F.explode(runs))
    return (
        grid.join(rows.select("subset", run, *metrics), ["subset", run], "left")
        .na.fill(0.0, list(metrics))
        .orderBy(subset_order("subset", canonical), "subset", run)
    )


def coefficient_rows(weights: DataFrame, names: DataFrame, classes: Sequence[str]) -> DataFrame:
    """(class, feature, coef) from a table of weights (pos, class number, weight) and names (pos, feature). A feature
    that a class has no weight for has coefficient 0; a weight without a name becomes ``feature_<i>``, the
    intercept (pos -1) is left out. A join; the coefficients never are in one place."""
    spark = weights.sparkSession
    label = F.get(F.array(*[F.lit(c) for c in classes]), F.col("class").cast("int"))
    numbers = spark.range(len(classes)).select(F.col("id").cast("int").alias("class"))
    known = names.select(F.col("pos").cast("int").alias("pos"), "feature")
    # A handful of classes: each name once for each.
    grid = known.withColumn("class", F.explode(F.array(*[F.lit(i) for i in range(len(classes))])))
    listed = weights.filter("pos >= 0").select(F.col("pos").cast("int").alias("pos"), F.col("class").cast("int").alias("class"), "weight")
    joined = grid.join(listed, ["pos", "class"], "full").join(numbers, "class", "left_semi")
    unnamed = F.concat(F.lit("feature_"), F.col("pos").cast("string"))
    return joined.select(
        label.alias("class"), F.coalesce("feature", unnamed).alias("feature"), F.coalesce("weight", F.lit(0.0)).alias("coef")
    )


def top_coefficients(rows: DataFrame, k: int = 10, group: str = "class") -> DataFrame:
    """The ``k`` largest and ``k`` smallest coefficients per class, with side and rank."""

    def side(name: str, order: Column) -> DataFrame:
        w = Window.partitionBy(group).orderBy(order, "feature")
        return (
            rows.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .withColumn("side", F.lit(name))
        )

    return side("positive", F.col("coef").desc()).unionByName(side("negative", F.col("coef").asc()))


def best_row(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(1)
