"""Classifiers and regressors on MLlib: estimators, grid search, time folds, multi-model runs.

The loops below run over models, folds and classes; every fit and score is a Spark job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as me
from ..operators import order as od
from ..operators import signal
from ..session import materialise
from . import boosting, forest, linear

SEED = 42


class MacroF1(Evaluator):
    """Unweighted mean of the F1 of the classes seen as label or prediction."""

    def __init__(self, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        cells = (
            dataset.groupBy(
                F.col(self.label).cast("int").alias("y"),
                F.col(self.prediction).cast("int").alias("p"),
            )
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        # One row per cell of the confusion matrix.
        hits = {r["y"]: r["n"] for r in cells if r["y"] == r["p"]}
        seen: dict[int, int] = {}
        for r in cells:
            for c in (r["y"], r["p"]):
                seen[c] = seen.get(c, 0) + r["n"]
        return sum(2 * hits.get(c, 0) / n for c, n in seen.items()) / len(seen) if seen else 0.0

    def isLargerBetter(self) -> bool:
        return True


# --- grids ------------------------------------------------------------------------------------

# The grids searched.
C_GRID = (0.01, 0.1, 1.0, 10.0, 100.0)
PENALTY_GRID = ("l1", "l2")
FOREST_TREES = (100, 200, 300)
FOREST_DEPTHS = (None, 10, 20, 30)
BOOST_RATES, BOOST_DEPTHS, BOOST_TREES = (0.05, 0.1), (3, 6), (100, 300)


def logistic_grid(c=C_GRID, penalties=PENALTY_GRID, **options) -> linear.LinearGrid:
    """Balanced logistic regression, one against the rest."""
    return linear.LinearGrid(tuple(linear.Setting(linear.LOGISTIC, p, x) for x, p in product(c, penalties)), **options)


def svm_grid(c=C_GRID, **options) -> linear.LinearGrid:
    """Balanced linear SVM with squared hinge loss; it has no probabilities."""
    options = {"max_iter": 5000, **options}
    return linear.LinearGrid(tuple(linear.Setting(linear.SQUARED_HINGE, linear.L2, x) for x in c), **options)


def forest_grid(trees=FOREST_TREES, depths=FOREST_DEPTHS, **options) -> forest.ForestGrid:
    """Balanced random forests; the largest is grown once for all settings."""
    return forest.ForestGrid(tuple(trees), tuple(depths), **options)


def boosted_search(
    df: DataFrame,
    classes: int,
    *,
    rates=BOOST_RATES,
    depths=BOOST_DEPTHS,
    trees=BOOST_TREES,
    folds: int = 5,
    fold: str = "fold",
    id_column: str = "doc_id",
    label: str = "label",
    features: str = "features",
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, boosting.Boosted]:
    """(scores by setting, predictions of rows without a fold, everything trained) of softmax boosting.

    ``df`` has a fold number, null for test rows. All settings, folds and the fits on all folds are trained side by
    side; fewer trees are a prefix of more. Predictions, of the best setting: id, label, prediction, proba."""
    pairs = [(r, d) for r in rates for d in depths]
    blocks, held = range(folds), folds
    runs = [
        boosting.Run(tuple(b for b in blocks if b != f), (f,), r, d, tuple(trees)) for r, d in pairs for f in [*blocks, held]
    ]
    rows = df.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(fold), F.lit(held)).alias("block"), F.col(label).alias("y"), features
    ).withColumnRenamed(features, "features")
    objective = boosting.Objective(boosting.SOFTMAX, classes, seed=seed)
    made = boosting.boost(rows, runs, objective)
    called = F.array_position("margins", F.array_max("margins")).cast("int") - 1
    scored = made.predictions.withColumns(
        {"prediction": called, "pair": F.floor(F.col("run") / (folds + 1)).cast("int")}
    )
    cells = scored.filter(F.col("block") < folds).groupBy("pair", "round", "block", F.col("y").cast("int").alias("y"), "prediction").agg(
        F.count(F.lit(1)).alias("n")
    )
    confusions: dict = {}
    for r in cells.collect():  # settings x folds x classes x classes
        confusions.setdefault((r["pair"], r["round"]), {}).setdefault(r["block"], {})[r["y"], r["prediction"]] = r["n"]
    settings = [(p, t) for p in range(len(pairs)) for t in trees]
    scores = [sum(map(linear.macro_f1, confusions.get(s, {}).values())) / folds for s in settings]
    named = [
        ({"rate": str(pairs[p][0]), "depth": str(pairs[p][1]), "trees": str(t)}, float(x), i)
        for i, ((p, t), x) in enumerate(zip(settings, scores))
    ]
    table = df.sparkSession.createDataFrame(named, "params map<string,string>, cv_macro_f1 double, setting int")
    best_pair, best_trees = settings[max(range(len(settings)), key=lambda i: (scores[i], -i))]
    chosen = scored.filter((F.col("block") == held) & (F.col("pair") == best_pair) & (F.col("round") == best_trees))
    exps = F.transform("margins", lambda m: F.exp(m - F.array_max("margins")))
    proba = F.transform("_e", lambda e: e / F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x))
    predictions = chosen.withColumn("_e", exps).select(
        F.col("id").alias(id_column), F.col("y").cast("int").alias(label), "prediction", proba.alias("proba")
    )
    return table, predictions, made


def grid_search(
    df: DataFrame, estimator: Estimator, grid, *, fold: str = "fold", folds: int = 5,
    parallelism: int = 4,
):
    """(best model refitted on all rows, table of mean macro F1 per setting).

    ``df`` carries a fold number (see ``order.stratified_folds``).
    """
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=MacroF1(), numFolds=folds,
        foldCol=fold, parallelism=parallelism,
    ).fit(df)
    rows = [
        ({p.name: str(v) for p, v in setting.items()}, float(score), i)
        for i, (setting, score) in enumerate(zip(grid, fitted.avgMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "params map<string,string>, cv_macro_f1 double, setting int"
    )
    return fitted.bestModel, table


def best_setting(table: DataFrame) -> DataFrame:
    return table.orderBy(F.col("cv_macro_f1").desc(), "setting").limit(1)


# --- returns ----------------------------------------------------------------------------------


def _features(columns: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in columns])


MIN_ROWS = 10
DIRECTION_SCHEMA = "fold int, n_train long, n_test long, accuracy double, f1 double"


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``id``: the place in ``order``. The leading column is the coarse one: a day holds one row per ticker, and
    a ticker one row per day."""
    return od.row_index(rows, list(order), order[0], out="id")


def direction_folds(
    dataset: DataFrame,
    target: str,
    *,
    score: str = "sentiment_score",
    splits: int = 5,
    order: Sequence[str] = ("published_date", "ticker"),
    trees: int = 200,
    depth: int = 4,
    rate: float = 0.05,
    seed: int = SEED,
) -> DataFrame:
    """Accuracy and F1 per expanding time fold of a classifier of the sign of the target.

    No rows below ten rows of input. Features the dataset lacks are left out. The positive class is weighted
    by the ratio in the training part of the fold. The folds are trained side by side.
    """
    predictions, sizes = direction_predictions(
        dataset, target, score=score, splits=splits, order=order, trees=trees, depth=depth, rate=rate, seed=seed
    )
    if predictions is None:
        return dataset.sparkSession.createDataFrame([], DIRECTION_SCHEMA)
    return fold_metrics(predictions, sizes)


def fold_metrics(predictions: DataFrame, sizes: DataFrame) -> DataFrame:
    """(fold, n_train, n_test, accuracy, f1) from (fold, label, prediction) and (fold, n_train)."""
    hit = (F.col("label") == 1) & (F.col("prediction") == 1)
    called = F.count_if(F.col("label") == 1) + F.count_if(F.col("prediction") == 1)
    scores = predictions.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_test"),
        (F.count_if(F.col("label") == F.col("prediction")) / F.count(F.lit(1))).alias("accuracy"),
        F.coalesce(F.try_divide(2 * F.count_if(hit), called), F.lit(0.0)).alias("f1"),
    )
    return sizes.join(scores, "fold", "left").select(
        "fold", "n_train", F.coalesce("n_test", F.lit(0)).cast("long").alias("n_test"), "accuracy", "f1"
    )


def direction_predictions(
    dataset: DataFrame, target: str, *, score: str, splits: int, order: Sequence[str], trees: int, depth: int, rate: float, seed: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """((fold, id, label, prediction, margin), (fold, n_train)); nothing below ten rows.

    Rows keep one place each; a fold is a range of places. The first block is what all folds train on, each
    fold adds one block and is tested on the next."""
    columns = signal.present_columns(dataset, [score, *signal.CLASSIFIER_FEATURES])
    rows = signal.drop_missing(dataset, [target, *columns]).withColumn("y", signal.direction(target))
    placed = materialise(_placed(rows.select(*order, "y", _features(columns).alias("features")), order))
    n = placed.count()
    if n < MIN_ROWS:
        return None, None
    size = n // (splits + 1)
    first = n - splits * size
    block = F.when(F.col("id") < first, 0).otherwise(1 + F.floor((F.col("id") - first) / size)).cast("int")
    runs = [boosting.Run(tuple(range(k + 1)), (k + 1,), rate, depth, (trees,)) for k in range(splits)]
    objective = boosting.Objective(boosting.LOGISTIC, seed=seed, balance=True)
    made = boosting.boost(placed.select("id", block.alias("block"), "y", "features"), runs, objective)
    margin = F.get("margins", F.lit(0))
    predictions = made.predictions.select(
        F.col("run").alias("fold"), "id", F.col("y").cast("int").alias("label"), (margin > 0).cast("int").alias("prediction"), margin.alias("margin")
    )
    spark = dataset.sparkSession
    sizes = spark.createDataFrame([(k, first + k * size) for k in range(splits)], "fold int, n_train long")
    return predictions, sizes


def classification_summary(folds: DataFrame) -> DataFrame:
    """One row with means and per-fold lists."""
    return me.fold_summary(folds, ["accuracy", "f1"])


def return_regression(
    dataset: DataFrame,
    target: str,
    *,
    score: str = "sentiment_score",
    trees: int = 500,
    depth: int = 4,
    rate: float = 0.05,
    row_share: float = 0.9,
    column_share: float = 0.9,
    train_share: float = 0.8,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(one row of metrics, predictions of the test rows) of boosted trees on a time split.

    All twelve features must exist; no complete row is an error.
    """
    metrics, predictions, _ = return_model(
        dataset, target, score=score, trees=trees, depth=depth, rate=rate, row_share=row_share, column_share=column_share,
        train_share=train_share, seed=seed,
    )
    return metrics, predictions


def return_model(
    dataset: DataFrame, target: str, *, score: str, trees: int, depth: int, rate: float, row_share: float, column_share: float,
    train_share: float, seed: int,
) -> tuple[DataFrame, DataFrame, boosting.Boosted]:
    """The regression with its trees."""
    columns = signal.require_columns(dataset, [score, *signal.REGRESSOR_FEATURES])
    rows = signal.drop_missing(dataset, [target, *columns])
    placed = materialise(_placed(rows, ["published_date", "ticker"]))
    n_train = int(placed.count() * train_share)
    if n_train == 0:
        raise ValueError("no complete rows to train on")
    block = F.when(F.col("id") < n_train, 0).otherwise(1)
    objective = boosting.Objective(boosting.SQUARED, row_share=row_share, column_share=column_share, seed=seed)
    made = boosting.boost(
        placed.select("id", block.alias("block"), F.col(target).alias("y"), _features(columns).alias("features")),
        [boosting.Run((0,), (1,), rate, depth, (trees,))], objective,
    )
    found = made.predictions.select("id", F.get("margins", F.lit(0)).alias("predicted_return"))
    predictions = placed.filter(F.col("id") >= n_train).join(found, "id").drop("id")
    metrics = me.regression_metrics(predictions, target, "predicted_return").select(
        F.lit(n_train).cast("long").alias("n_train"), F.col("n").alias("n_test"), "mae", "rmse", "r2"
    )
    return metrics, predictions, made


# --- runs -------------------------------------------------------------------------------------


def run_models(
    train: DataFrame,
    test: DataFrame,
    specs: Mapping[str, linear.LinearGrid | forest.ForestGrid | tuple],
    class_names: Sequence[str],
    *,
    dataset: str,
    folds: int = 5,
    id_column: str = "doc_id",
    parallelism: int = 4,
    results: str | None = None,
) -> tuple[DataFrame, dict]:
    """Search, refit and evaluate each model; (one result document, fitted models by name).

    ``specs`` maps a name to a ``LinearGrid``, a ``ForestGrid`` or an MLlib (estimator, grid). The document holds one entry per model. With
    ``results``, a folder, each model's entry is written there once it is done, and a run that is started again
    reads the entries it finds instead of searching again (their fitted models are then not in the result).
    """
    spark = train.sparkSession
    folded = od.stratified_folds(train, "label", id_column, k=folds).persist()
    entries, fitted = [], {}
    try:
        for place, (name, spec) in enumerate(specs.items()):
            path = f"{results.rstrip('/')}/{dataset}/{name}" if results else None
            entry = _stored(spark, path)
            if entry is None:
                if isinstance(spec, linear.LinearGrid | forest.ForestGrid):
                    own = {"id_column": id_column} if isinstance(spec, forest.ForestGrid) else {}
                    search = spec.search(folded, folds=folds, **own)
                    model, table = search.model, search.table(spark)
                    scored = model.transform(test, id_column=id_column)
                else:
                    model, table = grid_search(folded, *spec, folds=folds, parallelism=parallelism)
                    scored = model.transform(test)
                fitted[name] = model
                proba = "proba" if "proba" in scored.columns else None
                record = me.evaluation_records(scored, class_names, proba=proba)
                best = best_setting(table).first()
                entry = record.select(
                    F.lit(name).alias("name"),
                    F.create_map(*[F.lit(x) for kv in best["params"].items() for x in kv]).alias("best_params"),
                    F.lit(best["cv_macro_f1"]).alias("cv_macro_f1"),
                    "metrics",
                )
                if path:
                    entry.write.mode("overwrite").parquet(path)
                    entry = spark.read.parquet(path)
            entries.append(entry.withColumn("place", F.lit(place)))
    finally:
        folded.unpersist()
    union = entries[0]
    for entry in entries[1:]:
        union = union.unionByName(entry)
    ordered = F.array_sort(
        F.collect_list(
            F.struct("place", F.struct("name", "best_params", "cv_macro_f1", "metrics").alias("e"))
        ),
        lambda a, b: a["place"] - b["place"],
    )
    document = union.agg(ordered.getField("e").alias("models")).select(
        F.lit(dataset).alias("dataset"), "models"
    )
    return document, fitted


def _stored(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The entry that an earlier run finished, if there is one."""
    if path is None:
        return None
    try:
        found = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return None if found.isEmpty() else found
