"""Model training and scoring on the driver tables. SQL cannot train; where it can, it checks what follows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import sentiment as se
from ..functions import text as tx
from ..operators import order as od
from ..operators import report as rp
from ..operators.tfidf import TfidfModel, feature_names
from ..operators import signal
from ..session import checkpoint_folder, materialise
from . import embeddings as em
from . import inputs, linear, models, signal_queries, signal_study, text_study  # noqa: F401
from .registry import ORACLES, query, rounded

# The registered runs use the defaults of the functions they call: full grids, rounds and folds, and the
# default stop words. All rows, whole texts and all terms are used.
TEXT = text_study.TextOptions()


def _prepared(spark, folder):
    parted = text_study.split(inputs.labelled(spark, folder), TEXT)
    return text_study.prepare(parted, TEXT)


def _folded(spark, folder):
    train, _, _ = _prepared(spark, folder)
    return od.stratified_folds(train, "label", "doc_id").persist()


def _linear_scores(spark, folder, grid):
    """Cross-validated scores, with how many of the setting's problems ended with a small enough gradient."""
    folded = _folded(spark, folder)
    search = grid.search(folded)
    folded.unpersist()
    ended = search.gradients(spark).groupBy("setting").agg(
        F.count(F.lit(1)).alias("problems"), F.count_if(F.col("gradient") <= F.col("allowed")).alias("converged")
    )
    joined = search.table(spark).join(ended, "setting")
    return joined.select(F.to_json("params").alias("params"), rounded("cv_macro_f1").alias("cv_macro_f1"), "problems", "converged")


@query("lr_grid")
def lr_grid(spark, folder):
    return _linear_scores(spark, folder, models.logistic_grid())


@query("svm_grid")
def svm_grid(spark, folder):
    return _linear_scores(spark, folder, models.svm_grid())


@query("rf_grid")
def rf_grid(spark, folder):
    folded = _folded(spark, folder)
    search = models.forest_grid().search(folded)
    folded.unpersist()
    return search.table(spark).select(F.to_json("params").alias("params"), rounded("cv_macro_f1").alias("cv_macro_f1"))


def _logistic(train, vectors):
    size = vectors.size + len(tx.LEXICON_FEATURES)
    return models.logistic_grid((1.0,), ("l2",)).fit(train, n_features=size)


@query("text_model_run")
def text_model_run(spark, folder):
    """Two models searched, refitted and evaluated on the test part; one flat row each."""
    train, test, _ = _prepared(spark, folder)
    specs = {
        "logistic_regression": models.logistic_grid(),
        "linear_svm": models.svm_grid(),
    }
    document, _ = models.run_models(train, test, specs, lx.LABEL_NAMES, dataset="documents")
    return rp.flatten_results(document, "dataset")


@query("score_text")
def score_text(spark, folder):
    """Train on the labelled texts, then score every document and conversation turn."""
    train, _, vectors = _prepared(spark, folder)
    model = _logistic(train, vectors)
    documents = inputs.documents(spark, folder).select(
        F.concat(F.lit("d"), "doc_id").alias("text_id"), "text"
    )
    turns = inputs.table(spark, folder, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("text_id"), "text"
    )
    scored = text_study.score_texts(
        documents.unionByName(turns), vectors, model, lx.LABEL_NAMES, TEXT, id_column="text_id"
    )
    return se.add_sentiment_score(scored, "proba", lx.LABEL_NAMES).select(
        "text_id", "predicted_label", rounded("sentiment_score").alias("sentiment_score")
    )


@query("saved_model_scores", "SELECT count(*) AS n, count_if(text IS NULL) AS different FROM documents")
def saved_model_scores(spark, folder):
    """Vectors and a model saved, loaded and applied: documents scored, and those scored differently."""
    train, _, vectors = _prepared(spark, folder)
    model = _logistic(train, vectors)
    path = f"{checkpoint_folder(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    vectors.save(f"{path}/vectors")
    model.save(f"{path}/model")
    documents = inputs.documents(spark, folder)
    pairs = (
        (vectors, model),
        (TfidfModel.load(spark, f"{path}/vectors"), linear.LinearModel.load(spark, f"{path}/model")),
    )
    fresh, loaded = (
        text_study.score_texts(documents, v, m, lx.LABEL_NAMES, TEXT).select("doc_id", "predicted_label", "proba")
        for v, m in pairs
    )
    both = fresh.join(loaded.toDF("doc_id", "label2", "proba2"), "doc_id")
    apart = F.exists(F.zip_with("proba", "proba2", lambda a, b: F.abs(a - b) > 1e-9), lambda x: x)
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("predicted_label") != F.col("label2")) | apart).alias("different"),
    )


@query("lr_top_terms")
def lr_top_terms(spark, folder):
    train, _, vectors = _prepared(spark, folder)
    model = _logistic(train, vectors)
    rows = rp.coefficient_rows(model.weights, feature_names(vectors), lx.LABEL_NAMES)
    return rp.top_coefficients(rows)


@query("embed_cache")
def embed_cache(spark, folder):
    """Encode the documents twice through one cache; the second run finds all texts."""
    cache = f"{checkpoint_folder(spark).rstrip('/')}/embeddings-{uuid.uuid4().hex}"
    documents = inputs.documents(spark, folder)
    factory = em.hashing_encoder(32)
    em.embed_cached(documents, cache, "hash32", factory)
    out = em.embed_cached(documents, cache, "hash32", factory)
    norm = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    return out.select("doc_id", F.size("embedding").alias("width"), rounded(norm, 4).alias("norm"))


def _boosted(spark, folder):
    rows = inputs.vectors(spark, folder).select("vec_id", "label", "embedding")
    parted = od.stratified_split(rows, "label", "vec_id")
    train = od.stratified_folds(parted.filter(F.col("part") == "train"), "label", "vec_id")
    test = parted.filter(F.col("part") == "test").withColumn("fold", F.lit(None).cast("int"))
    columns = ("vec_id", "label", "fold", "embedding")
    both = train.select(*columns).unionByName(test.select(*columns))
    classes = (rows.agg(F.max("label")).first()[0] or 0) + 1
    return models.boosted_search(both, classes, id_column="vec_id", features="embedding")


@query("boosted_vectors")
def boosted_vectors(spark, folder):
    """Boosted trees on the embedding table, the best of the grid; a stratified test part."""
    _, predictions, _ = _boosted(spark, folder)
    return predictions.select("vec_id", "label", "prediction", rounded(F.array_max("proba")).alias("confidence"))


def _dataset(spark, folder):
    return signal_study.daily_dataset(
        inputs.articles(spark, folder), inputs.prices(spark, folder),
        inputs.benchmark(spark, folder),
    )


@query("gbt_direction")
def gbt_direction(spark, folder):
    return models.direction_folds(_dataset(spark, folder), "excess_return")


@query("gbt_return")
def gbt_return(spark, folder):
    metrics, _ = models.return_regression(_dataset(spark, folder), "excess_return")
    return metrics


# A day in the dataset has articles, so its count and its weekday are never null.
_COMPLETE = " AND ".join(
    f"{c} IS NOT NULL"
    for c in ("excess_return", "sentiment_score", *signal.REGRESSOR_FEATURES)
    if c not in ("article_count", "day_of_week")
)
# The counts come from the tables; SQL cannot train, so it can only ask that nothing differs.
RECOMPUTED = (
    f"SELECT n * 4 // 5 AS n_train, n - n * 4 // 5 AS n_test, 0 AS different, 0 AS splits_different FROM "
    f"(SELECT count(*) AS n FROM ({ORACLES['daily_dataset']}) WHERE {_COMPLETE})"
)


@query("gbt_return_recomputed", RECOMPUTED)
def gbt_return_recomputed(spark, folder):
    """The regression's metrics by plain sums over its written predictions, and the first tree's root split by plain
    sums over the training rows: how many of them differ from what the model says."""
    columns = ["sentiment_score", *signal.REGRESSOR_FEATURES]
    dataset = materialise(signal.drop_missing(_dataset(spark, folder), ["excess_return", *columns]))
    metrics, predictions, made = models.return_model(
        dataset, "excess_return", score="sentiment_score", trees=20, depth=4, rate=0.05, row_share=1.0, column_share=1.0,
        train_share=0.8, seed=models.SEED,
    )
    error = F.col("excess_return") - F.col("predicted_return")
    sums = predictions.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(error)).alias("a"), F.avg(error * error).alias("s"),
        F.var_pop("excess_return").alias("v"),
    )
    plain = F.col("plain")
    apart = [
        (F.col("mae"), plain["a"]), (F.col("rmse"), F.sqrt(plain["s"])), (F.col("r2"), 1 - plain["s"] / plain["v"]),
        (F.col("n_test").cast("double"), plain["n"].cast("double")),
    ]
    different = sum((F.abs(x - y) > 1e-9 * (1 + F.abs(y))).cast("int") for x, y in apart)
    found = metrics.withColumn("plain", sums.select(F.struct("*")).scalar()).select(
        "n_train", "n_test", different.alias("different")
    )

    root = made.trees.filter("round = 0 AND node = 1").first()
    last = predictions.select("ticker", "published_date")
    train = dataset.join(last, ["ticker", "published_date"], "left_anti").select(
        F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), F.col("excess_return").alias("y")
    )
    train = train.withColumn("m", train.agg(F.avg("y")).scalar())
    left = F.get("x", F.lit(root["feature"])) <= F.lit(root["cut"])
    halves = train.agg(
        F.sum(F.when(left, F.col("m") - F.col("y"))).alias("gl"), F.count_if(left).alias("nl"),
        F.sum(F.when(~left, F.col("m") - F.col("y"))).alias("gr"), F.count_if(~left).alias("nr"),
        F.sum(F.col("m") - F.col("y")).alias("g"), F.count(F.lit(1)).alias("n"),
    )
    gain = F.col("gl") ** 2 / (F.col("nl") + 1) + F.col("gr") ** 2 / (F.col("nr") + 1) - F.col("g") ** 2 / (F.col("n") + 1)
    wrong = (F.abs(gain - F.lit(root["gain"])) > F.lit(1e-6 * (1 + abs(root["gain"])))).cast("int")
    return found.withColumn("splits_different", halves.select(wrong).scalar())
