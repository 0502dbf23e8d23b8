import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sigspark.functions import text as tx
from sigspark.operators import order as od
from sigspark.operators import profile as pf
from sigspark.operators import report as rp
from sigspark.operators import tfidf as ti
from sigspark.plans import embeddings as em
from sigspark.plans import boosting, linear, models, text_study
from sigspark.sources import results as rs


def entry(name, f1, precision=None, auc=None):
    per = {"precision": [0.5, 0.7, 0.9], "recall": [0.2, 0.4, 0.6], "f1": [0.1, 0.2, 0.3]}
    report = {
        "negative": {"precision": 0.5}, "neutral": {"precision": 0.7}, "accuracy": 0.8,
        "macro avg": {"precision": 0.65, "recall": 0.5}, "positive": {"precision": 0.9},
    }
    metrics = {"accuracy": 0.8, "macro_f1": f1, "roc_auc_ovr": auc, "per_class": per,
               "confusion_matrix": [[1, 0], [2, 3]]}
    if precision is not None:
        metrics["precision"] = precision
    if name == "linear_svm":
        metrics["classification_report"] = report
    return {"name": name, "best_params": {"C": 0.1}, "cv_macro_f1": 0.5, "metrics": metrics}


@pytest.fixture()
def documents(spark, tmp_path):
    content = {
        "sentences_75agree": [entry("logistic_regression", 0.9, 0.33, 0.99), entry("linear_svm", 0.9)],
        "sentences_allagree": [entry("logistic_regression", None), entry("linear_svm", 0.125)],
        "extra": [entry("xgboost", 0.4)],
    }
    for subset, entries in content.items():
        (tmp_path / subset).mkdir()
        (tmp_path / subset / "results.json").write_text(json.dumps({"dataset": subset, "models": entries}))
    (tmp_path / "empty").mkdir()
    return rs.read_results(spark, str(tmp_path))


def test_results(documents):
    assert [r[0] for r in rp.ordered_subsets(documents).collect()] == [
        "sentences_allagree", "sentences_75agree", "extra"
    ]
    best = {r["subset"]: r["name"] for r in rp.best_models(documents).collect()}
    # The first of two equal models wins; a model without the metric is skipped.
    assert best == {"sentences_75agree": "logistic_regression", "sentences_allagree": "linear_svm",
                    "extra": "xgboost"}
    assert rp.best_models(documents, restrict_to=["linear_svm"]).count() == 2
    flat = {(r["subset"], r["model"]): r for r in rp.flatten_results(documents, "subset").collect()}
    assert flat["sentences_75agree", "logistic_regression"]["precision"] == 0.33
    assert flat["extra", "xgboost"]["precision"] is None
    models_ = rp.model_rows(documents, "subset").withColumn("p", rp.metric_with_fallback("precision"))
    got = {(r["subset"], r["name"]): round(r["p"], 9) for r in models_.collect()}
    assert got["sentences_75agree", "logistic_regression"] == 0.33
    assert got["sentences_75agree", "linear_svm"] == 0.65
    assert got["extra", "xgboost"] == 0.7
    classes = rp.model_rows(documents).filter("name = 'linear_svm'").select(
        F.array_sort(rp.report_classes(F.col("metrics")["classification_report"]))
    ).first()[0]
    assert classes == ["negative", "neutral", "positive"]


def test_tables(documents):
    rows = rp.model_subset_table(documents, "linear_svm").collect()
    assert [r["subset"] for r in rows][0] == "sentences_allagree"
    assert [tuple(r) for r in rows[:2]] == [
        ("sentences_allagree", "0.12", "", "0.65", "0.50"), ("sentences_75agree", "0.90", "", "0.65", "0.50")
    ]
    assert tuple(rows[3]) == ("sentences_50agree", "", "", "", "")
    best = rp.best_model_table(documents, restrict_to=["linear_svm", "logistic_regression"]).collect()
    assert [r["best_model"] for r in best] == ["linear_svm", "logistic_regression", "", ""]


def test_compare(documents):
    both = documents.withColumn("run", F.lit("a")).unionByName(
        documents.filter("subset = 'extra'").withColumn("run", F.lit("b"))
    )
    rows = rp.comparison_rows(both)
    side = {r["subset"]: r for r in rp.compare_runs(rows, "a", "b").collect()}
    assert side["extra"]["macro_f1_delta"] == 0.0 and side["75agree"]["macro_f1_delta"] is None
    series = rp.metric_series(rows).collect()
    assert [(r["subset"], r["run"]) for r in series][:2] == [("allagree", "a"), ("allagree", "b")]
    assert [r["macro_f1"] for r in series if r["run"] == "b"] == [0.0, 0.0, 0.4]


def test_coefficients(spark):
    names = spark.createDataFrame([(0, "x"), (1, "y")], "pos long, feature string")
    weights = [(0, 0, 3.0), (1, 0, -1.0), (2, 0, 2.0), (-1, 0, 9.0), (0, 1, 0.5)]
    weights = spark.createDataFrame(weights, "pos int, class int, weight double")
    rows = rp.coefficient_rows(weights, names, ["c", "d"])
    top = rp.top_coefficients(rows.filter("class = 'c'"), k=1).collect()
    assert {(r["side"], r["feature"]) for r in top} == {("positive", "x"), ("negative", "y")}
    assert rows.filter("feature = 'feature_2'").count() == 1
    assert rows.filter("class = 'd' AND feature = 'y' AND coef = 0").count() == 1


def test_profile_ties_and_names(spark):
    df = spark.createDataFrame([(0, "b a b"), (0, "a c 5%"), (7, "")], "label int, text string")
    assert [r["token"] for r in pf.top_words(df, 2).orderBy("label", "rank").collect()] == ["a", "b"]
    named = pf.with_label_names(df, ["neg"]).select("label_name").distinct().collect()
    assert {r[0] for r in named} == {"neg", "7"}
    stats = {r["label"]: r for r in pf.length_stats(df).collect()}
    assert stats[0]["median_len"] == 3 and stats[7]["max_len"] == 0
    presence = {r["label"]: r for r in pf.number_presence(df).collect()}
    assert presence[0]["has_percent"] == 1 and presence[7]["number_pct"] == 0.0
    empty = pf.length_profile(df.filter("label = 99")).first()
    assert empty["n"] == 0 and empty["mean_words"] is None and empty["p50_words"] is None


def test_tfidf_forms_agree(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (2, ["b"]), (3, ["c", "b"]), (4, [])], "doc_id int, t array<string>"
    )
    long = {(r["doc_id"], r["term"]): r["tfidf"] for r in ti.tfidf_long(df, "doc_id", "t").collect()}
    model = ti.TfidfVectors("t", "v").fit(df)
    names = [r["term"] for r in model.vocabulary.orderBy("pos").collect()]
    for r in model.transform(df).collect():
        for term, value in zip(names, r["v"].toArray()):
            assert abs(long.get((r["doc_id"], term), 0.0) - value) < 1e-12
    path = str(tmp_path / "vocabulary")
    model.save(path)
    again = ti.TfidfModel.load(spark, path)
    assert {r["doc_id"]: r["v"] for r in again.transform(df).collect()} == {
        r["doc_id"]: r["v"] for r in model.transform(df).collect()
    }
    top = ti.vocabulary(ti.term_frequencies(df, "doc_id", "t"), 2).collect()
    assert {r["term"] for r in top} == {"a", "b"}


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_terms_are_counted_where_their_texts_are(spark):
    """(id, term, tf) rows went through a shuffle of their own before the terms did."""
    df = spark.createDataFrame([(1, "a b a"), (1, "b"), (2, None)], "doc_id int, text string")
    derive = lambda texts: texts.select("doc_id", F.split("text", " ").alias("t"))
    frequencies = ti.term_frequencies(df, "doc_id", "t", derive)
    assert _exchanges(frequencies) == 1 and _exchanges(ti.vocabulary(frequencies)) == 2
    assert sorted(tuple(r) for r in frequencies.collect()) == [(1, "a", 2), (1, "b", 2)]
    assert sorted(tuple(r) for r in ti.vocabulary(frequencies).collect()) == [("a", 1, 2), ("b", 1, 2)]


def test_tfidf_moves_texts_and_distinct_terms_only(spark):
    """Texts are shuffled twice, once together with the answers, a block's distinct terms once; there is no join on every (text, term)."""
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 5))) for i in range(40)] + [(3, "w1 x"), (None, "w1 y")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    derive = lambda texts: texts.select(*[c for c in texts.columns if c != "text"], F.split("text", " ").alias("t"))
    out = ti.tfidf_long(df, "doc_id", "t", derive=derive)
    assert _exchanges(out) == 3 and "Join" not in out._jdf.queryExecution().executedPlan().toString()
    tf = {}
    for i, text in rows:
        for w in text.split(" "):
            tf[i, w] = tf.get((i, w), 0) + 1
    df_ = {w: sum(x == w for _, x in tf) for _, w in tf}
    raw = {(i, w): n * (np.log((1 + len(rows)) / (1 + df_[w])) + 1) for (i, w), n in tf.items()}
    norm = {i: np.sqrt(sum(v * v for (j, _), v in raw.items() if j == i)) for i, _ in tf}
    got = {(r["doc_id"], r["term"]): (r["tf"], r["df"], r["tfidf"]) for r in out.collect()}
    assert got.keys() == tf.keys()
    for (i, w), (n, d, x) in got.items():
        assert (n, d) == (tf[i, w], df_[w]) and abs(x - raw[i, w] / norm[i]) < 1e-12


def test_vectors_look_their_terms_up_once_a_block(spark):
    """Every (text, term) was joined with the vocabulary by term, twice."""
    df = spark.createDataFrame([(i, f"a b{i % 3} c{i}") for i in range(9)], "doc_id int, text string")
    derive = lambda texts: texts.withColumn("t", F.split("text", " ")).drop("text")
    model = ti.TfidfVectors("t", "v", derive=derive).fit(df)
    entries = model.entries(df)
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and plan.count("RepartitionByExpression") == 2
    names = {r["pos"]: r["term"] for r in model.vocabulary.collect()}
    long = {(r["doc_id"], r["term"]): r["tfidf"] for r in ti.tfidf_long(df, "doc_id", "t", derive=derive).collect()}
    got = {(r["doc_id"], names[r["pos"]]): r["value"] for r in entries.collect()}
    assert got.keys() == long.keys() and all(abs(got[k] - long[k]) < 1e-12 for k in long)


def test_embedding_cache_and_alignment(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        inner = em.hashing_encoder(8)()

        def encode(texts, max_length):
            calls.add(len(texts))
            return inner(texts, max_length)

        return encode

    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c"), (4, None)], "doc_id int, text string")
    cache = str(tmp_path / "cache")
    out = em.embed_cached(df, cache, "h8", factory).orderBy("doc_id").collect()
    assert calls.value == 3 and out[0]["embedding"] == out[1]["embedding"]
    more = df.union(spark.createDataFrame([(5, "new")], df.schema))
    assert em.embed_cached(more, cache, "h8", factory).count() == 5
    assert calls.value == 4
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id int, label int")
    with pytest.raises(ValueError, match="doc_id 4"):
        em.join_features(df, labels)
    assert em.join_features(df.filter("doc_id < 4"), labels).count() == 3


def blobs(spark, n=60):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        x = rng.normal(0, 0.3, 3)
        x[i % 3] += 2
        rows.append((i, i % 3, [float(v) for v in x]))
    df = spark.createDataFrame(rows, "doc_id long, label int, x array<double>")
    return df.select("doc_id", "label", array_to_vector("x").alias("features"))


def violation(x, y, weights, setting):
    """Norm of each class's (sub)gradient in the features as given; the intercept is the last column."""
    out = []
    for c, w in weights.items():
        sign = np.where(y == c, 1.0, -1.0)
        weight = np.where(y == c, len(y) / (len(weights) * (y == c).sum()), 1.0) * setting.C
        z = sign * (x @ w)
        slope = -sign * weight / (1 + np.exp(z)) if setting.loss == linear.LOGISTIC else -2 * sign * weight * np.maximum(0, 1 - z)
        g = x.T @ slope
        at_zero = np.sign(g) * np.maximum(np.abs(g) - 1, 0)
        out.append(np.linalg.norm(g + w if setting.penalty == "l2" else np.where(w != 0, g + np.sign(w), at_zero)))
    return out


@pytest.mark.parametrize("loss, penalty, c", [("logistic", "l2", 10.0), ("logistic", "l1", 1.0), ("squared hinge", "l2", 1.0)])
def test_linear_models_minimise_the_stated_objective(spark, loss, penalty, c):
    """Features that occur in one row are merged for the solver; the weights given back solve the problem as stated."""
    rng = np.random.default_rng(1)
    rows, n = [], 40
    for i in range(n):
        places = np.sort(rng.choice(20, 6, replace=False))
        own = [(100 + 3 * i + k, float(rng.random() + 0.1)) for k in range(i % 3)]
        rows.append((i, i % 3, [(int(p), float(v)) for p, v in zip(places, rng.normal(0.5 * (i % 3), 1, 6))] + own))
    df = spark.createDataFrame(rows, "doc_id long, label int, features array<struct<pos:int,value:double>>")
    setting = linear.Setting(loss, penalty, c)
    made = linear.design(df)
    solved = linear.solve(made, made.problems([setting], [-1]))
    assert solved.converged.all()
    weights = {label: np.zeros(301) for label in range(3)}
    for r in linear.weight_table(made, solved, range(3)).collect():
        weights[r["class"]][r["pos"]] = r["weight"]
    x = np.zeros((n, 301))
    for i, _, entries in rows:
        for p, v in entries:
            x[i, p] = v
    x[:, -1] = 1
    assert np.allclose(violation(x, np.arange(n) % 3, weights, setting), solved.gradient, rtol=1e-6, atol=1e-9)
    assert made.width < 21 + 1 + n + 1  # 20 shared features, the intercept and one column a row


def test_a_search_scores_its_folds_and_keeps_a_stored_model(spark, tmp_path):
    df = od.stratified_folds(blobs(spark, 45), "label", "doc_id", k=3)
    grid = models.logistic_grid((0.1, 1.0), ("l2",))
    search = grid.search(df, folds=3)
    rows = {(r["setting"], r["fold"], r["label"]): r for r in search.gradients(spark).collect()}
    assert len(rows) == 2 * 4 * 3 and all(r["gradient"] <= r["allowed"] for r in rows.values())
    single = models.logistic_grid((1.0,), ("l2",)).search(df, folds=3)
    assert abs(single.scores[0] - search.scores[1]) < 1e-9
    search.model.save(str(tmp_path / "m"))
    loaded = linear.LinearModel.load(spark, str(tmp_path / "m"))
    a, b = ({r["doc_id"]: r["proba"] for r in m.transform(df).collect()} for m in (search.model, loaded))
    assert a == b and all(abs(sum(p) - 1) < 1e-9 for p in a.values())
    with pytest.raises(ValueError, match="two classes"):
        grid.fit(df.filter("label = 1"))


def test_small_blocks_give_the_same_models(spark, monkeypatch):
    df = blobs(spark, 30)
    grid = models.svm_grid((0.1, 1.0))
    whole = linear.solve(made := linear.design(df), problems := made.problems(grid.settings, [-1]))
    monkeypatch.setattr(linear, "BLOCK_BYTES", 8 * 3 * made.width)
    parts = linear.solve(made, problems)
    assert parts.converged.all() and np.allclose(whole.w, parts.w, atol=2e-3)


def test_sharing_out_problems_or_rows_gives_the_same_models(spark, monkeypatch):
    df = od.stratified_folds(blobs(spark, 45), "label", "doc_id", k=2)
    grid = models.logistic_grid((0.1, 1.0))
    few = linear.design(df, fold="fold")
    problems = few.problems(grid.settings, [0, 1, -1])
    assert few.held is not None
    shared = linear.solve(few, problems)
    few.free()
    monkeypatch.setattr(linear, "SHARED_ENTRIES", 0)
    monkeypatch.setattr(linear, "TASK_ENTRIES", 30)
    many = linear.design(df, fold="fold")
    assert many.held is None and many.blocks.getNumPartitions() > 1
    dealt = linear.solve(many, problems)
    many.free()
    assert shared.converged.all() and dealt.converged.all()
    # Rows' own columns are numbered by place in both; columns of shared features agree.
    n = few.n_shared + 1
    assert few.n_shared == many.n_shared and np.allclose(shared.w[:n], dealt.w[:n], atol=5e-3)


def test_coefficients_are_dealt_and_stored(spark, monkeypatch):
    """No coefficient passes through the driver: they are in parts and end in a table, whichever part has the frequent features."""
    df = od.stratified_folds(blobs(spark, 60), "label", "doc_id", k=2)
    for name, value in {"SHARED_ENTRIES": 0, "TASK_ENTRIES": 30, "PART_COLUMNS": 2, "HEAD": 1}.items():
        monkeypatch.setattr(linear, name, value, raising=False)
    made = linear.design(df, fold="fold")
    assert made.n_parts > 2 and made.blocks.getNumPartitions() > 1 and len(made.head) == 2
    settings = [linear.Setting()]
    solved = linear.solve(made, made.problems(settings, [0, 1]))
    assert solved.converged.all() and not any(isinstance(x, np.ndarray) and x.ndim > 1 for x in vars(solved).values())
    assert {r["problem"] for r in solved.weights.collect()} == set(range(6))
    assert {k: sum(v.values()) for k, v in solved.cells.items()} == {(0, f): 30 for f in (0, 1)}
    made.free()
    monkeypatch.setattr(linear, "SHARED_ENTRIES", 1 << 20)
    few = linear.design(df, fold="fold")
    shared = linear.solve(few, few.problems(settings, [0, 1]))
    few.free()
    n = few.n_shared + 1
    assert shared.cells == solved.cells and np.allclose(shared.w[:n], solved.w[:n], atol=5e-3)


def test_run_models(spark):
    df = blobs(spark)
    specs = {
        "linear_svm": models.svm_grid(c=(1.0,)),
        "random_forest": models.forest_grid(trees=(5,), depths=(None,)),
    }
    document, fitted = models.run_models(df, df, specs, ["a", "b", "c"], dataset="blobs", folds=2)
    flat = {r["model"]: r for r in rp.flatten_results(document, "dataset").collect()}
    assert set(flat) == set(fitted) == set(specs)
    assert flat["linear_svm"]["roc_auc_ovr"] is None and flat["random_forest"]["roc_auc_ovr"] > 0.9
    assert flat["linear_svm"]["accuracy"] > 0.9


def test_text_study(spark, tmp_path):
    good, bad = "profit rose and sales surged", "loss and sales fell with no gain"
    rows = [(i, good if i % 2 else bad, i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    options = text_study.TextOptions(stop_words=["and"])
    parted = text_study.cached_split(df, str(tmp_path / "split"), "s", options)
    assert text_study.cached_split(df, str(tmp_path / "split"), "s", options).count() == 20
    other = df.withColumn("text", F.upper("text")).filter("doc_id < 10")  # a changed corpus
    assert text_study.cached_split(other, str(tmp_path / "split"), "s", options).count() == 10
    train, test, vectors = text_study.prepare(parted, options)
    model = models.logistic_grid((1.0,), ("l2",)).fit(train, n_features=vectors.size + len(tx.LEXICON_FEATURES))
    out = text_study.score_texts(df, vectors, model, ["down", "up"], options)
    assert out.filter("predicted_label = CASE label WHEN 1 THEN 'up' ELSE 'down' END").count() == 20
    other = ti.TfidfVectors("terms", "tfidf", 2).fit(text_study.with_terms(df, options))
    with pytest.raises(ValueError, match="features"):
        text_study.score_texts(df, other, model, ["down", "up"], options)
    assert len(tx.LEXICON_FEATURES) == 8 and test.count() == 4


def dataset(spark, n):
    from sigspark.operators import signal

    columns = ["sentiment_score", *signal.CLASSIFIER_FEATURES]
    values = [F.sin(F.col("id") * (i + 1)).alias(c) for i, c in enumerate(columns)]
    return spark.range(n).select(
        F.lit("A").alias("ticker"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("published_date"),
        *values, (F.sin("id") / 10).alias("next_day_return"),
    )


def test_return_models(spark):
    df = dataset(spark, 60)
    folds = models.direction_folds(df, "next_day_return", trees=2, splits=2)
    assert folds.count() == 2
    summary = models.classification_summary(folds).first()
    assert abs(summary["mean_accuracy"] - sum(summary["per_fold_accuracy"]) / 2) < 1e-12
    assert models.direction_folds(dataset(spark, 9), "next_day_return").collect() == []
    metrics, predictions = models.return_regression(df, "next_day_return", trees=2)
    assert tuple(metrics.first())[:2] == (48, 12) and predictions.count() == 12
    with pytest.raises(ValueError, match="missing columns"):
        models.return_regression(df.drop("lag_return_1"), "next_day_return")
    with pytest.raises(ValueError):
        models.return_regression(df.filter("sentiment_score > 5"), "next_day_return")


def brute_trees(x, y, rounds, depth, rate, cuts, l2=1.0, least=1.0):
    """Boosting for squared error, one node at a time."""
    margin = np.full(len(y), y.mean())
    first = None
    for _ in range(rounds):
        g, leaf = margin - y, np.zeros(len(y))
        todo = [(np.arange(len(y)), 0)]
        while todo:
            rows, level = todo.pop()
            best = (1e-6, None)
            if level < depth:
                total = g[rows].sum()
                for f in range(x.shape[1]):
                    for cut in cuts[f]:
                        left = x[rows, f] <= cut
                        a, n = g[rows][left].sum(), left.sum()
                        if least <= n <= len(rows) - least:
                            gain = a**2 / (n + l2) + (total - a) ** 2 / (len(rows) - n + l2) - total**2 / (len(rows) + l2)
                            if gain > best[0] + 1e-9:
                                best = gain, (f, cut, left)
            if best[1] is None:
                leaf[rows] = -rate * g[rows].sum() / (len(rows) + l2)
                continue
            first = first or (best[1][0], best[1][1], best[0])
            f, cut, left = best[1]
            todo += [(rows[left], level + 1), (rows[~left], level + 1)]
        margin = margin + leaf
    return margin, first


@pytest.mark.parametrize("cells", [1 << 25, 200])
def test_boosting_is_brute_force_on_any_number_of_tasks(spark, monkeypatch, cells):
    monkeypatch.setattr(boosting, "TASK_CELLS", cells)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (80, 3)).astype(float)
    y = x[:, 0] - 2 * (x[:, 1] > 2) + rng.normal(0, 0.1, 80)
    df = spark.createDataFrame([(i, 0, float(y[i]), x[i].tolist()) for i in range(80)], "id long, block int, y double, features array<double>")
    made = boosting.boost(df, [boosting.Run((0,), (0,), 0.3, 3, (2, 5))], boosting.Objective(boosting.SQUARED))
    cuts = boosting.quantile_cuts(df, "features", 64)
    for rounds in (2, 5):
        want, first = brute_trees(x, y, rounds, 3, 0.3, cuts)
        got = {r["id"]: r["margins"][0] for r in made.predictions.filter(F.col("round") == rounds).collect()}
        assert np.allclose([got[i] for i in range(80)], want, atol=1e-9)
    root = made.trees.filter("round = 0 AND node = 1").first()
    assert (root["feature"], root["cut"]) == first[:2] and abs(root["gain"] - first[2]) < 1e-6
    # Leaves of a tree cover all rows.
    cover = made.trees.filter("feature IS NULL").groupBy("round").agg(F.sum("cover").alias("n")).collect()
    assert all(abs(r["n"] - 80) < 1e-9 for r in cover)


def test_more_models_do_not_deal_the_rows_further(spark, monkeypatch):
    """Rows were dealt by rows x features x models, and the sums of all models met in every task's memory."""
    dealt, train = [], boosting._train
    monkeypatch.setattr(boosting, "TASK_CELLS", 200)
    monkeypatch.setattr(boosting, "CHUNK_CELLS", 30)
    monkeypatch.setattr(boosting, "_train", lambda rows, runs, o, cuts, parts, path: (dealt.append(parts), train(rows, runs, o, cuts, parts, path)))
    x = np.random.default_rng(3).integers(0, 6, (60, 3)).astype(float)
    df = spark.createDataFrame([(i, i % 2, float(x[i, 0]), x[i].tolist()) for i in range(60)], "id long, block int, y double, features array<double>")
    made = boosting.boost(df, [boosting.Run((0, 1), (0, 1), 0.3, 2, (r,)) for r in (1, 2, 3)], boosting.Objective(boosting.SQUARED))
    assert set(dealt) == {1}
    want, _ = brute_trees(x, x[:, 0], 3, 2, 0.3, boosting.quantile_cuts(df, "features", 64))
    got = {r["id"]: r["margins"][0] for r in made.predictions.filter("run = 2").collect()}
    assert np.allclose([got[i] for i in range(60)], want, atol=1e-9)


def test_boosted_search_learns_classes(spark):
    df = od.stratified_folds(blobs(spark, 90), "label", "doc_id", k=3)
    df = df.withColumn("features", vector_to_array("features"))
    df = df.withColumn("fold", F.when(F.col("doc_id") < 75, F.col("fold")))
    table, predictions, made = models.boosted_search(df, 3, rates=(0.3,), depths=(2, 3), trees=(5, 10), folds=3)
    assert table.count() == 4 and table.agg(F.min("cv_macro_f1")).first()[0] > 0.9
    rows = predictions.collect()
    assert len(rows) == 15 and np.mean([r["label"] == r["prediction"] for r in rows]) > 0.9
    assert all(abs(sum(r["proba"]) - 1) < 1e-9 for r in rows)


def test_balanced_classifier_with_one_class(spark):
    rows = [(i, 0, 1.0, [float(i)]) for i in range(12)] + [(20, 1, 0.0, [1.0])]
    df = spark.createDataFrame(rows, "id long, block int, y double, features array<double>")
    made = boosting.boost(df, [boosting.Run((0,), (1,), 0.3, 2, (3,))], boosting.Objective(boosting.LOGISTIC, balance=True))
    assert made.predictions.first()["margins"][0] > 0
    with pytest.raises(ValueError, match="no complete rows"):
        boosting.boost(df.limit(0), [boosting.Run((0,), (1,), 0.3, 2, (3,))], boosting.Objective())


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    df, folder = blobs(spark, 45), str(tmp_path)
    one = {"a": models.svm_grid((0.1,))}
    two = {**one, "b": models.logistic_grid((1.0,), ("l2",))}
    whole, _ = models.run_models(df, df, two, ["x", "y", "z"], dataset="d", folds=2)
    models.run_models(df, df, one, ["x", "y", "z"], dataset="d", folds=2, results=folder)
    resumed, fitted = models.run_models(df, df, two, ["x", "y", "z"], dataset="d", folds=2, results=folder)
    assert set(fitted) == {"b"}
    assert [m["name"] for m in resumed.first()["models"]] == ["a", "b"]
    assert resumed.select(F.to_json("models")).first() == whole.select(F.to_json("models")).first()
