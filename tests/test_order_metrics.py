import math
import random

import pytest
from pyspark.sql import functions as F

from sigspark.operators import metrics as me
from sigspark.operators import order as od


def ranks(values):
    ordered = sorted(values)
    return {
        v: sum(i + 1 for i, x in enumerate(ordered) if x == v) / ordered.count(v) for v in set(values)
    }


def test_average_ranks(spark):
    rng = random.Random(3)
    # One value holds a third of all rows.
    values = [rng.choice([0.0, 0.0, float(rng.randrange(30))]) for _ in range(300)]
    df = spark.createDataFrame([(v, "gh"[i % 2]) for i, v in enumerate(values)] + [(None, "g")],
                               "v double, g string")
    got = {r["v"]: r["avg_rank"] for r in od.average_ranks(df, "v", buckets=5).collect()}
    assert got == ranks(values)
    per = od.average_ranks(df, "v", ["g"], buckets=5).collect()
    for g in "gh":
        mine = [v for i, v in enumerate(values) if "gh"[i % 2] == g]
        assert {r["v"]: r["avg_rank"] for r in per if r["g"] == g} == ranks(mine)


def test_group_quantiles(spark):
    rows = [("a", float(i)) for i in range(10)] + [("b", 5.0)] * 3 + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = od.group_quantiles(df, ["g"], "v", {"p50": 0.5, "p90": 0.9}, 3)
    got = {r["g"]: (r["p50"], round(r["p90"], 9)) for r in out.collect()}
    assert got == {"a": (4.5, 8.1), "b": (5.0, 5.0)}


def test_row_index(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(6)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, day int")
    got = {r["id"]: r["row_index"] for r in od.row_index(df, ["day", "id"], "day").collect()}
    want = {id_: n for n, (_, id_) in enumerate(sorted((d, i) for i, d in rows))}
    assert got == want


def test_splits(spark):
    rows = [(i, 0 if i % 10 else 1) for i in range(103)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    parts = od.stratified_split(df, "label", "doc_id", seed=1).collect()
    test = [r for r in parts if r["part"] == "test"]
    assert len(parts) == 103 and len(test) == 21
    assert sum(r["label"] for r in test) == 2
    again = od.stratified_split(df.repartition(5), "label", "doc_id", seed=1).collect()
    assert {(r["doc_id"], r["part"]) for r in parts} == {(r["doc_id"], r["part"]) for r in again}
    other = od.stratified_split(df, "label", "doc_id", seed=2).collect()
    assert {(r["doc_id"], r["part"]) for r in parts} != {(r["doc_id"], r["part"]) for r in other}
    folds = od.stratified_folds(df, "label", "doc_id", k=5).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    with pytest.raises(ValueError):
        od.stratified_folds(df, "label", "doc_id", k=1)


def test_time_folds(spark):
    df = spark.createDataFrame([(i,) for i in range(20)], "d int")
    rows = od.time_folds(df, ["d"], "d", splits=5).collect()
    for fold in range(5):
        train = sorted(r["d"] for r in rows if r["fold"] == fold and r["part"] == "train")
        test = sorted(r["d"] for r in rows if r["fold"] == fold and r["part"] == "test")
        start = 20 - (5 - fold) * 3
        assert train == list(range(start)) and test == list(range(start, start + 3))
    parts = od.time_split(df, ["d"], "d").collect()
    assert sorted(r["d"] for r in parts if r["part"] == "train") == list(range(16))


def test_signal_eval(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 1.0), (-1.0, -3.0), (0.0, 0.0), (0.0, 1.0), (None, 1.0)], "s double, t double"
    )
    for buckets in (None, 3):
        r = me.signal_eval(df, "s", "t", buckets).first()
        assert r["n"] == 5 and r["directional_accuracy"] == 0.8 and r["mae"] == 1.0
        # Ranks 4, 5, 1, 2.5, 2.5 and 5, 3.5, 1, 2, 3.5.
        a, b = [4, 5, 1, 2.5, 2.5], [5, 3.5, 1, 2, 3.5]
        xy = sum((x - 3) * (y - 3) for x, y in zip(a, b))
        want = xy / math.sqrt(sum((x - 3) ** 2 for x in a) * sum((y - 3) ** 2 for y in b))
        assert math.isclose(r["spearman_corr"], want)
    empty = me.signal_eval(df.filter("s > 100"), "s", "t").first()
    assert tuple(empty) == (0, None, None, None, None)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "y double, p double")
    r = me.regression_metrics(df, "y", "p").first()
    assert (r["n"], r["mae"], r["r2"]) == (2, 0.5, 0.5) and math.isclose(r["rmse"], math.sqrt(0.5))
    assert me.regression_metrics(df.filter("y = 1"), "y", "p").first()["r2"] is None


# A published run: rows are actual classes. Its printed scores must follow from its matrix.
MATRIX = [[79, 3, 2], [2, 420, 7], [3, 8, 167]]


def published(spark):
    rows = [(i, j, n) for i, r in enumerate(MATRIX) for j, n in enumerate(r)]
    cells = spark.createDataFrame(rows, "label int, prediction int, n int")
    return cells.withColumn("x", F.explode(F.expr("sequence(1, n)"))).drop("x", "n")


def test_class_report_arithmetic(spark):
    df = published(spark)
    counts = me.confusion(df)
    assert sorted((r["label"], r["prediction"], r["n"]) for r in counts.collect()) == [
        (i, j, MATRIX[i][j]) for i in range(3) for j in range(3)
    ]
    report = {r["entry"]: r for r in me.class_report(me.class_scores(counts)).collect()}
    assert math.isclose(report["accuracy"]["f1_score"], 0.9638205499276411)
    assert math.isclose(report["0"]["precision"], 0.9404761904761905)
    assert math.isclose(report["1"]["f1_score"], 0.9767441860465116)
    assert math.isclose(report["macro avg"]["precision"], 0.9546059283588285)
    assert math.isclose(report["weighted avg"]["f1_score"], 0.963772443760944)
    record = me.evaluation_records(df, ["negative", "neutral", "positive"]).first()["metrics"]
    assert record["confusion_matrix"] == MATRIX
    assert math.isclose(record["macro_f1"], 0.9535744004604864)
    assert math.isclose(record["accuracy"], 0.9638205499276411)
    assert set(record["classification_report"]) == {
        "negative", "neutral", "positive", "accuracy", "macro avg", "weighted avg"
    }


def test_empty_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "label int, prediction int")
    counts = me.confusion(df, classes=[0, 1, 2])
    assert counts.count() == 9
    fractions = {(r["label"], r["prediction"]): r["fraction"] for r in me.confusion_normalised(counts).collect()}
    assert fractions[0, 1] == 0.5 and fractions[2, 2] == 0.0
    scores = {r["label"]: r for r in me.class_scores(counts).collect()}
    assert scores[2]["precision"] == scores[2]["recall"] == scores[2]["f1"] == 0.0
    assert scores[1]["precision"] == 0.0


def test_auc(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(120):
        y = rng.randrange(3)
        p = [rng.randrange(1, 6) + (3 if i == y else 0) for i in range(3)]
        rows.append((y, [x / sum(p) for x in p]))
    df = spark.createDataFrame(rows, "label int, proba array<double>")
    got = {r["class"]: r["auc"] for r in me.roc_auc_ovr(df, "label", "proba", 3, (), 4).collect()}
    for c in range(3):
        pos = [p[c] for y, p in rows if y == c]
        neg = [p[c] for y, p in rows if y != c]
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert math.isclose(got[c], wins / (len(pos) * len(neg)))
    one_class = df.filter("label = 0")
    assert me.macro_auc(me.roc_auc_ovr(one_class, "label", "proba", 3)).first()[0] is None


def test_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    got = {r["label"]: r["weight"] for r in me.class_weights(df).collect()}
    assert got == {0: 4 / 6, 1: 2.0}
    assert me.positive_weight(df).first()["positive_weight"] == 3.0
    assert me.positive_weight(df.filter("label = 0")).first()["positive_weight"] == 1.0


def test_infinite_values_keep_their_rank(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf] * 5 + [1.0, 2.0, inf, inf]], "v double")
    got = {r["v"]: r["avg_rank"] for r in od.average_ranks(df, "v", buckets=4).collect()}
    assert got == {-inf: 3.0, 1.0: 6.0, 2.0: 7.0, inf: 8.5}


def test_spearman_drops_incomplete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0), (None, 9.0), (0.5, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert abs(me.spearman(df, "a", "b").first()[0] - 0.6) < 1e-12


def test_wrong_classes_and_lengths_are_errors(spark):
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([(0, 1, [0.5, 0.5]), (1, 3, [0.2, 0.8])], "label int, prediction int, proba array<double>")
    with pytest.raises(PySparkException, match="outside the classes"):
        me.confusion(df, classes=[0, 1]).collect()
    with pytest.raises(PySparkException, match="outside the classes"):
        me.evaluation_records(df, ["a", "b"]).collect()
    with pytest.raises(PySparkException, match="expected 3 probabilities"):
        me.roc_auc_ovr(df, "label", "proba", 3).collect()
