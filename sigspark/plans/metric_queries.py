"""Regression and classification metrics, ranks, positions and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as me
from ..operators import order as od
from ..operators import signal
from . import inputs
from .registry import day_text, query, rounded

CLASSES = (0, 1, 2)

GRID = (
    "grid AS (SELECT a.label, b.prediction FROM (VALUES (0), (1), (2)) a(label), "
    "(VALUES (0), (1), (2)) b(prediction)), "
    "conf AS (SELECT g.label, g.prediction, count(p.doc_id) AS n FROM grid g LEFT JOIN preds p "
    "ON p.label = g.label AND p.prediction = g.prediction GROUP BY 1, 2)"
)
SCORES = (
    f"{GRID}, sup AS (SELECT label, sum(n) AS support, sum(CASE WHEN label = prediction THEN n END) AS hits "
    "FROM conf GROUP BY 1), cal AS (SELECT prediction AS label, sum(n) AS called FROM conf GROUP BY 1), "
    "sc AS (SELECT label, CAST(support AS BIGINT) AS support, hits, "
    "coalesce(hits / nullif(called::DOUBLE, 0), 0) AS precision, "
    "coalesce(hits / nullif(support::DOUBLE, 0), 0) AS recall, "
    "coalesce(2 * hits / nullif((called + support)::DOUBLE, 0), 0) AS f1 FROM sup JOIN cal USING (label))"
)


def _predictions(spark, folder):
    return inputs.predictions(spark, folder)


@query(
    "regression_metrics",
    "SELECT ticker, count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, "
    "round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 6) AS r2 FROM "
    "(SELECT ticker, excess_return AS y, sentiment_score * 0.01 AS p FROM excess WHERE excess_return IS NOT NULL) "
    "GROUP BY ticker",
    needs="excess",
)
def regression_metrics(spark, folder):
    daily = signal.daily_aggregate(inputs.articles(spark, folder))
    rows = signal.attach_forward_returns(
        daily, inputs.prices(spark, folder), inputs.benchmark(spark, folder)
    ).filter(F.col("excess_return").isNotNull())
    out = me.regression_metrics(
        rows.withColumn("predicted", F.col("sentiment_score") * 0.01),
        "excess_return", "predicted", ["ticker"],
    )
    return out.select("ticker", "n", *[rounded(c).alias(c) for c in ("mae", "rmse", "r2")])


@query("confusion_matrix", f"WITH {GRID} SELECT label, prediction, n FROM conf", needs="preds")
def confusion_matrix(spark, folder):
    return me.confusion(_predictions(spark, folder), classes=CLASSES)


@query(
    "confusion_by_source",
    "SELECT source, l.c AS label, r.c AS prediction, count(p.doc_id) AS n FROM "
    "(SELECT DISTINCT source FROM documents JOIN preds USING (doc_id)) s, (VALUES (0), (1), (2)) l(c), "
    "(VALUES (0), (1), (2)) r(c) LEFT JOIN (SELECT preds.*, source AS src FROM preds JOIN documents USING (doc_id)) p "
    "ON p.src = s.source AND p.label = l.c AND p.prediction = r.c GROUP BY 1, 2, 3",
    needs="preds",
)
def confusion_by_source(spark, folder):
    sources = inputs.table(spark, folder, "documents").select("doc_id", "source")
    joined = _predictions(spark, folder).join(sources, "doc_id")
    return me.confusion(joined, classes=CLASSES, groups=["source"])


@query(
    "confusion_wide",
    f'WITH {GRID} SELECT label, max(CASE WHEN prediction = 0 THEN n END) AS "0", '
    'max(CASE WHEN prediction = 1 THEN n END) AS "1", max(CASE WHEN prediction = 2 THEN n END) AS "2" '
    "FROM conf GROUP BY label",
    needs="preds",
)
def confusion_wide(spark, folder):
    return me.confusion_wide(me.confusion(_predictions(spark, folder), classes=CLASSES), CLASSES)


@query(
    "confusion_normalised",
    f"WITH {GRID} SELECT label, prediction, n, round(coalesce(n / nullif((sum(n) OVER (PARTITION BY label))::DOUBLE, 0), 0), 6) "
    "AS fraction FROM conf",
    needs="preds",
)
def confusion_normalised(spark, folder):
    counts = me.confusion(_predictions(spark, folder), classes=CLASSES)
    return me.confusion_normalised(counts).withColumn("fraction", rounded("fraction"))


@query(
    "class_report",
    f"WITH {SCORES} SELECT label::VARCHAR AS entry, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1_score, support FROM sc UNION ALL SELECT 'accuracy', NULL, NULL, "
    "round(sum(hits) / sum(support)::DOUBLE, 6), CAST(sum(support) AS BIGINT) FROM sc UNION ALL SELECT 'macro avg', "
    "round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM sc UNION ALL "
    "SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), "
    "round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), "
    "CAST(sum(support) AS BIGINT) FROM sc",
    needs="preds",
)
def class_report(spark, folder):
    counts = me.confusion(_predictions(spark, folder), classes=CLASSES)
    out = me.class_report(me.class_scores(counts))
    return out.select(
        "entry", *[rounded(c).alias(c) for c in ("precision", "recall", "f1_score")], "support"
    )


AUC = (
    "each AS (SELECT label, c.c AS class, CASE c.c WHEN 0 THEN r0 WHEN 1 THEN r1 ELSE r2 END / (r0 + r1 + r2) AS s "
    "FROM preds, (VALUES (0), (1), (2)) c(c)), "
    "ranked AS (SELECT *, rank() OVER (PARTITION BY class ORDER BY s) + (count(*) OVER (PARTITION BY class, s) - 1) / 2.0 AS r FROM each), "
    "auc AS (SELECT class, (sum(CASE WHEN label = class THEN r END) - p * (p + 1) / 2) / (p * (n - p)) AS auc FROM "
    "(SELECT *, (count(*) FILTER (label = class) OVER (PARTITION BY class))::DOUBLE AS p, "
    "(count(*) OVER (PARTITION BY class))::DOUBLE AS n FROM ranked) GROUP BY class, p, n)"
)


@query(
    "roc_auc_ovr",
    f"WITH {AUC} SELECT class, round(auc, 6) AS auc FROM auc",
    needs="preds",
)
def roc_auc_ovr(spark, folder):
    out = me.roc_auc_ovr(_predictions(spark, folder), "label", "proba", 3)
    return out.withColumn("auc", rounded("auc"))


@query(
    "macro_auc",
    f"WITH {AUC} SELECT round(avg(auc), 6) AS roc_auc_ovr FROM auc",
    needs="preds",
)
def macro_auc(spark, folder):
    out = me.macro_auc(me.roc_auc_ovr(_predictions(spark, folder), "label", "proba", 3))
    return out.select(rounded("roc_auc_ovr").alias("roc_auc_ovr"))


@query(
    "fold_summary",
    "SELECT round(avg(a), 6) AS mean_accuracy, "
    + ", ".join(f"round(max(CASE WHEN fold = {i} THEN a END), 6) AS fold_{i}" for i in range(5))
    + " FROM (SELECT doc_id % 5 AS fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS a FROM preds GROUP BY 1)",
    needs="preds",
)
def fold_summary(spark, folder):
    folds = (
        _predictions(spark, folder)
        .groupBy(F.pmod("doc_id", F.lit(5)).alias("fold"))
        .agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))
    )
    out = me.fold_summary(folds, ["accuracy"])
    return out.select(
        rounded("mean_accuracy").alias("mean_accuracy"),
        *[rounded(F.get("per_fold_accuracy", F.lit(i))).alias(f"fold_{i}") for i in range(5)],
    )


@query(
    "class_weights",
    "SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight "
    "FROM labs GROUP BY label",
    needs="labs",
)
def class_weights(spark, folder):
    return me.class_weights(inputs.labels(spark, folder)).withColumn("weight", rounded("weight"))


@query(
    "positive_weight",
    "SELECT count(*) FILTER (quality = 0) AS n_neg, count(*) FILTER (quality = 1) AS n_pos, "
    "round(count(*) FILTER (quality = 0) / (count(*) FILTER (quality = 1))::DOUBLE, 6) AS positive_weight FROM labels",
)
def positive_weight(spark, folder):
    out = me.positive_weight(inputs.table(spark, folder, "labels"), "quality")
    return out.withColumn("positive_weight", rounded("positive_weight"))


# --- order ------------------------------------------------------------------------------------


@query(
    "avg_rank",
    "SELECT l_extendedprice AS value, count(*) AS n, "
    "min(r) + (count(*) - 1) / 2.0::DOUBLE AS avg_rank FROM (SELECT l_extendedprice, "
    "rank() OVER (ORDER BY l_extendedprice) AS r FROM lineitem) GROUP BY 1",
)
def avg_rank(spark, folder):
    ranks = od.average_ranks(inputs.table(spark, folder, "lineitem"), "l_extendedprice")
    return ranks.withColumnRenamed("l_extendedprice", "value")


@query(
    "avg_rank_per_group",
    "SELECT event_type, value, count(*) AS n, min(r) + (count(*) - 1) / 2.0::DOUBLE AS avg_rank FROM "
    "(SELECT event_type, value, rank() OVER (PARTITION BY event_type ORDER BY value) AS r FROM events "
    "WHERE value IS NOT NULL) GROUP BY 1, 2",
)
def avg_rank_per_group(spark, folder):
    return od.average_ranks(inputs.table(spark, folder, "events"), "value", ["event_type"])


@query(
    "spearman",
    "SELECT round(corr(ra, rb), 6) AS spearman_corr FROM (SELECT "
    "rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra, "
    "rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb "
    "FROM lineitem)",
)
def spearman(spark, folder):
    out = me.spearman(inputs.table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(rounded("spearman_corr").alias("spearman_corr"))


@query(
    "row_index",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events",
)
def row_index(spark, folder):
    events = inputs.table(spark, folder, "events").select("event_id", "ts")
    return od.row_index(events, ["ts", "event_id"], F.date_trunc("hour", "ts")).select(
        "event_id", "row_index"
    )


@query(
    "row_index_per_group",
    "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_index "
    "FROM events",
)
def row_index_per_group(spark, folder):
    events = inputs.table(spark, folder, "events").select("event_id", "event_type", "ts")
    indexed = od.row_index(
        events, ["ts", "event_id"], F.date_trunc("hour", "ts"), groups=["event_type"]
    )
    return indexed.select("event_id", "event_type", "row_index")


def _daily(spark, folder):
    return signal.daily_aggregate(inputs.articles(spark, folder)).select(
        "ticker", "published_date"
    )


@query(
    "time_prefix_split",
    "SELECT ticker, strftime(published_date, '%Y-%m-%d') AS published_date, "
    "CASE WHEN row_number() OVER (ORDER BY published_date, ticker) <= floor(count(*) OVER () * 0.8) "
    "THEN 'train' ELSE 'test' END AS part FROM daily",
    needs="daily",
)
def time_prefix_split(spark, folder):
    out = od.time_split(_daily(spark, folder), ["published_date", "ticker"], "published_date")
    return out.select("ticker", day_text("published_date").alias("published_date"), "part")


@query(
    "time_folds",
    "WITH p AS (SELECT ticker, published_date, row_number() OVER (ORDER BY published_date, ticker) - 1 AS i, "
    "count(*) OVER () AS n, count(*) OVER () // 6 AS b FROM daily) "
    "SELECT ticker, strftime(published_date, '%Y-%m-%d') AS published_date, f.f AS fold, "
    "CASE WHEN i < n - (5 - f.f) * b THEN 'train' ELSE 'test' END AS part FROM p, "
    "(VALUES (0), (1), (2), (3), (4)) f(f) WHERE i < n - (5 - f.f) * b + b",
    needs="daily",
)
def time_folds(spark, folder):
    out = od.time_folds(_daily(spark, folder), ["published_date", "ticker"], "published_date")
    return out.select(
        "ticker", day_text("published_date").alias("published_date"), "fold", "part"
    )


KEYED = (
    "keyed AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY "
    "('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT, doc_id) - 1 AS place FROM labs)"
)


@query(
    "stratified_split",
    f"WITH {KEYED}, c AS (SELECT label, count(*) AS n FROM labs GROUP BY 1), "
    "t AS (SELECT sum(n) AS total, ceil(round(sum(n) * 0.2, 9)) AS want FROM c), "
    "s AS (SELECT label, want, want * n / total::DOUBLE AS share FROM c, t), "
    "q AS (SELECT label, floor(round(share, 9)) + CASE WHEN row_number() OVER (ORDER BY "
    "round(share - floor(round(share, 9)), 9) DESC, label) <= want - sum(floor(round(share, 9))) OVER () "
    "THEN 1 ELSE 0 END AS quota FROM s) "
    "SELECT doc_id, label, CASE WHEN place < quota THEN 'test' ELSE 'train' END AS part FROM keyed JOIN q USING (label)",
    needs="labs",
)
def stratified_split(spark, folder):
    return od.stratified_split(inputs.labels(spark, folder), "label", "doc_id").select(
        "doc_id", "label", "part"
    )


@query(
    "stratified_folds",
    f"WITH {KEYED} SELECT doc_id, label, CAST(place % 5 AS INTEGER) AS fold FROM keyed",
    needs="labs",
)
def stratified_folds(spark, folder):
    return od.stratified_folds(inputs.labels(spark, folder), "label", "doc_id").select(
        "doc_id", "label", "fold"
    )


