"""Result documents computed from predictions, and the tables made from them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..operators import metrics as me
from ..operators import report as rp
from ..session import checkpoint_folder
from ..sources.results import read_written_results, write_results
from . import inputs
from .registry import CTES, query, rounded, sql_list

NAMES = ("logistic_regression", "linear_svm", "boosted_trees")

CTES["mp"] = (
    "labs",
    "SELECT *, CASE WHEN (doc_id * (model_no * 2 + 3) + run_no) % 20 < 7 - 4 * run_no - model_no % 2 "
    "THEN (label + 1 + doc_id % 2) % 3 ELSE label END AS prediction FROM "
    f"(SELECT doc_id, label, ({sql_list(lx.SUBSETS)})[list_position({sql_list(inputs.LANG_SUBSET)}, lang)] AS subset "
    "FROM labs JOIN documents USING (doc_id)), (VALUES ('tfidf', 0), ('encoder', 1)) r(run, run_no), "
    "(VALUES ('logistic_regression', 0), ('linear_svm', 1), ('boosted_trees', 2)) m(model, model_no) "
    "WHERE NOT (run = 'encoder' AND subset = 'sentences_50agree')",
)
CTES["mclass"] = (
    "mp",
    "SELECT run, subset, model, model_no, c.c AS label, count(*) FILTER (label = c.c) AS support, "
    "count(*) FILTER (prediction = c.c) AS called, count(*) FILTER (label = c.c AND prediction = c.c) AS hits, "
    "coalesce(count(*) FILTER (label = c.c AND prediction = c.c) / nullif(count(*) FILTER (prediction = c.c), 0)::DOUBLE, 0) AS p, "
    "coalesce(count(*) FILTER (label = c.c AND prediction = c.c) / nullif(count(*) FILTER (label = c.c), 0)::DOUBLE, 0) AS r, "
    "coalesce(2 * count(*) FILTER (label = c.c AND prediction = c.c) / nullif(count(*) FILTER (prediction = c.c) "
    "+ count(*) FILTER (label = c.c), 0)::DOUBLE, 0) AS f FROM mp, (VALUES (0), (1), (2)) c(c) GROUP BY 1, 2, 3, 4, 5",
)
CTES["mauc1"] = (
    "mp",
    "SELECT run, subset, model, label, c.c AS class, CASE c.c WHEN 0 THEN a WHEN 1 THEN b ELSE d END / (a + b + d) AS s "
    "FROM (SELECT *, (1 + (doc_id * 3) % 16 + CASE WHEN prediction = 0 THEN 8 ELSE 0 END)::DOUBLE AS a, "
    "(1 + (doc_id * 5) % 16 + CASE WHEN prediction = 1 THEN 8 ELSE 0 END)::DOUBLE AS b, "
    "(1 + (doc_id * 7) % 16 + CASE WHEN prediction = 2 THEN 8 ELSE 0 END)::DOUBLE AS d FROM mp WHERE model <> 'linear_svm'), "
    "(VALUES (0), (1), (2)) c(c)",
)
CTES["mauc2"] = (
    "mauc1",
    "SELECT *, rank() OVER (PARTITION BY run, subset, model, class ORDER BY s) + "
    "(count(*) OVER (PARTITION BY run, subset, model, class, s) - 1) / 2.0 AS rk FROM mauc1",
)
CTES["mauc"] = (
    "mauc2",
    "SELECT run, subset, model, CASE WHEN count(auc) = 3 THEN avg(auc) END AS roc_auc_ovr FROM "
    "(SELECT run, subset, model, class, (sum(rk) FILTER (label = class) - pos * (pos + 1) / 2) / "
    "nullif(pos * (n - pos), 0) AS auc FROM (SELECT *, (count(*) FILTER (label = class) OVER g)::DOUBLE AS pos, "
    "(count(*) OVER g)::DOUBLE AS n FROM mauc2 WINDOW g AS (PARTITION BY run, subset, model, class)) "
    "GROUP BY run, subset, model, class, pos, n) GROUP BY 1, 2, 3",
)
CTES["msum"] = (
    "mclass mauc",
    "SELECT m.*, roc_auc_ovr FROM (SELECT run, subset, model, model_no, sum(hits) / sum(support)::DOUBLE AS accuracy, "
    "avg(p) AS precision, avg(r) AS recall, avg(f) AS macro_f1, "
    "max(f) FILTER (label = 0) AS f1_negative, max(f) FILTER (label = 1) AS f1_neutral, "
    "max(f) FILTER (label = 2) AS f1_positive FROM mclass GROUP BY 1, 2, 3, 4) m "
    "LEFT JOIN mauc USING (run, subset, model)",
)
CTES["mbest"] = (
    "msum",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, subset ORDER BY macro_f1 DESC, model_no) AS rn "
    "FROM msum) WHERE rn = 1",
)

METRICS = ("accuracy", "precision", "recall", "macro_f1", "roc_auc_ovr")


def results(spark, folder) -> DataFrame:
    """One result document per run and subset, in the layout of ``schemas.RESULTS``."""
    predictions = inputs.model_predictions(spark, folder)
    records = me.evaluation_records(
        predictions, lx.LABEL_NAMES, ["run", "subset", "model", "model_no"], proba="proba"
    )
    entry = F.struct(
        F.col("model_no"),
        F.struct(
            F.col("model").alias("name"),
            F.create_map(F.lit("model_no"), F.col("model_no").cast("string")).alias("best_params"),
            F.col("metrics")["macro_f1"].alias("cv_macro_f1"),
            F.col("metrics"),
        ).alias("e"),
    )
    # As many entries as models were compared.
    models = F.array_sort(
        F.collect_list(entry),
        lambda a, b: a["model_no"].cast("int") - b["model_no"].cast("int"),
    ).getField("e")
    documents = records.groupBy("run", "subset").agg(models.alias("models"))
    # Reports read what runs have written: one small JSON document per run and subset.
    path = f"{checkpoint_folder(spark).rstrip('/')}/results-{uuid.uuid4().hex}"
    write_results(documents, path, by=("run", "subset"))
    return read_written_results(spark, path, by=("run", "subset"))


def _r(names, table="") -> str:
    return ", ".join(f"round({table}{n}, 6) + 0.0 AS {n}" for n in names)


@query(
    "flatten_results",
    f"SELECT run, subset, model, {_r(METRICS)} FROM msum",
    needs="msum",
)
def flatten_results(spark, folder):
    flat = rp.flatten_results(results(spark, folder), "run", "subset")
    return flat.select("run", "subset", "model", *[rounded(c).alias(c) for c in METRICS])


@query(
    "best_model",
    "SELECT run, subset, model AS name, round(macro_f1, 6) AS macro_f1 FROM mbest",
    needs="mbest",
)
def best_model(spark, folder):
    best = rp.best_models(results(spark, folder), ("run", "subset"))
    return best.select(
        "run", "subset", "name", rounded(F.col("metrics")["macro_f1"]).alias("macro_f1")
    )


@query(
    "best_model_restricted",
    "SELECT run, subset, model AS name FROM (SELECT *, row_number() OVER (PARTITION BY run, subset "
    "ORDER BY macro_f1 DESC, model_no) AS rn FROM msum WHERE model <> 'boosted_trees') WHERE rn = 1",
    needs="msum",
)
def best_model_restricted(spark, folder):
    return rp.best_models(
        results(spark, folder), ("run", "subset"), restrict_to=NAMES[:2]
    ).select("run", "subset", "name")


@query(
    "metric_fallback",
    f"SELECT run, subset, model, {_r(('precision', 'recall'))} FROM msum",
    needs="msum",
)
def metric_fallback(spark, folder):
    """Precision with the plain values taken out for one model, and the report for another."""
    models = rp.model_rows(results(spark, folder), "run", "subset")
    m = F.col("metrics")
    no_plain, no_report = F.col("pos") > 0, F.col("pos") > 1
    thinned = models.withColumn(
        "metrics",
        m.withField("precision", F.when(~no_plain, m["precision"]))
        .withField("recall", F.when(~no_plain, m["recall"]))
        .withField("classification_report", F.when(~no_report, m["classification_report"])),
    )
    return thinned.select(
        "run", "subset", F.col("name").alias("model"),
        rounded(rp.metric_with_fallback("precision")).alias("precision"),
        rounded(rp.metric_with_fallback("recall")).alias("recall"),
    )


TABLE = ("macro_f1", "roc_auc", "precision", "recall")
SUBSET_VALUES = ", ".join(f"('{s}')" for s in lx.SUBSETS)


@query(
    "model_subset_table",
    "SELECT g.subset, round(macro_f1, 6) AS macro_f1, round(roc_auc_ovr, 6) AS roc_auc, round(precision, 6) AS precision, "
    f"round(recall, 6) AS recall FROM (VALUES {SUBSET_VALUES}) g(subset) LEFT JOIN msum m ON m.subset = g.subset "
    "AND run = 'encoder' AND model = 'linear_svm'",
    needs="msum",
)
def model_subset_table(spark, folder):
    encoder = results(spark, folder).filter(F.col("run") == "encoder")
    table = rp.model_subset_table(encoder, "linear_svm", text=False)
    return table.select("subset", *[rounded(c).alias(c) for c in TABLE])


@query(
    "best_model_table",
    "SELECT g.subset, coalesce(model, '') AS best_model, "
    + ", ".join(
        f"coalesce(printf('%.2f', {c}), '') AS {a}"
        for c, a in zip(("macro_f1", "roc_auc_ovr", "precision", "recall"), TABLE)
    )
    + f" FROM (VALUES {SUBSET_VALUES}) g(subset) LEFT JOIN mbest m ON m.subset = g.subset AND run = 'encoder'",
    needs="mbest",
)
def best_model_table(spark, folder):
    encoder = results(spark, folder).filter(F.col("run") == "encoder")
    return rp.best_model_table(encoder, restrict_to=NAMES)


F1 = ("f1_negative", "f1_neutral", "f1_positive")


@query(
    "comparison_rows",
    "SELECT run, replace(subset, 'sentences_', '') AS subset, model, "
    + _r(("accuracy", "macro_f1", "roc_auc_ovr") + F1)
    + " FROM mbest",
    needs="mbest",
)
def comparison_rows(spark, folder):
    rows = rp.comparison_rows(results(spark, folder))
    return rows.select(
        "run", "subset", "model",
        *[rounded(c).alias(c) for c in ("accuracy", "macro_f1", "roc_auc_ovr") + F1],
    )


DELTAS = ("accuracy", "macro_f1") + F1


@query(
    "compare_runs",
    "SELECT replace(coalesce(l.subset, r.subset), 'sentences_', '') AS subset, l.model AS model_left, r.model AS model_right, "
    + ", ".join(f"round(r.{c} - l.{c}, 6) + 0.0 AS {c}_delta" for c in DELTAS)
    + " FROM (SELECT * FROM mbest WHERE run = 'tfidf') l FULL JOIN (SELECT * FROM mbest WHERE run = 'encoder') r "
    "ON l.subset = r.subset",
    needs="mbest",
)
def compare_runs(spark, folder):
    both = rp.compare_runs(rp.comparison_rows(results(spark, folder)), "tfidf", "encoder")
    return both.select(
        "subset", "model_left", "model_right",
        *[rounded(f"{c}_delta").alias(f"{c}_delta") for c in DELTAS],
    )


@query(
    "metric_series",
    "SELECT replace(s.subset, 'sentences_', '') AS subset, r.run, round(coalesce(macro_f1, 0), 6) AS macro_f1, "
    "round(coalesce(accuracy, 0), 6) AS accuracy FROM (SELECT DISTINCT subset FROM mbest) s, "
    "(SELECT DISTINCT run FROM mbest) r LEFT JOIN mbest b ON b.subset = s.subset AND b.run = r.run",
    needs="mbest",
)
def metric_series(spark, folder):
    series = rp.metric_series(rp.comparison_rows(results(spark, folder)))
    return series.select(
        "subset", "run", rounded("macro_f1").alias("macro_f1"), rounded("accuracy").alias("accuracy")
    )


@query(
    "report_classes",
    "SELECT DISTINCT run, subset, model, 'negative,neutral,positive' AS classes FROM mp",
    needs="mp",
)
def report_classes(spark, folder):
    models = rp.model_rows(results(spark, folder), "run", "subset")
    names = F.array_sort(rp.report_classes(F.col("metrics")["classification_report"]))
    return models.select(
        "run", "subset", F.col("name").alias("model"), F.array_join(names, ",").alias("classes")
    )


@query("ordered_subsets", "SELECT DISTINCT subset FROM mp", needs="mp")
def ordered_subsets(spark, folder):
    return rp.ordered_subsets(results(spark, folder))


@query(
    "best_row",
    "SELECT run, subset, model, round(macro_f1, 6) AS macro_f1 FROM msum "
    "ORDER BY macro_f1 DESC, run, subset, model LIMIT 1",
    needs="msum",
)
def best_row(spark, folder):
    flat = rp.flatten_results(results(spark, folder), "run", "subset")
    return rp.best_row(flat, "macro_f1", "run", "subset", "model").select(
        "run", "subset", "model", rounded("macro_f1").alias("macro_f1")
    )


COEF = (
    "c AS (SELECT label::VARCHAR AS class, 'f' || (i - 1) AS feature, avg(embedding[i]::DOUBLE) AS coef FROM embeddings, "
    "range(1, 65) r(i) GROUP BY 1, 2)"
)


@query(
    "topk_coefficients",
    f"WITH {COEF} SELECT class, feature, round(coef, 6) + 0.0 AS coef, rank, side FROM ("
    "SELECT *, row_number() OVER (PARTITION BY class ORDER BY coef DESC, feature) AS rank, 'positive' AS side FROM c "
    "UNION ALL SELECT *, row_number() OVER (PARTITION BY class ORDER BY coef, feature), 'negative' FROM c) WHERE rank <= 10",
)
def topk_coefficients(spark, folder):
    """Mean embedding per label as a stand-in for a class x feature coefficient table."""
    rows = (
        inputs.vectors(spark, folder)
        .select(F.col("label").cast("string").alias("class"), F.posexplode("embedding").alias("i", "v"))
        .groupBy("class", F.concat(F.lit("f"), F.col("i")).alias("feature"))
        .agg(F.avg(F.col("v").cast("double")).alias("coef"))
    )
    top = rp.top_coefficients(rows)
    return top.select(
        "class", "feature", rounded("coef").alias("coef"),
        F.col("rank").cast("long").alias("rank"), "side",
    )
