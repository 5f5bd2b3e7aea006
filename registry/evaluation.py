"""Queries of the evaluation metrics on predictions of a fixed rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.common import r, rounded, table, union
from registry.modelling import weighted_sql
from tabulens.operators import evaluation as ev


def two_classes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        (F.col("l_quantity") * (1 - F.col("l_discount")) > 20).cast("int").alias("y"),
        (F.col("l_quantity") > 25).cast("int").alias("p"),
        F.col("l_quantity").alias("score"), (F.col("l_extendedprice") - 500 * F.col("l_tax")).alias("price"),
        F.when(F.col("l_shipdate") < "1999-01-01", "train").otherwise("test").alias("split"),
    )


TWO = """(SELECT (l_quantity * (1 - l_discount) > 20)::INT AS y, (l_quantity > 25)::INT AS p, l_quantity AS score, l_extendedprice - 500 * l_tax AS price,
 CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS split FROM lineitem)"""


def many_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Five true labels; one label is never predicted, one predicted label never occurs."""
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("y"),
        F.when(F.col("o_totalprice") < 100000, "1-URGENT").when(F.col("o_totalprice") < 200000, "2-HIGH")
        .when(F.col("o_totalprice") < 300000, "3-MEDIUM").when(F.col("o_totalprice") < 400000, "4-NOT SPECIFIED")
        .otherwise("6-NEVER").alias("p"),
    )


MANY = """(SELECT o_orderpriority AS y, CASE WHEN o_totalprice < 100000 THEN '1-URGENT' WHEN o_totalprice < 200000 THEN '2-HIGH'
 WHEN o_totalprice < 300000 THEN '3-MEDIUM' WHEN o_totalprice < 400000 THEN '4-NOT SPECIFIED' ELSE '6-NEVER' END AS p FROM orders)"""

MANY_COUNTS = f"(SELECT y, p, count(*) AS n FROM {MANY} GROUP BY y, p)"


def averages(kind: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(ev.average_scores(ev.label_counts(many_classes(spark, folder)), kind).select("accuracy", "precision", "recall"))

    return query


def f1_and_binary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.binary_scores(ev.label_counts(two_classes(spark, folder))))


def _binary_sql(source: str, by: str = "") -> str:
    group, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {group}(tp + tn) / n AS accuracy, tp / (tp + fn) AS recall, tp / (tp + fp) AS "precision",
 (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc, 2 * tp / (2 * tp + fp + fn) AS f1 FROM (SELECT {group}count(*) AS n,
 count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 1) AS fp, count_if(y = 1 AND p = 0) AS fn, count_if(y = 0 AND p = 0) AS tn FROM {source}{tail})"""


_METRICS = ["accuracy", "recall", "precision", "auc", "f1"]


def _steps(score: str) -> str:
    return f"""(SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM
 (SELECT {score} AS s, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM {TWO} GROUP BY 1))"""


def _auc(score: str) -> str:
    return f"SELECT {r('sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg))', 'auc')} FROM {_steps(score)}"


def roc(spark: SparkSession, folder: str) -> DataFrame:
    curve = ev.roc_curve(two_classes(spark, folder), "y", ["score", "p"])
    return rounded(curve.withColumn("threshold", F.when(F.col("threshold") != float("inf"), F.col("threshold"))))


def _roc(score: str) -> str:
    return f"""SELECT '{score}' AS model, s::DOUBLE AS threshold, {r('fp / sum(neg) OVER ()', 'fpr')}, {r('tp / sum(pos) OVER ()', 'tpr')} FROM {_steps(score)}
UNION ALL SELECT '{score}', NULL, 0.0, 0.0"""


def report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ev.classification_report(many_classes(spark, folder)))


REPORT = f"""WITH scores AS (SELECT label, sum(tp) AS tp, sum(predicted) AS predicted, sum(support)::BIGINT AS support,
  CASE WHEN sum(predicted) > 0 THEN sum(tp) / sum(predicted) ELSE 0 END AS prec, CASE WHEN sum(support) > 0 THEN sum(tp) / sum(support) ELSE 0 END AS rec,
  CASE WHEN sum(predicted) + sum(support) > 0 THEN 2 * sum(tp) / (sum(predicted) + sum(support)) ELSE 0 END AS f
 FROM (SELECT y AS label, n AS support, 0 AS predicted, CASE WHEN y = p THEN n ELSE 0 END AS tp FROM {MANY_COUNTS}
  UNION ALL SELECT p, 0, n, 0 FROM {MANY_COUNTS}) GROUP BY label)
SELECT label, {r('prec', '"precision"')}, {r('rec', 'recall')}, {r('f', 'f1')}, support FROM scores
UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f), 6), sum(support)::BIGINT FROM scores
UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM scores
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM scores"""


def train_and_test(spark: SparkSession, folder: str) -> DataFrame:
    df = two_classes(spark, folder)
    return rounded(ev.evaluation_table(df.filter("split = 'train'"), df.filter("split = 'test'")))


QUERIES = {
    "m01_accuracy": lambda s, d: rounded(ev.accuracy(two_classes(s, d))),
    "m02_m03_weighted_scores": averages("weighted"),
    "m02_m03_macro_scores": averages("macro"),
    "m02_m03_m04_binary_scores": f1_and_binary,
    "m05_auc": lambda s, d: rounded(ev.auc(two_classes(s, d), "y", "score")),
    "m05_auc_many_scores": lambda s, d: rounded(ev.auc(two_classes(s, d), "y", "price")),
    "m05_auc_ranges": lambda s, d: rounded(ev.auc(two_classes(s, d), "y", "price", range_rows=1_000)),
    "m06_roc_curve": roc,
    "m07_confusion_matrix": lambda s, d: ev.confusion_matrix(many_classes(s, d)),
    "m08_classification_report": report,
    "m09_train_test_table": train_and_test,
}

ORACLES = {
    "m01_accuracy": f"SELECT {r('avg((y = p)::INT)', 'accuracy')} FROM {TWO}",
    "m02_m03_weighted_scores": weighted_sql(MANY_COUNTS, ""),
    "m02_m03_macro_scores": weighted_sql(MANY_COUNTS, "", "macro"),
    "m02_m03_m04_binary_scores": f"SELECT {', '.join(r(q, q) for q in ('accuracy', 'recall', 'auc', 'f1'))}, {r(chr(34) + 'precision' + chr(34), 'precision')} FROM ({_binary_sql(TWO)})",
    "m05_auc": _auc("score"),
    "m05_auc_many_scores": _auc("price"),
    "m05_auc_ranges": _auc("price"),
    "m06_roc_curve": union([_roc("score"), _roc("p")]),
    "m07_confusion_matrix": f"""WITH c AS {MANY_COUNTS}, l AS (SELECT y AS v FROM c UNION SELECT p FROM c)
SELECT a.v AS true_label, b.v AS pred_label, coalesce(sum(n), 0)::BIGINT AS n FROM l a JOIN l b ON true LEFT JOIN c ON c.y = a.v AND c.p = b.v GROUP BY 1, 2""",
    "m08_classification_report": REPORT,
    "m09_train_test_table": f"WITH s AS ({_binary_sql(TWO, 'split')}) " + union([
        f"""SELECT '{m}' AS metric, round((SELECT "{m}" FROM s WHERE split = 'train'), 6) AS train, round((SELECT "{m}" FROM s WHERE split = 'test'), 6) AS test"""
        for m in _METRICS
    ]),
}
