"""Classification metrics. Every metric starts from grouped (label, prediction) counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabulens.functions.hash_order import MAX_CLASSES
from tabulens.functions.running import RANGE_ROWS, running_totals


def _share(a: Column, b: Column) -> Column:
    """a / b with 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def label_counts(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """(by..., y, p, n): the only pass over the predictions."""
    return df.groupBy(*by, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count("*").alias("n"))


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label, over true and predicted labels; empty ratios are 0."""
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    )
    summed = counts.select(*by, F.inline(sides)).groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support")
    )
    return summed.select(
        *by, "label", "tp", "predicted", "support",
        _share(F.col("tp"), F.col("predicted")).alias("precision"),
        _share(F.col("tp"), F.col("support")).alias("recall"),
        _share(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )


def average_scores(counts: DataFrame, average: str = "weighted", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the weighted or macro average of precision, recall and F1."""
    scores = class_scores(counts, by)

    def mean(c: str) -> Column:
        if average == "macro":
            return F.avg(c)
        return _share(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    return scores.groupBy(*by).agg(
        _share(F.sum("tp"), F.sum("support")).alias("accuracy"),
        mean("precision").alias("precision"), mean("recall").alias("recall"), mean("f1").alias("f1"),
    )


def binary_scores(counts: DataFrame, positive: object = 1, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, recall, precision, AUC of the hard labels and F1 of the positive class."""
    y, p, n = F.col("y") == F.lit(positive), F.col("p") == F.lit(positive), F.col("n")
    summed = counts.groupBy(*by).agg(
        F.sum(n).alias("n"),
        F.coalesce(F.sum(F.when(y & p, n)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(~y & p, n)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(y & ~p, n)), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~y & ~p, n)), F.lit(0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return summed.select(
        *by,
        _share(tp + tn, F.col("n")).alias("accuracy"),
        _share(tp, tp + fn).alias("recall"),
        _share(tp, tp + fp).alias("precision"),
        ((F.try_divide(tp.cast("double"), (tp + fn).cast("double")) + F.try_divide(tn.cast("double"), (tn + fp).cast("double"))) / 2).alias("auc"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def accuracy(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("int")).alias("accuracy"))


def all_labels(counts: DataFrame) -> list:
    """Sorted labels that occur as truth or prediction."""
    found = counts.select(F.explode(F.array("y", "p")).alias("label")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} labels; this is not a classification result")
    return sorted(r["label"] for r in found)


def confusion_matrix(df: DataFrame, y: str = "y", p: str = "p", labels: Sequence | None = None) -> DataFrame:
    """(true_label, pred_label, n) for every pair of labels, also pairs that do not occur."""
    counts = label_counts(df, y, p)
    labels = list(labels) if labels is not None else all_labels(counts)
    values = F.array(*[F.lit(v) for v in labels])
    grid = (
        df.sparkSession.range(1).select(F.explode(values).alias("true_label"))
        .select("true_label", F.explode(values).alias("pred_label"))
    )
    named = counts.select(F.col("y").alias("true_label"), F.col("p").alias("pred_label"), "n")
    return grid.join(named, ["true_label", "pred_label"], "left").select(
        "true_label", "pred_label", F.coalesce("n", F.lit(0)).alias("n")
    )


def classification_report(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Scores per label plus the accuracy, macro and weighted rows."""
    return report_of(label_counts(df, y, p))


def report_of(counts: DataFrame) -> DataFrame:
    """The classification report from (y, p, n)."""
    scores = class_scores(counts).select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support")
    total = counts.agg(F.sum("n").alias("support"))
    rows = scores
    for name, average in (("macro avg", "macro"), ("weighted avg", "weighted")):
        rows = rows.unionByName(
            average_scores(counts, average).select(
                F.lit(name).alias("label"), "precision", "recall", "f1", total.scalar().alias("support")
            )
        )
    acc = counts.agg(
        _share(F.coalesce(F.sum(F.when(F.col("y") == F.col("p"), F.col("n"))), F.lit(0)), F.sum("n")).alias("a"),
        F.sum("n").alias("support"),
    )
    return rows.unionByName(
        acc.select(F.lit("accuracy").alias("label"), F.col("a").alias("precision"), F.col("a").alias("recall"), F.col("a").alias("f1"), "support")
    )


def _score_steps(df: DataFrame, y: str, score: str, positive: object, range_rows: int) -> DataFrame:
    """Positives and negatives at or above every distinct score."""
    is_positive = F.col(y) == F.lit(positive)
    per_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")
    )
    return running_totals(per_score, "score", {"tp": "pos", "fp": "neg"}, descending=True, range_rows=range_rows)


def auc(df: DataFrame, y: str, score: str, positive: object = 1, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over all distinct scores."""
    steps = _score_steps(df, y, score, positive, range_rows)
    area = F.sum((F.col("neg") * (F.col("tp") + F.col("tp") - F.col("pos"))).cast("double") / 2)
    return steps.agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def roc_curve(df: DataFrame, y: str, scores: Sequence[str], positive: object = 1, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(model, threshold, fpr, tpr) per distinct score of each model, starting at (0, 0)."""
    spark = df.sparkSession
    is_positive = F.col(y) == F.lit(positive)
    sizes = df.agg(F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg")).first()
    result = None
    for s in scores:
        steps = _score_steps(df, y, s, positive, range_rows)
        points = steps.select(
            F.lit(s).alias("model"), F.col("score").alias("threshold"),
            F.try_divide(F.col("fp").cast("double"), F.lit(float(sizes["neg"]))).alias("fpr"),
            F.try_divide(F.col("tp").cast("double"), F.lit(float(sizes["pos"]))).alias("tpr"),
        )
        start = spark.range(1).select(
            F.lit(s).alias("model"), F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
        )
        points = start.unionAll(points)
        result = points if result is None else result.unionAll(points)
    return result


def evaluation_table(train: DataFrame, test: DataFrame, y: str = "y", p: str = "p", positive: object = 1) -> DataFrame:
    """(metric, train, test) for the five binary metrics."""
    both = train.select(F.lit("train").alias("split"), F.col(y).alias("y"), F.col(p).alias("p")).unionAll(
        test.select(F.lit("test").alias("split"), F.col(y).alias("y"), F.col(p).alias("p"))
    )
    scores = binary_scores(label_counts(both, by=["split"]), positive, by=["split"])
    names = ["accuracy", "recall", "precision", "auc", "f1"]
    long = scores.select("split", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in names])))
    return long.groupBy("metric").agg(
        F.max(F.when(F.col("split") == "train", F.col("v"))).alias("train"),
        F.max(F.when(F.col("split") == "test", F.col("v"))).alias("test"),
    )


def best_configuration(results: DataFrame, metric: str, position: str, by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metric; among equals the first in grid order."""
    others = [c for c in results.columns if c not in by]
    best = results.groupBy(*by).agg(
        F.min_by(F.struct(*others), F.struct(-F.col(metric), F.col(position))).alias("best")
    )
    return best.select(*by, "best.*")
