"""Naive Bayes as aggregates: one grouped aggregate fits, column expressions predict."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tabulens.functions.columns import chunks, number
from tabulens.functions.hash_order import MAX_CLASSES

VARIANTS = ["gaussian", "multinomial", "bernoulli"]
_SMOOTHING = 1e-9
_COLUMNS_PER_JOB = 18


def _lacking(df: DataFrame, features: Sequence[str]) -> Column:
    """True where a row lacks one of the features."""
    return functools.reduce(Column.__or__, [number(df, f).isNull() for f in features])


class NegativeValues(ValueError):
    """Multinomial Naive Bayes needs features without negative values."""


@dataclass
class BayesModel:
    """Per class: label, log prior, constant, and one (a, b) pair per feature.

    gaussian: score - (x - a)^2 * b; multinomial: score + x * a; bernoulli: score + a where x > 0, else + b.
    """

    variant: str
    features: list[str]
    classes: list[tuple[object, float, list[tuple[float, float]]]]

    def scores(self, df: DataFrame) -> list[Column]:
        result = []
        for _, constant, pairs in self.classes:
            score = F.lit(constant)
            for f, (a, b) in zip(self.features, pairs):
                x = number(df, f)
                if self.variant == "gaussian":
                    score = score - (x - F.lit(a)) * (x - F.lit(a)) * F.lit(b)
                elif self.variant == "multinomial":
                    score = score + x * F.lit(a)
                else:
                    score = score + F.when(x > 0, F.lit(a)).otherwise(F.lit(b))
            result.append(score)
        return result

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the most likely class; equal scores take the smallest label. A row that lacks a feature is an error."""
        ranked = F.array_max(
            F.array(*[F.struct(s.alias("s"), F.lit(-i).alias("i")) for i, s in enumerate(self.scores(df))])
        )
        labels = F.array(*[F.lit(c[0]) for c in self.classes])
        refused = F.raise_error(F.lit("a row lacks a feature; fill or drop such rows first"))
        return df.withColumn(name, F.when(_lacking(df, self.features), refused).otherwise(F.element_at(labels, F.lit(1) - ranked["i"])))


def _largest_variance(classes: list[dict], width: int) -> float:
    """Largest variance of a feature over all rows, from the counts, means and variances per class."""
    n = sum(c["n"] for c in classes)
    largest = 0.0
    for i in range(width):
        mean = sum(c["n"] * c["a"][i] for c in classes) / n
        largest = max(largest, sum(c["n"] * (c["b"][i] + (c["a"][i] - mean) ** 2) for c in classes) / n)
    return largest


def fit_bayes(train: DataFrame, features: Sequence[str], target: str, variant: str = "gaussian") -> BayesModel:
    """Fit from counts, means and variances per class (or sums per class)."""
    features = list(features)
    stats: dict[object, dict] = {}
    for part in chunks(features, _COLUMNS_PER_JOB):
        aggregates = [F.count("*").alias("_n"), F.count_if(_lacking(train, part)).alias("_gaps")]
        for i, f in enumerate(part):
            x = number(train, f)
            if variant == "gaussian":
                aggregates += [F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"b{i}")]
            elif variant == "multinomial":
                aggregates += [F.sum(x).alias(f"a{i}"), F.min(x).alias(f"b{i}")]
            else:
                aggregates.append(F.count_if(x > 0).alias(f"a{i}"))
        rows = train.groupBy(F.col(target).alias("_y")).agg(*aggregates).limit(MAX_CLASSES + 1).collect()
        if len(rows) > MAX_CLASSES:
            raise ValueError(f"'{target}' has more than {MAX_CLASSES} classes")
        if any(r["_gaps"] for r in rows):
            raise ValueError("a train row lacks a feature; fill or drop such rows first")
        for r in rows:
            entry = stats.setdefault(r["_y"], {"n": r["_n"], "a": [], "b": []})
            entry["a"] += [r[f"a{i}"] for i in range(len(part))]
            if variant != "bernoulli":
                entry["b"] += [r[f"b{i}"] for i in range(len(part))]
    if variant == "multinomial" and any(v is not None and v < 0 for s in stats.values() for v in s["b"]):
        raise NegativeValues("negative values in the features of a multinomial model")
    largest = _largest_variance(list(stats.values()), len(features)) if variant == "gaussian" else 0.0

    total = sum(s["n"] for s in stats.values())
    classes = []
    for label in sorted(stats):
        s = stats[label]
        constant = math.log(s["n"] / total)
        if variant == "gaussian":
            spread = [v + _SMOOTHING * largest for v in s["b"]]
            constant -= 0.5 * sum(math.log(2 * math.pi * v) for v in spread)
            pairs = [(m, 0.5 / v) for m, v in zip(s["a"], spread)]
        elif variant == "multinomial":
            mass = sum(s["a"]) + len(features)
            pairs = [(math.log((a + 1) / mass), 0.0) for a in s["a"]]
        else:
            pairs = [(math.log((a + 1) / (s["n"] + 2)), math.log(1 - (a + 1) / (s["n"] + 2))) for a in s["a"]]
        classes.append((label, constant, pairs))
    return BayesModel(variant, features, classes)
