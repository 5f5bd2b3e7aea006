"""What models over weighted points share: their labels, and the label counts of many predictions from one pass over the test points."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame

from tabulens.functions.blocks import Blocks
from tabulens.functions.hash_order import MAX_CLASSES


def label_list(train: DataFrame, target: str) -> list:
    rows = train.select(target).where(f"`{target}` is not null").distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{target}' has more than {MAX_CLASSES} classes")
    return sorted(r[0] for r in rows)


def labels_of(train: DataFrame, test: DataFrame, target: str) -> tuple[list, int]:
    """The train labels in order, then those that only test rows have; and the number of train labels, which models know."""
    known = label_list(train, target)
    return known + [v for v in label_list(test, target) if v not in set(known)], len(known)


def counts_of(test: Blocks, labels: Sequence, predictions: Sequence[Callable[[np.ndarray], np.ndarray]]) -> list[list[tuple]]:
    """Per prediction (a function from features to positions of labels, -1: none) the rows (label, predicted, n)."""
    k = len(labels)

    def run(x, y, w):
        out = np.zeros((len(predictions), k, k))
        for table, predict in zip(out, predictions):
            p = predict(x)
            there = (y >= 0) & (p >= 0)
            np.add.at(table, (y[there], p[there]), w[there])
        return out.ravel()

    total = test.sum(run)
    tables = total.reshape(len(predictions), k, k) if len(total) else np.zeros((len(predictions), k, k))
    return [[(labels[i], labels[j], int(t[i, j])) for i, j in zip(*np.nonzero(t))] for t in tables]
