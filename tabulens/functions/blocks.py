"""Equal rows as weighted points, kept in numpy blocks for models that pass over the train table many times.

A pass runs a function on every block and sums its vectors: within each task, then in groups of tasks, then on the driver. Only vectors of
the size of the parameters leave the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
import itertools
import math

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tabulens.functions.columns import any_missing, number

#: Points in a block, points of a task where there are more than the cores need, and tasks whose vectors are summed together before the driver.
BLOCK_POINTS = 4_096
PART_POINTS = 500_000
FAN_IN = 32

def weighted_points(df: DataFrame, features: Sequence[str], target: str, labels: Sequence) -> DataFrame:
    """(x, y, w): each distinct feature vector and label (as its position in `labels`) with the number of its rows."""
    places = F.create_map(*[F.lit(v) for i, label in enumerate(labels) for v in (label, i)])
    gap = F.raise_error(F.lit("a row lacks a feature; fill or drop such rows first")).cast("double")
    values = [F.coalesce(number(df, f), gap) + F.lit(0.0) for f in features]
    return df.select(F.array(*values).alias("x"), F.element_at(places, F.col(target)).alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))


def counted_points(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(x, label, w) as in `weighted_points`, from one scan that needs no labels; gaps stay in it for `refuse_gap_points`."""
    values = [number(df, f) + F.lit(0.0) for f in features]
    return df.select(F.array(*values).alias("x"), F.col(target).alias("label")).groupBy("x", "label").agg(F.count(F.lit(1)).alias("w"))


def placed_points(counted: DataFrame, labels: Sequence) -> DataFrame:
    """(x, y, w) of counted points: labels become their positions."""
    places = F.create_map(*[F.lit(v) for i, label in enumerate(labels) for v in (label, i)])
    return counted.select("x", F.element_at(places, F.col("label")).alias("y"), "w")


def refuse_gaps(df: DataFrame, features: Sequence[str]) -> None:
    if not df.where(any_missing(df, features)).isEmpty():
        raise ValueError("a row lacks a feature; fill or drop such rows first")


def refuse_gap_points(counted: DataFrame) -> None:
    if not counted.where(F.exists("x", lambda v: v.isNull())).isEmpty():
        raise ValueError("a row lacks a feature; fill or drop such rows first")


def _gathered(rows: Iterator, width: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    while some := list(itertools.islice(rows, limit)):
        x = np.array([r[0] for r in some], float).reshape(-1, width)
        yield x, np.array([-1 if r[1] is None else r[1] for r in some], np.int64), np.array([r[2] for r in some], float)


class Blocks:
    """Kept blocks of weighted points. Use as a context; lost blocks are computed again.

    A model makes hundreds of passes, so a pass runs on kept numpy arrays; as a query over the rows it would spend most of its time on plans.
    """

    def __init__(self, points: DataFrame, n_features: int, block_points: int = BLOCK_POINTS):
        self.width, self.block_points, self.points = n_features, block_points, points.select("x", "y", "w")

    def __enter__(self) -> Blocks:
        kept = self.points.persist(StorageLevel.MEMORY_AND_DISK)
        n = kept.count()
        # a pass takes one task a core: fewer leave cores idle, more cost time in every pass
        parts = max(1, min(n // self.block_points, max(kept.sparkSession.sparkContext.defaultParallelism, math.ceil(n / PART_POINTS))))
        # the values themselves decide the block, so a task that runs again makes the same blocks
        spread = kept.repartition(parts, "x", "y").sortWithinPartitions("x", "y")
        width, limit = self.width, self.block_points
        self.blocks = spread.rdd.mapPartitions(lambda rows: _gathered(rows, width, limit)).persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = self.blocks.getNumPartitions()
        self.blocks.count()
        kept.unpersist()
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()

    def sum(self, function: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all blocks of function(x, y, w), a vector of doubles; an empty vector without any block."""

        def run(part: int, blocks: Iterator) -> Iterator:
            found = [function(*b) for b in blocks]
            if found:
                yield part, np.sum(found, axis=0)

        sums, parts = self.blocks.mapPartitionsWithIndex(run), self.parts
        while parts > 2 * FAN_IN:
            parts = math.ceil(parts / FAN_IN)
            groups = sums.map(lambda s: (s[0] // FAN_IN, s)).groupByKey(parts)
            sums = groups.map(lambda g: (g[0], np.sum([v for _, v in sorted(g[1], key=lambda s: s[0])], axis=0)))
        found = [v for _, v in sorted(sums.collect(), key=lambda s: s[0])]
        return np.sum(found, axis=0) if found else np.zeros(0)
