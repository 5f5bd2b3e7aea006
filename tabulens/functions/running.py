"""Running totals over a global order, computed range by range instead of in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulens.functions.columns import value
from tabulens.session import ensure_checkpoint_dir

RANGE_ROWS = 2_000_000
MAX_RANGES = 4_096


def range_number(c: Column, cuts: Sequence[float]) -> Column:
    """Number of the range that holds the value: how many cut points lie below it."""
    edges = np.asarray(sorted(cuts), dtype="float64")

    @F.pandas_udf("int")
    def locate(v: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, v.to_numpy(dtype="float64"), side="left").astype("int32"))

    return locate(c.cast("double")) if len(edges) else F.lit(0)


def running_totals(
    df: DataFrame,
    order: str,
    totals: dict[str, str],
    descending: bool = False,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add `totals[new] = sum of old over all rows up to this one` in the order of one numeric column.

    `df` must already hold one row per value of `order`, so no range can be filled by one hot value.
    Ranges come from the quantile sketch; only the range sums (at most MAX_RANGES rows) are brought
    into one order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    v = value(df, order).cast("double")
    n = df.count()
    pieces = min(MAX_RANGES, n // range_rows + 1)
    cuts: list[float] = []
    if pieces > 1:
        shares = [i / pieces for i in range(1, pieces)]
        cuts = sorted(set(df.agg(F.percentile_approx(v, shares, 10 * pieces)).first()[0] or []))
    ranged = df.withColumn("_range", range_number(v, cuts))
    direction = F.col(order).desc() if descending else F.col(order).asc()
    within = Window.partitionBy("_range").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    if not cuts:
        return ranged.select(*df.columns, *[F.sum(old).over(within).alias(new) for new, old in totals.items()])

    rows = ranged.groupBy("_range").agg(*[F.sum(old).alias(old) for old in totals.values()]).collect()
    rows.sort(key=lambda r: r["_range"], reverse=descending)
    before: dict[str, list] = {}
    for new, old in totals.items():
        seen = 0
        entries = []
        for r in rows:
            entries += [F.lit(r["_range"]), F.lit(seen)]
            seen += r[old] or 0
        before[new] = entries
    return ranged.select(
        *df.columns,
        *[
            (F.sum(old).over(within) + F.element_at(F.create_map(*before[new]), F.col("_range"))).alias(new)
            for new, old in totals.items()
        ],
    )


def grouped_medians(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Exact median of a column per group, without holding a group in one task.

    Equal values of a group become one counted row. These rows are range-partitioned by group and value, so a
    large group lies in many partitions of even size; the count before each row is the count in the earlier
    partitions of its group plus the running count inside its own partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
        .repartitionByRange(*by, "_v").withColumn("_piece", F.spark_partition_id()).checkpoint()
    )
    groups = Window.partitionBy(*by)
    pieces = (
        counted.groupBy(*by, "_piece").agg(F.sum("_n").alias("_here"))
        .withColumn("_all", F.sum("_here").over(groups))
        .withColumn("_before", F.sum("_here").over(groups.orderBy("_piece")) - F.col("_here"))
        .drop("_here")
    )
    inside = Window.partitionBy(*by, "_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    named = pieces.select("_all", "_before", *[F.col(k).alias(f"_g{i}") for i, k in enumerate([*by, "_piece"])])
    same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate([*by, "_piece"])]  # groups may be null
    placed = counted.join(named, same).withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    lower, upper = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)

    def holds(rank: Column) -> Column:
        return ((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)).cast("int")

    hits = holds(lower) + holds(upper)
    return placed.groupBy(*by).agg((F.sum(F.col("_v") * hits) / 2).alias(value))
