"""Cyclic and one-hot encoding."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tabulens.functions.columns import number, value
from tabulens.session import ensure_checkpoint_dir

MAX_CATEGORIES = 2_000


def encode_cyclic(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add <name>_sin and <name>_cos of the angle 2 pi x / max, rounded to three digits."""
    tops = df.agg(*[F.max(number(df, c)).alias(c) for c in names]).first()
    added = {}
    for c in names:
        angle = F.try_divide(number(df, c) * (2 * math.pi), F.lit(tops[c]))
        added[f"{c}_sin"] = F.round(F.sin(angle), 3)
        added[f"{c}_cos"] = F.round(F.cos(angle), 3)
    return df.withColumns(added)


def categories(df: DataFrame, name: str) -> list:
    """Distinct values in ascending order, missing last; refuses columns that are not categories."""
    found = df.select(value(df, name).alias("v")).distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"'{name}' has more than {MAX_CATEGORIES} categories; one column each is not useful")
    values = [r["v"] for r in found]
    return sorted(v for v in values if v is not None) + ([None] if None in values else [])


def one_hot(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace each named variable by boolean columns <name>_<value>; two categories give one column."""
    encoded = []
    for c in names:
        values = categories(df, c)
        for v in values[1:] if len(values) == 2 else values:
            encoded.append(value(df, c).eqNullSafe(F.lit(v)).alias(f"{c}_{v}"))
    return df.select(*[c for c in df.columns if c not in names], *encoded)


def category_positions(df: DataFrame, name: str) -> DataFrame:
    """(value, position): places of all categories in ascending order, missing last, from 0; any number of them.

    The distinct values are cut into ranges; only the sizes of the ranges are brought into one order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col("value").isNull(), F.col("value")]
    found = df.select(value(df, name).alias("value")).distinct().repartitionByRange(*order)
    found = found.withColumn("_piece", F.spark_partition_id()).checkpoint()
    sizes = found.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_piece", (F.sum("_n").over(Window.orderBy("_piece")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(*order)) - 1
    return found.join(before, "_piece").select("value", (F.col("_before") + inside).alias("position"))


def one_hot_long(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """(key columns, position): the place of the one category that is set, for columns with too many categories for one column each."""
    positions = category_positions(df, name)
    rows = df.select(*key, value(df, name).alias("_value"))
    return rows.join(positions, F.col("_value").eqNullSafe(F.col("value"))).select(*key, "position")
