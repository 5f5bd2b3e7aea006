"""Choosing variables by variance and by redundancy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabulens.functions.columns import columns_of
from tabulens.operators.distribution import Summary, summarise
from tabulens.operators.sparsity import correlation_pairs
from tabulens.sources.tables import write_table


def low_variance_from(summaries: dict[str, Summary], max_threshold: float, target: str) -> list[str]:
    return [
        c for c, s in summaries.items() if c != target and s.std is not None and s.std * s.std < max_threshold
    ]


def low_variance_variables(df: DataFrame, max_threshold: float, target: str = "class") -> list[str]:
    """Number columns whose sample variance is below the threshold; never the target."""
    return low_variance_from(summarise(df, columns_of(df, "number"), quartiles=False), max_threshold, target)


def redundant_from(
    pairs: dict[tuple[str, str], float | None], names: Sequence[str], min_threshold: float, rule: str = "partners"
) -> list[str]:
    """Variables to drop, from absolute correlations of pairs i < j.

    "partners": all partners of a variable that has more than one partner at or above the threshold, so a
    lone pair stays and a group of three goes completely. "keep_first": every later partner of a kept variable.
    """
    partners: dict[str, list[str]] = {c: [] for c in names}
    for (a, b), r in pairs.items():
        # rounded, so that equal columns in other units have a correlation of 1
        if r is not None and round(r, 12) >= min_threshold:
            partners[a].append(b)
            partners[b].append(a)
    place = {c: i for i, c in enumerate(names)}
    dropped: list[str] = []
    for c in names:
        if rule == "keep_first":
            if c not in dropped:
                dropped += [p for p in partners[c] if place[p] > place[c] and p not in dropped]
        elif len(partners[c]) > 1:
            dropped += [p for p in sorted(partners[c], key=place.get) if p not in dropped]
    return dropped


def redundant_variables(
    df: DataFrame, min_threshold: float = 0.90, target: str = "class", rule: str = "partners"
) -> list[str]:
    names = [c for c in columns_of(df, "number", "bool") if c != target]
    return redundant_from(correlation_pairs(df, names), names, min_threshold, rule)


def apply_selection(
    train: DataFrame, test: DataFrame, dropped: Sequence[str], path: str = "", tag: str = "", kind: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Drop the same variables from both tables, and write both when a path is given."""
    train, test = train.drop(*dropped), test.drop(*dropped)
    if path:
        write_table(train, f"{path}_train_{tag}", kind)
        write_table(test, f"{path}_test_{tag}", kind)
    return train, test


def variable_list(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(c,) for c in names], "variable string")
