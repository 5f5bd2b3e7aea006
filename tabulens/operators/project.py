"""Column and row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabulens.functions.columns import any_missing, columns_of, number, value


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def keep_kinds(df: DataFrame, *kinds: str) -> DataFrame:
    """Columns of the kinds number, bool, text, datetime; bool is not a number here."""
    return df.select(*columns_of(df, *kinds))


def numeric_with_target(df: DataFrame, target: str) -> DataFrame:
    """Numeric columns; a target of another type comes last."""
    names = columns_of(df, "number")
    return df.select(*names, *([] if target in names else [target]))


def drop_listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*names)


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows without NULL or NaN in any column, also in columns that are not kept later."""
    return df.filter(~any_missing(df))


def keep_class(df: DataFrame, column: str, wanted: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(wanted))


def outside(df: DataFrame, name: str, bottom: Column | float, top: Column | float) -> DataFrame:
    """Rows strictly above `top` or strictly below `bottom`."""
    v = number(df, name)
    return df.filter((v > top) | (v < bottom))


def positive_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(value(df, name).alias(name)).filter(F.col(name) > 0)
