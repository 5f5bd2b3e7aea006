"""Shared helpers of the query registry."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabulens.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A new path under the folder the cluster shares."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles rounded, without negative zeros, as the SQL of the registry does."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expression: str, name: str, digits: int = 6) -> str:
    """The SQL counterpart of `rounded` for one output column."""
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)
