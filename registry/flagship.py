"""The flagship query: numeric description and outlier counts from shared passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registry.common import table
from tabulens.functions.columns import columns_of
from tabulens.operators.distribution import describe_numeric, outlier_counts, summarise


def describe_with_outliers(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "lineitem")
    names = columns_of(df, "number")
    summaries = summarise(df, names)
    described = describe_numeric(df, names, summaries=summaries)
    return described.join(outlier_counts(df, names, summaries=summaries), "variable").orderBy("variable")
