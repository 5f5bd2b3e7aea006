"""Profiles of a whole table, sharing the passes that its parts have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabulens.functions.columns import columns_of
from tabulens.operators import dimensionality, distribution, granularity, sparsity


def profile_dimensionality(df: DataFrame) -> dict[str, DataFrame]:
    types = dimensionality.semantic_types(df)
    return {
        "records": dimensionality.records_and_variables(df),
        "missing": dimensionality.missing_per_variable(df),
        "types": dimensionality.type_table(df, types),
        "type_counts": dimensionality.type_counts(df, types),
    }


def profile_distribution(df: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """Description, box plots, outliers, histograms, fits and their densities, symbol counts and class counts.

    Moments and quartiles are computed once and serve the description, outliers, box plots and bins.
    """
    types = dimensionality.storage_types(df, target)
    numeric = [c for c, t in types.items() if t == "numeric"]
    symbolic = [c for c, t in types.items() if t in ("symbolic", "binary")]
    numbers = columns_of(df, "number")
    summaries = distribution.summarise(df, sorted(set(numeric) | set(numbers), key=df.columns.index))
    result = {
        "describe": distribution.describe_all(df, summaries={c: summaries[c] for c in numbers}) if numbers else distribution.describe_all(df),
        "boxplots": distribution.boxplot_statistics(df, numeric, summaries=summaries),
        "outliers": distribution.outlier_counts(df, numeric, summaries=summaries),
        "histograms": distribution.histogram(df, numeric, summaries=summaries),
        "densities": distribution.histogram(df, numeric, density=True, summaries=summaries),
    }
    fits = distribution.fit_all(df, numeric)
    result["fits"] = distribution.fit_table(df, numeric, fits)
    result["fitted_densities"] = distribution.density_grids(df, numeric, fits, summaries)
    if symbolic:
        result["symbols"] = granularity.property_granularity(df, symbolic)
    if target is not None:
        result["classes"] = distribution.class_distribution(df, target)
    return result


def profile_granularity(df: DataFrame, fmt: str | None = None) -> dict[str, DataFrame]:
    types = dimensionality.name_types(df)
    dates = [c for c, t in types.items() if t == "date"]
    symbols = [c for c, t in types.items() if t == "symbolic"]
    text_dates = [c for c in dates if c in columns_of(df, "text")]
    parsed = granularity.parse_dates(df, text_dates, fmt) if text_dates and fmt else df
    usable = [c for c in dates if c in columns_of(parsed, "datetime")]
    result = {c: granularity.date_granularity(parsed, c) for c in usable}
    if symbols:
        result["properties"] = granularity.property_granularity(df, symbols)
    return result


def profile_sparsity(df: DataFrame, target: str | None = None, bins: int = 10) -> dict[str, DataFrame]:
    """Correlations, pair densities (per class too when there is a target) and grid occupancy."""
    numbers = [c for c in columns_of(df, "number") if c != target]
    result = {
        "correlation": sparsity.correlation_matrix(df),
        "pairs": sparsity.pair_density(df, numbers, bins=bins),
    }
    if target is not None:
        result["pairs_by_class"] = sparsity.pair_density(df, numbers, target, bins)
    result["occupancy"] = sparsity.pair_occupancy(result["pairs"], bins)
    return result
