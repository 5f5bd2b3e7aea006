"""Sizes, missing values and variable types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabulens.fixed_values import DATE_NAME_PARTS, NUMBER_PATTERN, UNKNOWN_TOKEN
from tabulens.functions.columns import any_missing, chunks, columns_of, data_type, missing, value
from tabulens.functions.date_shapes import infer_formats

_TYPE_NAMES = ["numeric", "binary", "date", "symbolic"]
_COLUMNS_PER_JOB = 20


def records_and_variables(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records")).withColumn("variables", F.lit(len(df.columns)).cast("bigint"))


def _counts_by_variable(df: DataFrame, flags: dict[str, Column], name: str) -> DataFrame:
    """One global aggregate with one counter per variable, turned into (variable, count) rows."""
    result = None
    for part in chunks(list(flags), _COLUMNS_PER_JOB):
        one = df.agg(*[F.count_if(flags[c]).alias(c) for c in part])
        rows = one.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").alias(name)) for c in part]))
        )
        result = rows if result is None else result.unionAll(rows)
    return result


def missing_per_variable(df: DataFrame) -> DataFrame:
    """Missing values and the text 'unknown' per variable; complete variables are left out."""
    flags = {}
    for c in df.columns:
        flag = missing(df, c)
        if isinstance(data_type(df, c), T.StringType):
            flag = flag | (F.lower(F.col(f"`{c}`")) == UNKNOWN_TOKEN)
        flags[c] = flag
    return _counts_by_variable(df, flags, "nr_missing").filter(F.col("nr_missing") > 0)


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per variable.

    Each column is read and made distinct on its own, in its own type: repeated values go before the shuffle
    and no value list is kept in one task.
    """
    names = [c for c in df.columns if not isinstance(data_type(df, c), (T.MapType, T.ArrayType, T.StructType))]
    if approximate:
        one = df.agg(*[F.approx_count_distinct(value(df, c)).alias(c) for c in names])
        return one.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").alias("n_distinct")) for c in names]))
        )
    counted = None
    for c in names:
        one = df.select(value(df, c).alias("v")).distinct().agg(F.lit(c).alias("variable"), F.count("v").alias("n_distinct"))
        counted = one if counted is None else counted.unionAll(one)
    return counted


def has_two_values(df: DataFrame, names: Sequence[str]) -> dict[str, bool]:
    """Exact test for two distinct values: the smallest and the largest differ and nothing is in between.

    Two map-side aggregates without any distinct set.
    """
    result: dict[str, bool] = {}
    for part in chunks(list(names), _COLUMNS_PER_JOB):
        edges = df.agg(
            *[f(value(df, c)).alias(f"{p}{i}") for i, c in enumerate(part) for p, f in (("lo", F.min), ("hi", F.max))]
        ).first()
        open_ = []
        for i, c in enumerate(part):
            result[c] = False
            if edges[f"lo{i}"] is not None and edges[f"lo{i}"] != edges[f"hi{i}"]:
                open_.append((c, F.lit(edges[f"lo{i}"]), F.lit(edges[f"hi{i}"])))
        if open_:
            between = df.agg(
                *[F.count_if((value(df, c) != lo) & (value(df, c) != hi)).alias(c) for c, lo, hi in open_]
            ).first()
            result.update({c: between[c] == 0 for c, _, _ in open_})
    return result


def _scalar_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]


def semantic_types(df: DataFrame) -> dict[str, str]:
    """Type of each variable from its values: two values are binary, then numbers, dates, symbols.

    Text is a date when one format, inferred from the shapes of its values, fits the whole column. Empty columns are numeric.
    """
    scalars = _scalar_columns(df)
    two = has_two_values(df, scalars)
    result = {c: "symbolic" for c in df.columns}
    text = []
    for c in scalars:
        if two[c]:
            result[c] = "binary"
        elif isinstance(data_type(df, c), (T.NumericType, T.BooleanType)):
            result[c] = "numeric"
        elif c in columns_of(df, "datetime"):
            result[c] = "date"
        else:
            text.append(c)
    for part in chunks(text, 5):
        checks = []
        for i, c in enumerate(part):
            checks.append(F.count_if(~F.col(f"`{c}`").rlike(NUMBER_PATTERN)).alias(f"n{i}"))
        row = df.agg(*checks).first()
        for i, c in enumerate(part):
            if row[f"n{i}"] == 0:
                result[c] = "numeric"
    dates = infer_formats(df, [c for c in text if result[c] == "symbolic"])
    return result | dict.fromkeys(dates, "date")


def storage_types(df: DataFrame, target: str | None = None, skip_long_dates: bool = True) -> dict[str, str]:
    """Type of each variable from its storage: numbers and booleans are numeric, two values are binary.

    The target is left out when given. Date columns with more than 50 values are left out on request.
    """
    others = [c for c in columns_of(df, "text", "datetime") if c != target]
    two = has_two_values(df, others)
    dates = [c for c in columns_of(df, "datetime") if c != target]
    long_dates: set[str] = set()
    if skip_long_dates and dates:
        for c in dates:  # no full count: 51 values are enough to know
            if df.select(c).where(F.col(f"`{c}`").isNotNull()).distinct().limit(51).count() > 50:
                long_dates.add(c)
    result = {}
    for c in df.columns:
        if c == target or c in long_dates:
            continue
        if c in columns_of(df, "number", "bool"):
            result[c] = "numeric"
        elif c in others:
            result[c] = "binary" if two[c] else "symbolic"
    return result


def name_types(df: DataFrame) -> dict[str, str]:
    """Type of text and datetime columns from their names: names with date, time or year are dates."""
    result = {}
    for c in columns_of(df, "text", "datetime"):
        if any(p in c.lower() for p in DATE_NAME_PARTS):
            result[c] = "date"
        elif c in columns_of(df, "text"):
            result[c] = "symbolic"
    return result


def type_table(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """A type dictionary as (variable, type) rows."""
    rows = [(c, t) for c, t in types.items()]
    return df.sparkSession.createDataFrame(rows, "variable string, type string")


def type_counts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Number of variables per type, all four types shown."""
    found = list(types.values())
    rows = [(t, found.count(t)) for t in _TYPE_NAMES]
    return df.sparkSession.createDataFrame(rows, "type string, n bigint")


def dimensionality_table(df: DataFrame) -> DataFrame:
    """Seven (metric, value) rows: sizes, variables per storage kind, rows with a missing value."""
    counted = df.agg(F.count("*").alias("n"), F.count_if(any_missing(df)).alias("incomplete"))
    rows = [
        ("Records", F.col("n")),
        ("Variables", F.lit(len(df.columns))),
        ("Numerical", F.lit(len(columns_of(df, "number")))),
        ("Boolean", F.lit(len(columns_of(df, "bool")))),
        ("Categorical", F.lit(len(columns_of(df, "text")))),
        ("Datetime", F.lit(len(columns_of(df, "datetime")))),
        ("Nan Instances", F.col("incomplete")),
    ]
    return counted.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("bigint").alias("value")) for m, v in rows]))
    )


def sorted_labels(df: DataFrame, column: str, name: str = "label") -> DataFrame:
    return df.select(F.col(column).alias(name)).distinct().orderBy(name)
