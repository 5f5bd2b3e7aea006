"""Missing-value strategies: dropping and filling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tabulens.fixed_values import FILL_BINARY, FILL_NUMERIC, FILL_SYMBOLIC
from tabulens.functions.columns import chunks, data_type, key_list, missing, number, value
from tabulens.operators.dimensionality import semantic_types
from tabulens.operators.distribution import top_values
from tabulens.operators.neighbours import fill_from_neighbours

_COLUMNS_PER_JOB = 30


def drop_sparse(df: DataFrame, min_share_per_variable: float = 0.1, min_share_per_record: float = 0.0) -> DataFrame:
    """Keep variables with enough values, then rows with enough values.

    Both limits count values; the row limit is a share of the original number of variables.
    """
    total, filled = df.count(), {}
    for part in chunks(df.columns, _COLUMNS_PER_JOB):
        row = df.agg(*[F.count_if(~missing(df, c)).alias(c) for c in part]).first()
        filled.update({c: row[c] for c in part})
    kept = [c for c in df.columns if filled[c] >= total * min_share_per_variable]
    result = df.select(*[F.col(f"`{c}`") for c in kept])
    least = math.ceil(round(len(df.columns) * min_share_per_record, 9))
    if least <= 0 or not kept:
        return result
    present = [F.when(missing(result, c), 0).otherwise(1) for c in kept]
    return result.filter(sum(present[1:], present[0]) >= least)


def _fill_literal(df: DataFrame, name: str, v: object):
    to = data_type(df, name)
    if isinstance(v, bool) and isinstance(to, (T.DateType, T.TimestampType)):
        return value(df, name).alias(name)  # no constant stands for a missing date
    filled = F.lit(v).cast("string").cast(to) if isinstance(to, T.StringType) else F.lit(v).cast(to)
    return F.coalesce(value(df, name), filled).alias(name)


def fill_missing(
    df: DataFrame,
    strategy: str = "frequent",
    key: str | Sequence[str] | None = None,
    drop_dates: bool = False,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Fill by strategy "frequent" (mean or most frequent value), "constant" or "knn".

    Key columns pass through. Columns come back as key, numeric, symbolic, binary, then dates (which are never
    filled). A whole-number column filled by its mean becomes a double.
    """
    keys = key_list(key) if key is not None else []
    if strategy == "knn":
        if not keys:
            raise ValueError("the knn strategy needs a key")
        return fill_from_neighbours(df, keys)
    rest = df.drop(*keys)
    types = types or semantic_types(rest)
    of = {t: [c for c in rest.columns if types[c] == t] for t in ("numeric", "symbolic", "binary", "date")}
    if strategy == "constant":
        filled = [_fill_literal(df, c, FILL_NUMERIC) for c in of["numeric"]]
        filled += [_fill_literal(df, c, FILL_SYMBOLIC) for c in of["symbolic"]]
        filled += [_fill_literal(df, c, FILL_BINARY) for c in of["binary"]]
    elif strategy == "frequent":
        means: dict[str, float | None] = {}
        for part in chunks(of["numeric"], _COLUMNS_PER_JOB):
            row = df.agg(*[F.avg(_as_number(df, c)).alias(c) for c in part]).first()
            means.update({c: row[c] for c in part})
        modes = _modes(df, of["symbolic"] + of["binary"])
        filled = [F.coalesce(_as_number(df, c), F.lit(means[c]).cast("double")).alias(c) for c in of["numeric"]]
        filled += [
            F.coalesce(value(df, c), F.lit(modes.get(c)).cast(data_type(df, c))).alias(c)
            for c in of["symbolic"] + of["binary"]
        ]
    else:
        raise ValueError(f"unknown strategy '{strategy}'")
    dates = [] if drop_dates else [F.col(f"`{c}`") for c in of["date"]]
    return df.select(*keys, *filled, *dates)


def _as_number(df: DataFrame, name: str):
    if isinstance(data_type(df, name), T.StringType):
        return F.col(f"`{name}`").try_cast("double")
    return number(df, name)


def _modes(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Most frequent value per column. Numeric columns break ties by number, others by text."""
    found: dict[str, str] = {}
    texts = [c for c in names if not isinstance(data_type(df, c), T.NumericType)]
    if texts:
        found.update({r["variable"]: r["top"] for r in top_values(df, texts).collect()})
    for c in names:
        if c not in texts:
            v = number(df, c).alias("v")
            row = (
                df.select(v).filter("v is not null").groupBy("v").agg(F.count("*").alias("n"))
                .agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("top")).first()
            )
            if row["top"] is not None:
                found[c] = str(row["top"])
    return found
