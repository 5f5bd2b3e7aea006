"""Date-part and category value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabulens.fixed_values import DATE_LEVELS
from tabulens.functions.columns import columns_of, value
from tabulens.functions.date_shapes import infer_formats, to_dates


def _parts(c: Column) -> dict[str, Column]:
    return {
        "year": F.year(c), "quarter": F.quarter(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c),
    }


def date_variables(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add <name>_year, _quarter, _month and _day."""
    added = {f"{c}_{p}": _parts(F.col(c))[p] for c in names for p in ("year", "quarter", "month", "day")}
    return df.withColumns(added)


def parse_dates(df: DataFrame, names: Sequence[str], fmt: str) -> DataFrame:
    """Text to timestamps; what does not fit the format becomes NULL."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in names})


def has_hours(df: DataFrame, name: str) -> bool:
    """More than one distinct hour of the day."""
    h = F.hour(F.col(name))
    row = df.agg(F.min(h).alias("a"), F.max(h).alias("b")).first()
    return row["a"] is not None and row["a"] != row["b"]


def date_variables_lenient(df: DataFrame, names: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Parse text leniently (in the format given, or the one that its values' shapes tell), add the date parts, and the hour where there is more than one."""
    text = [c for c in names if c in columns_of(df, "text")]
    if text:
        if fmt is None:
            formats = infer_formats(df, text)
            if missing := [c for c in text if c not in formats]:
                raise ValueError(f"no date format fits all values of {', '.join(missing)}; give one")
            df = to_dates(df, formats)
        else:
            df = parse_dates(df, text, fmt)
    result = date_variables(df, names)
    return result.withColumns({f"{c}_hour": F.hour(F.col(c)) for c in names if has_hours(df, c)})


def date_granularity(
    df: DataFrame, name: str, levels: Sequence[str] = tuple(DATE_LEVELS), order: str = "key"
) -> DataFrame:
    """Counts per (level, value) of all date levels in one scan; the hour only where it varies."""
    parts = _parts(F.col(name))
    wanted = [p for p in levels if p != "hour" or has_hours(df, name)]
    entries = [F.struct(F.lit(p).alias("level"), parts[p].cast("bigint").alias("value")) for p in wanted]
    counted = (
        df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
        .groupBy("level", "value").agg(F.count("*").alias("n"))
    )
    if order == "frequency":
        return counted.orderBy("level", F.desc("n"), "value")
    return counted.orderBy("level", "value")


def property_granularity(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Counts of all values of every categorical variable, in frequency order."""
    names = list(names) if names is not None else columns_of(df, "text")
    entries = [F.struct(F.lit(c).alias("variable"), value(df, c).cast("string").alias("value")) for c in names]
    return (
        df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
        .groupBy("variable", "value").agg(F.count("*").alias("n"))
        .orderBy("variable", F.desc("n"), "value")
    )
