"""The distributive aggregates on a stream: period aggregation and value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabulens.operators.timeseries import AGGREGATES, UNITS

_DURATIONS = {"H": "1 hour", "D": "1 day"}
_MERGEABLE = ["mean", "sum", "min", "max", "count", "std"]


def stream_aggregate_by(
    stream: DataFrame, ts: str, values: Sequence[str], level: str = "D", how: str = "mean", late: str = "1 hour", by: Sequence[str] = ()
) -> DataFrame:
    """Period aggregation with a watermark; a period is final once the watermark has passed its end."""
    if level not in _DURATIONS or how not in _MERGEABLE:
        raise ValueError(f"streams aggregate by {sorted(_DURATIONS)} with {_MERGEABLE}, not by {UNITS.get(level, level)} with {how}")
    fn = AGGREGATES[how]
    windowed = stream.withWatermark(ts, late).groupBy(F.window(ts, _DURATIONS[level]), *by)
    return windowed.agg(*[fn(F.col(v), F.col(ts)).alias(v) for v in values]).select(
        F.col("window.start").alias(ts), *by, *values
    )


def stream_value_counts(stream: DataFrame, column: str) -> DataFrame:
    """Counts per value over the whole stream, for the complete or update output mode."""
    return stream.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
