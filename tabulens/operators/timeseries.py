"""Aggregation, splitting, decomposition and forecast errors of time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulens.functions.running import grouped_medians, running_totals

UNITS = {"H": "hour", "D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
EPSILON = 2.220446049250313e-16

AGGREGATES = {
    "mean": lambda v, t: F.avg(v),
    "sum": lambda v, t: F.sum(v),
    "min": lambda v, t: F.min(v),
    "max": lambda v, t: F.max(v),
    "count": lambda v, t: F.count(v),
    "std": lambda v, t: F.stddev_samp(v),
    "var": lambda v, t: F.var_samp(v),
    "sem": lambda v, t: F.stddev_samp(v) / F.sqrt(F.count(v)),
    "prod": lambda v, t: F.product(v),
    "nunique": lambda v, t: F.count_distinct(v),
    "first": lambda v, t: F.min_by(v, F.when(v.isNotNull(), t)),
    "last": lambda v, t: F.max_by(v, F.when(v.isNotNull(), t)),
}


def period_start(ts: Column, level: str) -> Column:
    return F.date_trunc(UNITS[level], ts)


def aggregate_by(
    df: DataFrame, ts: str, values: Sequence[str], level: str = "D", how: str = "mean", by: Sequence[str] = (), key: Sequence[str] = ()
) -> DataFrame:
    """One row per period (and per `by` group); periods without data do not appear, weeks start on Monday.

    "first" and "last" order equal times by the columns `key`.
    """
    if how not in AGGREGATES and how != "median":
        raise ValueError(f"unknown aggregate '{how}'; known: {sorted([*AGGREGATES, 'median'])}")
    period = period_start(F.col(ts), level).cast(df.schema[ts].dataType)
    if how == "median":
        rows = df.select(*by, period.alias(ts), *values)
        result = rows.select(*by, ts).distinct()
        keys = [*by, ts]
        for v in values:
            medians = grouped_medians(rows, keys, v).select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], v)
            same = [F.col(f"_key{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)]  # groups may be null
            result = result.join(medians, same, "left").drop(*[f"_key{i}" for i in range(len(keys))])
        return result
    fn = AGGREGATES[how]
    return df.groupBy(*by, period.alias(ts)).agg(
        *[fn(F.col(v), F.struct(ts, *key) if key else F.col(ts)).alias(v) for v in values]
    )


def deviation_band(df: DataFrame, ts: str, value: str) -> DataFrame:
    """The series with a band of one (rounded) population standard deviation."""
    width = df.agg(F.round(F.stddev_pop(value), 3)).scalar()
    y = F.col(value)
    return df.select(ts, value, (y - width).alias("bottom"), (y + width).alias("top"))


def long_series(df: DataFrame, ts: str, values: Sequence[str]) -> DataFrame:
    """(ts, variable, value) rows of a multivariate series."""
    return df.unpivot(ts, list(values), "variable", "value")


def row_positions(df: DataFrame, ts: str, position: str = "position", range_rows: int | None = None) -> DataFrame:
    """Zero-based position of every row in time order; times must be unique."""
    seconds = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_one", F.lit(1).cast("bigint"))
    kwargs = {"range_rows": range_rows} if range_rows else {}
    numbered = running_totals(seconds, "_t", {"_upto": "_one"}, **kwargs)
    return numbered.withColumn(position, F.col("_upto") - 1).drop("_t", "_one", "_upto")


def decompose_additive(
    df: DataFrame, ts: str, value: str, period: int, block: int = 100_000, range_rows: int | None = None
) -> DataFrame:
    """Trend, seasonal part and residual of a series with one row per time.

    The trend is the centred moving average over one period (half weights at both ends when the period is
    even), missing at the ends; the seasonal part is the mean detrended value of each phase, centred to zero.
    Rows are averaged in blocks that share their border rows, so long series are not pulled into one task.
    """
    reach = period // 2
    at = row_positions(df.select(ts, F.col(value).cast("double").alias(value)), ts, "i", range_rows)
    spread = at.withColumn(
        "block",
        F.explode(F.sequence(
            F.floor((F.greatest(F.col("i") - reach, F.lit(0))) / block), F.floor((F.col("i") + reach) / block)
        )),
    )
    order = Window.partitionBy("block").orderBy("i")
    wide = order.rowsBetween(-reach, reach)
    v = F.col(value)
    full = F.sum(v).over(wide)
    if period % 2 == 0:
        ends = F.lag(v, reach).over(order) + F.lead(v, reach).over(order)
        average = (full - ends / 2) / period
    else:
        average = full / period
    trended = (
        spread.withColumn("_n", F.count(v).over(wide))
        .withColumn("trend", F.when(F.col("_n") == 2 * reach + 1, average))
        .filter(F.floor(F.col("i") / block) == F.col("block"))
        .withColumn("phase", F.col("i") % period)
    )
    phases = {
        r["phase"]: r["m"]
        for r in trended.filter("trend is not null").groupBy("phase").agg(F.avg(v - F.col("trend")).alias("m")).collect()
    }
    if not phases:
        raise ValueError("the series is shorter than one period")
    centre = sum(phases[p] for p in sorted(phases)) / len(phases)
    seasonal = F.element_at(
        F.create_map(*[F.lit(x) for p in sorted(phases) for x in (p, phases[p] - centre)]), F.col("phase")
    )
    return trended.select(
        ts, v.alias("observed"), "trend", seasonal.alias("seasonal"), (v - F.col("trend") - seasonal).alias("residual")
    )


FORECAST_MEASURES = {
    "rmse": lambda y, p: F.sqrt(F.avg((y - p) * (y - p))),
    "mae": lambda y, p: F.avg(F.abs(y - p)),
    "mape": lambda y, p: F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON))),
    "r2": lambda y, p: F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y)),
}


def forecast_errors(df: DataFrame, y: str, p: str, split: str = "split") -> DataFrame:
    """RMSE, MAE, MAPE and R2 per split, in one aggregate; R2 is NULL for a constant series."""
    both = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    return both.groupBy(split).agg(*[m(F.col(y), F.col(p)).alias(n) for n, m in FORECAST_MEASURES.items()])


def tagged_series(train: DataFrame, test: DataFrame, prediction: DataFrame, ts: str, value: str, predicted: str) -> DataFrame:
    """Train, test and prediction as one table with a `part` column."""
    def tag(df: DataFrame, column: str, part: str) -> DataFrame:
        return df.select(ts, F.col(column).alias(value), F.lit(part).alias("part"))

    return tag(train, value, "train").unionByName(tag(test, value, "test")).unionByName(tag(prediction, predicted, "prediction"))
