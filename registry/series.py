"""Queries of the time-series operators on the event stream table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.common import r, rounded, table, union
from tabulens.operators import sampling, timeseries as ts


def daily(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").withColumn("users", F.col("user_id"))
    return ts.aggregate_by(e, "ts", ["value", "users"], "D")


DAILY = "(SELECT date_trunc('day', ts) AS ts, avg(value) AS value, avg(user_id) AS users FROM events GROUP BY 1)"


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return ts.aggregate_by(table(spark, folder, "events"), "ts", ["value"], "H", "sum")


HOURLY = "(SELECT date_trunc('hour', ts) AS ts, sum(value) AS value FROM events GROUP BY 1)"


def aggregated(level: str, how: str):
    return lambda s, d: rounded(ts.aggregate_by(table(s, d, "events"), "ts", ["value"], level, how), 8)


_SQL_AGGREGATES = {
    "mean": "avg(value)", "sum": "sum(value)", "min": "min(value)", "max": "max(value)", "std": "stddev_samp(value)",
    "median": "median(value)", "first": "arg_min(value, ts)", "last": "arg_max(value, ts)",
}
_LEVELS = {"H": "hour", "D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
_AGGREGATIONS = [("D", "mean"), ("H", "sum"), ("W", "max"), ("M", "min"), ("Q", "std"), ("Y", "median"), ("D", "first"), ("D", "last")]


def naive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The value of the same hour one week before, as a prediction; rows by hour."""
    h = hourly(spark, folder)
    earlier = h.select((F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("ts"), F.col("value").alias("p"))
    joined = h.join(earlier, "ts")
    return sampling.mark_temporal_split(joined, "ts", name="split")


FORECAST = f"""(SELECT a.ts, a.value, b.value AS p, CASE WHEN row_number() OVER (ORDER BY a.ts) <= floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'test' END AS split
 FROM {HOURLY} a JOIN {HOURLY} b ON b.ts + INTERVAL 7 DAYS = a.ts)"""


def t08(spark: SparkSession, folder: str) -> DataFrame:
    df = naive_forecast(spark, folder)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return rounded(ts.tagged_series(train, test, test, "ts", "value", "p"), 8)


def _decomposition(source: str, period: int, digits: int = 8) -> str:
    reach = period // 2
    if period % 2:
        average = f"sum(value) OVER w / {period}"
    else:
        average = f"(sum(value) OVER w - (lag(value, {reach}) OVER (ORDER BY i) + lead(value, {reach}) OVER (ORDER BY i)) / 2) / {period}"
    return f"""WITH s AS (SELECT ts, value, row_number() OVER (ORDER BY ts) - 1 AS i FROM {source}),
 t AS (SELECT *, CASE WHEN count(*) OVER w = {2 * reach + 1} THEN {average} END AS trend FROM s WINDOW w AS (ORDER BY i ROWS BETWEEN {reach} PRECEDING AND {reach} FOLLOWING)),
 m AS (SELECT i % {period} AS phase, avg(value - trend) AS m FROM t WHERE trend IS NOT NULL GROUP BY 1),
 c AS (SELECT phase, m - (SELECT avg(m) FROM m) AS seasonal FROM m)
SELECT ts, {r('value', 'observed', digits)}, {r('trend', 'trend', digits)}, {r('seasonal', 'seasonal', digits)}, {r('value - trend - seasonal', 'residual', digits)} FROM t JOIN c ON phase = i % {period}"""


def events_split(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.mark_temporal_split(table(spark, folder, "events").select("event_id", "ts", "value"), "ts", "event_id")


def orders_split(spark: SparkSession, folder: str) -> DataFrame:
    """Many orders share a date, so the key decides at the border."""
    return sampling.mark_temporal_split(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


def t02(spark: SparkSession, folder: str) -> DataFrame:
    train, test = sampling.series_split(table(spark, folder, "events"), "ts", "value", "event_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _split(columns: str, source: str, order: str) -> str:
    return f"SELECT {columns}, CASE WHEN row_number() OVER (ORDER BY {order}) <= floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'test' END AS part FROM {source}"


QUERIES = {
    **{f"t01_aggregate_{_LEVELS[level]}_{how}": aggregated(level, how) for level, how in _AGGREGATIONS},
    "t01_aggregate_by_type": lambda s, d: rounded(ts.aggregate_by(table(s, d, "events"), "ts", ["value"], "D", "mean", ["event_type"]), 8),
    "t02_series_split": t02,
    "t03_temporal_split": events_split,
    "t03_temporal_split_ties": orders_split,
    "t04_decomposition_week": lambda s, d: rounded(ts.decompose_additive(daily(s, d), "ts", "value", 7), 8),
    "t04_decomposition_day": lambda s, d: rounded(ts.decompose_additive(hourly(s, d), "ts", "value", 24, block=100, range_rows=200), 6),
    "t05_deviation_band": lambda s, d: rounded(ts.deviation_band(daily(s, d), "ts", "value"), 8),
    "t06_long_series": lambda s, d: rounded(ts.long_series(daily(s, d), "ts", ["value", "users"]), 8),
    "t07_forecast_errors": lambda s, d: rounded(ts.forecast_errors(naive_forecast(s, d), "value", "p"), 8),
    "t08_tagged_series": t08,
}

ORACLES = {
    **{
        f"t01_aggregate_{_LEVELS[level]}_{how}": f"SELECT date_trunc('{_LEVELS[level]}', ts)::TIMESTAMP AS ts, {r(_SQL_AGGREGATES[how], 'value', 8)} FROM events GROUP BY 1"
        for level, how in _AGGREGATIONS
    },
    "t01_aggregate_by_type": f"SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS ts, {r('avg(value)', 'value', 8)} FROM events GROUP BY 1, 2",
    "t02_series_split": _split("ts, value", "events", "ts, event_id"),
    "t03_temporal_split": _split("event_id, ts, value", "events", "ts, event_id"),
    "t03_temporal_split_ties": _split("o_orderkey, o_orderdate", "orders", "o_orderdate, o_orderkey"),
    "t04_decomposition_week": _decomposition(DAILY, 7),
    "t04_decomposition_day": _decomposition(HOURLY, 24, 6),
    "t05_deviation_band": f"SELECT ts, {r('value', 'value', 8)}, {r('value - w', 'bottom', 8)}, {r('value + w', 'top', 8)} FROM {DAILY}, (SELECT round(stddev_pop(value), 3) AS w FROM {DAILY})",
    "t06_long_series": union([f"SELECT ts, '{v}' AS variable, {r(v, 'value', 8)} FROM {DAILY}" for v in ("value", "users")]),
    "t07_forecast_errors": f"""SELECT split, {r('sqrt(avg(pow(value - p, 2)))', 'rmse', 8)}, {r('avg(abs(value - p))', 'mae', 8)},
 {r('avg(abs(value - p) / greatest(abs(value), 2.220446049250313e-16))', 'mape', 8)}, {r('1 - sum(pow(value - p, 2)) / (var_pop(value) * count(*))', 'r2', 8)} FROM {FORECAST} GROUP BY split""",
    "t08_tagged_series": f"WITH f AS {FORECAST} SELECT ts, {r('value', 'value', 8)}, split AS part FROM f UNION ALL SELECT ts, {r('p', 'value', 8)}, 'prediction' FROM f WHERE split = 'test'",
}
