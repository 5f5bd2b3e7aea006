"""Time-series operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulens.functions.running import grouped_medians
from tabulens.operators import timeseries as ts


def series(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    values = np.round(np.arange(n) * 0.5 + np.tile([3, -1, 2, -4], n)[:n] + rng.normal(size=n), 3)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double").select(
        F.timestamp_seconds(F.col("i") * 86400).alias("ts"), "v"
    ), values


@pytest.mark.parametrize("period", [4, 5])
@pytest.mark.parametrize("block", [6, 1000])
def test_decomposition(spark, period, block):
    df, v = series(spark, 24)
    rows = ts.decompose_additive(df, "ts", "v", period, block=block, range_rows=7).orderBy("ts").collect()
    assert len(rows) == 24
    reach = period // 2
    weights = np.full(2 * reach + 1, 1 / period)
    if period % 2 == 0:
        weights[[0, -1]] /= 2
    for i, r in enumerate(rows):
        inside = reach <= i < 24 - reach
        assert (r["trend"] is not None) == inside
        if inside:
            assert math.isclose(r["trend"], (v[i - reach : i + reach + 1] * weights).sum(), abs_tol=1e-9)
            assert math.isclose(r["trend"] + r["seasonal"] + r["residual"], r["observed"], abs_tol=1e-9)
    assert math.isclose(sum(r["seasonal"] for r in rows[:period]), 0.0, abs_tol=1e-9)


def test_aggregates(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00", 1.0), ("2024-01-07 10:00:00", 3.0), ("2024-01-08 00:00:00", 10.0)], "t string, v double").select(F.to_timestamp("t").alias("t"), "v")
    weeks = ts.aggregate_by(df, "t", ["v"], "W", "sum").orderBy("t").collect()
    assert [(str(r["t"])[:10], r["v"]) for r in weeks] == [("2024-01-01", 4.0), ("2024-01-08", 10.0)]
    assert ts.aggregate_by(df, "t", ["v"], "M", "last").first()["v"] == 10.0
    with pytest.raises(ValueError):
        ts.aggregate_by(df, "t", ["v"], "D", "drop")


def test_forecast_errors(spark):
    df = spark.createDataFrame([("train", 1.0, 1.0), ("train", 3.0, 2.0), ("test", 2.0, 2.5), ("test", 2.0, 1.0)], "split string, y double, p double")
    found = {r["split"]: r for r in ts.forecast_errors(df, "y", "p").collect()}
    assert math.isclose(found["train"]["rmse"], math.sqrt(0.5)) and math.isclose(found["train"]["r2"], 0.5)
    assert found["test"]["r2"] is None and math.isclose(found["test"]["mape"], 0.375)


def test_band_and_long_form(spark):
    df, v = series(spark, 8)
    width = round(float(np.std(v)), 3)
    r = ts.deviation_band(df, "ts", "v").orderBy("ts").first()
    assert math.isclose(r["top"] - r["v"], width, abs_tol=1e-9)
    assert ts.long_series(df.withColumn("w", F.col("v") * 2), "ts", ["v", "w"]).count() == 16


def test_row_positions(spark):
    df, _ = series(spark, 30)
    rows = ts.row_positions(df, "ts", range_rows=4).orderBy("ts").collect()
    assert [r["position"] for r in rows] == list(range(30))


def test_grouped_medians_with_a_hot_group_and_a_hot_value(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("g"),
        F.when(F.col("id") % 5 < 2, 4.0).when(F.col("id") % 50 == 3, None).otherwise((F.col("id") * 31 % 101).cast("double")).alias("v"),
    )
    found = {r["g"]: r["v"] for r in grouped_medians(df, ["g"], "v").collect()}
    assert found == df.toPandas().groupby("g")["v"].median().to_dict()


def test_medians_of_null_groups(spark):
    from datetime import datetime

    from tabulens.operators.timeseries import aggregate_by

    df = spark.createDataFrame([(datetime(2024, 1, 1), g, v) for g, v in ((None, 1.0), (None, 3.0), ("a", 5.0))], "t timestamp, g string, v double")
    got = {r["g"]: r["v"] for r in aggregate_by(df, "t", ["v"], "D", "median", ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_more_aggregates_and_tied_times(spark):
    rows = [("2024-01-01 00:00:00", 2, 3.0), ("2024-01-01 00:00:00", 1, 5.0), ("2024-01-01 06:00:00", 3, 4.0), ("2024-01-01 06:00:00", 4, 4.0)]
    df = spark.createDataFrame(rows, "t string, k int, v double").withColumn("t", F.col("t").cast("timestamp"))
    value = lambda how, **o: ts.aggregate_by(df, "t", ["v"], "D", how, **o).first()["v"]
    assert value("first", key=["k"]) == 5.0 and value("last", key=["k"]) == 4.0
    assert value("nunique") == 3 and value("prod") == 240.0
    assert abs(value("var") - 2 / 3) < 1e-12 and abs(value("sem") - (2 / 3) ** 0.5 / 2) < 1e-12
