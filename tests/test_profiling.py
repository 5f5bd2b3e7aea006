"""Profiling operators on small tables with values worked out by hand."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulens.functions import date_shapes
from tabulens.operators import dimensionality as dim, distribution as dist, granularity as gran, sparsity as spar
from tabulens.plans import profile


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_missing_counts_null_nan_and_unknown(spark):
    df = spark.createDataFrame([("Unknown", 1.0, 1), ("UNKNOWN", float("nan"), 2), (None, None, 3), ("known", 2.0, 4)], "s string, v double, k int")
    assert rows(dim.missing_per_variable(df)) == [("s", 3), ("v", 2)]


def test_semantic_types(spark):
    df = spark.createDataFrame(
        [("1", "a", "2024-01-01", "2024-01-01", None, True, "7", " ", 5.0), ("2e3", "b", "2024-02-01", "01/02/2024", None, True, "7", "1", 5.0),
         (" 3.5 ", "a", "2024-03-01", "2024-03-01", None, True, "7", "2", 5.0)],
        "num string, two string, day string, mixed string, none string, flag boolean, same string, blank string, const double",
    )
    assert dim.semantic_types(df) == {
        "num": "numeric", "two": "binary", "day": "date", "mixed": "symbolic", "none": "numeric", "flag": "numeric",
        "same": "numeric", "blank": "symbolic", "const": "numeric",
    }


def test_type_counts_show_all_types(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a int, b string")
    assert rows(dim.type_counts(df, dim.semantic_types(df))) == [("binary", 0), ("date", 0), ("numeric", 1), ("symbolic", 1)]


def test_two_values_is_exact(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (2, None), (1, 3.0), (2, 2.0)], "a int, b double")
    assert dim.has_two_values(df, ["a", "b"]) == {"a": True, "b": False}


def test_storage_and_name_types(spark):
    df = spark.range(60).select(
        F.col("id"), (F.col("id") % 2 == 0).alias("flag"), F.timestamp_seconds(F.col("id") * 86400).alias("long_date"),
        F.lit("x").alias("DepTimeBlk"), F.concat(F.lit("s"), F.col("id") % 2).alias("pair"),
    )
    assert dim.storage_types(df) == {"id": "numeric", "flag": "numeric", "DepTimeBlk": "symbolic", "pair": "binary"}
    assert dim.storage_types(df, skip_long_dates=False)["long_date"] == "symbolic"
    assert dim.name_types(df) == {"long_date": "date", "DepTimeBlk": "date", "pair": "symbolic"}


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "a int, b string")
    assert rows(dim.distinct_counts(df)) == [("a", 2), ("b", 0)]


def test_describe_with_ties_and_empty_columns(spark):
    df = spark.createDataFrame([("b", 1.0, None, True), ("a", 2.0, None, True), (None, 4.0, None, False)], "s string, v double, e double, f boolean")
    found = {r["variable"]: r for r in dist.describe_all(df).collect()}
    assert found["s"]["top"] == "a" and found["s"]["freq"] == 1 and found["s"]["n"] == 2 and found["s"]["unique"] == 2
    assert found["f"]["top"] == "true" and found["f"]["freq"] == 2
    assert found["e"]["n"] == 0 and found["e"]["mean"] is None
    assert found["v"]["q25"] == 1.5 and found["v"]["q50"] == 2.0 and math.isclose(found["v"]["std"], np.std([1, 2, 4], ddof=1))


def test_outliers_are_strict(spark):
    # Quartiles 2 and 4: fences at -1 and 7 exactly.
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (7.0,)], "v double")
    assert rows(dist.outlier_counts(df, ["v"])) == [("v", 0, 0)]
    df = df.unionAll(spark.createDataFrame([(50.0,)], "v double"))
    assert dist.outlier_counts(df, ["v"]).first()["n_iqr"] == 1


def test_histogram_sums_to_the_rows(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id") % 97).cast("double").alias("v"), F.lit(3.0).alias("c"))
    found = dist.histogram(df, ["v", "c"]).collect()
    assert sum(r["n"] for r in found if r["variable"] == "v") == 1000
    assert [(r["lo"], r["hi"], r["n"]) for r in found if r["variable"] == "c"] == [(2.5, 3.5, 1000)]
    local = df.toPandas()["v"].to_numpy()
    k = sum(r["variable"] == "v" for r in found)
    counts, _ = np.histogram(local, bins=k)
    assert counts.tolist() == [r["n"] for r in sorted((r for r in found if r["variable"] == "v"), key=lambda r: r["bin"])]
    dense = dist.histogram(df, ["v"], density=True).collect()
    assert math.isclose(sum(r["density"] * (r["hi"] - r["lo"]) for r in dense), 1.0)


def test_fits_of_a_constant_have_no_exponential(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert dist.fit_distributions(df, "v") == []


def test_boxplot_whiskers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double")
    r = dist.boxplot_statistics(df).first()
    assert (r["whisker_lo"], r["whisker_hi"], r["n_fliers"]) == (1.0, 5.0, 1)
    assert dist.fliers(df, "v").first()["v"] == 100.0


def test_value_counts_orders(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "s string")
    assert [tuple(r) for r in dist.value_counts(df, "s").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert [tuple(r) for r in dist.value_counts(df, "s", "key", True).collect()] == [("a", 1), ("b", 1), ("c", 2), (None, 1)]


def test_correlation_handles_constants_and_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 1.0), (2.0, 4.1, 5.0, None), (3.0, 5.9, 5.0, 3.0), (4.0, 8.2, 5.0, 9.0)], "a double, b double, c double, d double")
    local = df.toPandas()
    pairs = spar.correlation_pairs(df, ["a", "b", "c", "d"])
    assert pairs[("a", "c")] is None and pairs[("c", "d")] is None
    for x, y in (("a", "b"), ("a", "d"), ("b", "d")):
        assert math.isclose(pairs[(x, y)], abs(local[x].corr(local[y])))
    matrix = {(r["v1"], r["v2"]): r["r"] for r in spar.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert matrix[("a", "b")] == matrix[("b", "a")] and matrix[("a", "a")] == 1.0 and matrix[("c", "c")] is None


def test_pair_density_counts_every_row_once_per_pair(spark):
    df = spark.range(500).select((F.col("id") % 17).alias("a"), (F.col("id") % 5).alias("b"), (F.col("id") * 3 % 11).alias("c"), (F.col("id") % 2).cast("string").alias("y"))
    density = spar.pair_density(df, ["a", "b", "c"])
    assert {r["s"] for r in density.groupBy("v1", "v2").agg(F.sum("n").alias("s")).collect()} == {500}
    by_class = spar.pair_density(df, ["a", "b", "c"], "y")
    assert by_class.agg(F.sum("n")).first()[0] == 1500
    assert len(spar.study_pairs([f"v{i}" for i in range(30)], 20)) == 190 + 45
    assert len(spar.study_pairs([f"v{i}" for i in range(30)])) == 435
    with pytest.raises(ValueError):
        spar.pair_density(df, ["a"])


def test_lenient_dates_and_levels(spark):
    df = spark.createDataFrame([("2024-05-06", 1), ("bad", 2), (None, 3)], "d string, k int")
    parsed = gran.date_variables_lenient(df, ["d"], "yyyy-MM-dd")
    assert "d_hour" not in parsed.columns
    assert rows(parsed.select("k", "d_year", "d_quarter", "d_month", "d_day")) == [(1, 2024, 2, 5, 6), (2, None, None, None, None), (3, None, None, None, None)]
    levels = gran.date_granularity(parsed, "d")
    assert rows(levels) == [("day", 6, 1), ("month", 5, 1), ("quarter", 2, 1), ("year", 2024, 1)]


def test_profiles(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.concat(F.lit("c"), F.col("id") % 3).alias("s"),
        (F.col("id") % 2 == 0).alias("flag"), F.timestamp_seconds(F.col("id") * 3600).alias("when_date"), F.concat(F.lit("y"), F.col("id") % 2).alias("y"),
    )
    assert profile.profile_dimensionality(df)["records"].first()["variables"] == 6
    found = profile.profile_distribution(df, "y")
    assert found["outliers"].count() == 3 and found["classes"].count() == 2 and found["describe"].count() == 5
    assert found["boxplots"].count() == 3
    assert set(profile.profile_granularity(df)) == {"when_date", "properties"}
    sparsity = profile.profile_sparsity(df, "y")
    assert sparsity["occupancy"].count() == 1 and sparsity["pairs_by_class"].count() > 0


def test_wide_tables_keep_all_pairs_and_constants_have_no_correlation(spark):
    df = spark.range(40).selectExpr("id % 2 AS y", "0.1D AS c", *[f"CAST((id * {i + 3}) % 17 AS DOUBLE) AS v{i}" for i in range(28)])
    pairs = spar.pair_density(df, ["c", *[f"v{i}" for i in range(28)]], "y").select("v1", "v2").distinct().count()
    assert pairs == 29 * 28 // 2
    assert spar.correlation_matrix(df, ["c", "v0"]).where("r is not null and v1 <> v2").count() == 0


@pytest.mark.parametrize("texts,fmt", [
    (["2024-01-05", "2023-12-31"], "yyyy-M-d"),
    (["2024-01-05T10:11:12.5Z", "2024-01-05T10:11:12Z"], "yyyy-M-d'T'H:mm:ss[.SSSSSSSSS]X"),
    (["2024-01-05 10:11:12.123", "2024-01-06 10:11:12.1"], "yyyy-M-d H:mm:ss.SSSSSSSSS"),
    (["2024/1/5 7:05", "2024/12/5 17:05"], "yyyy/M/d H:mm"),
    (["1/2/2024", "3/4/2024"], "M/d/yyyy"),  # both orders fit: the month comes first
    (["1/2/2024", "13/4/2024"], "d/M/yyyy"),
    (["05.06.2024", "25.06.2024"], "d.M.yyyy"),
    (["5 Jan 2024", "15 Dec 2024"], "d MMM yyyy"),
    (["January 5, 2024", "March 15, 2024"], "MMMM d, yyyy"),
    (["01/02/2024 05:06:07 PM", "01/02/2024 11:06:07 AM"], "M/d/yyyy h:mm:ss a"),
    (["2024-01-05T10:11:12+02:00"], "yyyy-M-d'T'H:mm:ssXXX"),
    (["2024-01-05", "05/01/2024"], None),
    (["2024-13-45"], None),
    (["2024-01/05"], None),
    (["a long text of many words", "x"], None),
    (["12", "1234", "123456", "1.2", "-"], None),
    ([None, None], None),
])
def test_date_formats(spark, texts, fmt):
    from tabulens.functions.date_shapes import infer_formats, to_dates

    df = spark.createDataFrame([(t,) for t in [*texts, None]], "`a.b` string").withColumnRenamed("a.b", "d")
    found = infer_formats(df, ["d"])
    assert found == ({"d": fmt} if fmt else {})
    if fmt:
        assert to_dates(df, found).where("d is not null").count() == len(texts)


def test_fractions_of_seconds_are_kept(spark):
    from tabulens.functions.date_shapes import infer_formats, to_dates

    df = spark.createDataFrame([("2024-01-05 10:11:12.5",), ("2024-01-05 10:11:12",)], "d string")
    assert sorted(r[0] for r in to_dates(df, infer_formats(df, ["d"])).selectExpr("unix_micros(d) % 1000000").collect()) == [0, 500000]


@pytest.mark.parametrize("block", [1_024, 8])
def test_wide_correlations_equal_those_of_each_pair(spark, monkeypatch, block):
    monkeypatch.setattr(spar, "_GRAM_COLUMNS", block)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 20)) * np.logspace(-3, 6, 20) + np.logspace(6, -3, 20)
    x[:, 3] = x[:, 2] * -2 + 1
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 0], x[:, 1] = 1 / 3, np.nan
    x[::2, 4], x[1::2, 4] = np.nan, np.where(np.arange(350) % 2, 5.0, 6.0)
    x[:, 5] = np.where(x[:, 4] == 5.0, 0.1, np.where(x[:, 4] == 6.0, np.nan, x[:, 5]))  # constant where both are there
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"v{i} double" for i in range(20)))
    found = spar.correlation_pairs(df, df.columns)
    assert list(found) == list(combinations(df.columns, 2))
    column = dict(zip(df.columns, x.T.astype(np.longdouble)))  # plain sums lose digits where the mean is far from zero
    for (a, b), r in found.items():
        if {a, b} & {"v0", "v1"} or (a, b) == ("v4", "v5"):
            assert r is None
        else:
            both = ~np.isnan(column[a]) & ~np.isnan(column[b])
            p, q = (column[c][both] - column[c][both].mean() for c in (a, b))
            assert r == pytest.approx(float(abs((p * q).sum()) / np.sqrt((p * p).sum() * (q * q).sum())), abs=1e-10)
    many = spar._wide_moments(df, df.columns)
    few = spar.moments(df, df.columns)
    assert {df.columns[m["i"]]: m["n"] for m in many} == few.count
    assert set(spar.correlation_pairs(df.limit(0), df.columns).values()) == {None}


def test_profile_holds_fits_of_all_numeric_variables(spark):
    df = spark.createDataFrame([(float(i % 90 + 1), float(i * i % 1_000 - 500), "a") for i in range(900)], "x double, y double, s string")
    result = profile.profile_distribution(df)
    families = {(r["variable"], r["family"]) for r in result["fits"].collect()}
    assert families == {(v, f) for v in "xy" for f in ("normal", "exponential", "lognormal")}
    grid = result["fitted_densities"].collect()
    assert {(r["variable"], r["family"]) for r in grid} == families and all(r["pdf"] >= 0 for r in grid)
    assert dist.density_grids(df.limit(0), ["x"]).count() == 0


def test_a_mask_keeps_the_shape_and_long_texts_keep_theirs(spark):
    rng = np.random.default_rng(5)
    texts = ["2024-01-31T12:00:59.125Z", "3 March 2024 11:59 PM", "11:59 pm", "T1T2", "f.f 1f2", "äf2é9", "Zf", "12:30:10,5+02:00", ""]
    texts += ["".join(rng.choice(list("0159 TZAaPpMmfbcé.,:+-/"), rng.integers(1, 30))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    row = df.select(date_shapes.shape(F.col("t")).alias("a"), date_shapes.shape(date_shapes.mask(F.col("t"))).alias("b"), date_shapes.mask(F.col("t")).alias("m")).collect()
    assert [r["a"] for r in row] == [r["b"] for r in row] and len({r["m"] for r in row}) < len(set(texts))
    padded = spark.createDataFrame([(" " * 40 + f"2024-{m:02}-11", f"{m} " * 30) for m in range(1, 13)], "d string, free string")
    assert date_shapes.infer_formats(padded, ["d", "free"]) == {"d": "yyyy-M-d"}
