"""Exact order statistics, hash order and running totals, with limits small enough to force their rounds."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulens.functions import hash_order
from tabulens.functions.hash_order import share_quotas
from tabulens.functions.order_statistics import exact_quantiles, kth_row, not_after
from tabulens.functions.running import running_totals
from tabulens.operators import sampling


def skewed(spark, n=4000):
    """A third of the rows hold one value."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 1009).cast("double") / 10).alias("v"),
        (F.col("id") * F.col("id") % 977 - 400).cast("double").alias("w"),
    )


@pytest.mark.parametrize("limit", [5, 50, 100_000])
def test_exact_quantiles_equal_numpy(spark, limit):
    df = skewed(spark)
    columns = {"v": F.col("v"), "w": F.col("w")}
    found = exact_quantiles(df, columns, {"v": 4000, "w": 4000}, [0.0, 0.25, 0.3333, 0.5, 0.75, 1.0], limit)
    local = df.toPandas()
    for c in ("v", "w"):
        assert np.allclose(found[c], np.quantile(local[c], [0.0, 0.25, 0.3333, 0.5, 0.75, 1.0]))


def test_quantiles_of_an_empty_and_a_constant_column(spark):
    df = spark.createDataFrame([(None, 3.0)] * 5, "a double, b double")
    found = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, {"a": 0, "b": 5}, fetch_limit=2)
    assert found == {"a": [None] * 3, "b": [3.0] * 3}


@pytest.mark.parametrize("limit", [10, 100_000])
def test_kth_row_breaks_ties_by_key(spark, limit):
    df = skewed(spark)
    order = [F.col("v"), F.col("id")]
    local = sorted((r["v"], r["id"]) for r in df.collect())
    for k in (1, 999, 1500, 4000):
        cut = kth_row(df, order, k, limit)
        assert cut == local[k - 1]
        assert df.filter(not_after(order, cut)).count() == k
    assert kth_row(df, order, 0) is None


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_ranges(spark, descending):
    df = skewed(spark).groupBy("w").agg(F.count("*").alias("n"))
    rows = running_totals(df, "w", {"upto": "n"}, descending, range_rows=20).collect()
    total = 0
    for r in sorted(rows, key=lambda r: r["w"], reverse=descending):
        total += r["n"]
        assert r["upto"] == total
    assert total == 4000


def test_share_quotas_add_up():
    quotas = share_quotas({"a": 7, "b": 2, "c": 1}, 3)
    assert sum(quotas.values()) == 3 and quotas["a"] == 2


@pytest.mark.parametrize("parts", [1, 7])
def test_split_is_exact_and_independent_of_partitioning(spark, parts):
    df = spark.range(1001).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("y"))
    marked = sampling.mark_split(df.repartition(parts), "k", "y")
    again = {r["k"]: r["part"] for r in sampling.mark_split(df, "k", "y").collect()}
    rows = marked.collect()
    assert {r["k"]: r["part"] for r in rows} == again
    test = [r for r in rows if r["part"] == "test"]
    assert len(test) == math.ceil(0.3 * 1001)
    assert sum(r["y"] == "rare" for r in test) == 30 or sum(r["y"] == "rare" for r in test) == 31


def test_split_without_strata_when_a_class_has_one_row(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(10)], "k int, y string")
    marked = sampling.mark_split(df, "k", "y")
    assert marked.filter("part = 'test'").count() == 3


def test_split_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, y string")
    assert sampling.mark_split(df, "k", "y").count() == 0


def test_samples(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    some = sampling.sample_fraction(df, "k", 0.1)
    assert some.count() == 500 and some.distinct().count() == 500
    assert sampling.sample_rows(df, "k", 9000).count() == 5000
    assert sampling.sample_rows(df, "k", 0).count() == 0
    assert 350 < sampling.sample_fraction(df, "k", 0.1, exact=False).count() < 650
    a, b = sampling.cap_sample(df, df, "k", fit_rows=40)
    assert (a.count(), b.count()) == (40, 5000)
    a, b = sampling.cap_sample(df, df, "k", fit_rows=9000)
    assert (a.count(), b.count()) == (5000, 5000)


def test_composite_keys(spark):
    df = spark.range(300).select((F.col("id") % 20).alias("a"), F.floor(F.col("id") / 20).alias("b"))
    assert sampling.sample_rows(df, ["a", "b"], 77).count() == 77


def test_temporal_split_with_ties(spark):
    df = spark.createDataFrame([(i, f"2024-01-0{1 + i // 8}") for i in range(20)], "k int, d string").select("k", F.to_timestamp("d").alias("ts"))
    train, test = sampling.temporal_split(df, "ts", "k", 0.55)
    assert sorted(r["k"] for r in train.collect()) == list(range(11))
    assert test.count() == 9


def test_repeated_keys_end_with_an_error(spark):
    import pytest

    from tabulens.operators import sampling

    for keys in ([1] * 100, [i % 10 for i in range(100)], [None] * 100):
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        with pytest.raises(ValueError):
            sampling.sample_rows(df, "k", 15).count()


@pytest.mark.parametrize("limit", [10, 100_000])
def test_temporal_split_by_text_keys(spark, monkeypatch, limit):
    """All rows have one time; the keys share long beginnings and differ in length."""
    from tabulens.functions import order_statistics

    monkeypatch.setattr(order_statistics, "FETCH_LIMIT", limit)
    keys = sorted({f"key-{i % 7}-{'é' * (i % 3)}{i}" for i in range(300)} | {"", "k", "key"}, key=str.encode)
    df = spark.createDataFrame([(k, 5) for k in keys[::-1]], "k string, t int").select("k", F.timestamp_seconds("t").alias("t"))
    train, test = sampling.temporal_split(df, "t", "k", 0.6)
    n = int(len(keys) * 0.6)
    assert sorted((r["k"] for r in train.collect()), key=str.encode) == keys[:n] and test.count() == len(keys) - n


def test_a_sample_of_what_a_split_left_orders_few_rows(spark):
    df = spark.range(3_000).withColumn("y", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    train, _ = sampling.stratified_split(df, "id", "y")
    hashes = sorted((hashlib.md5(f"{r['id']}|42".encode()).hexdigest(), str(r["id"]), r["y"]) for r in train.collect())
    wanted = {c: [h for h in hashes if h[2] == c] for c in "ab"}
    slim = train.select(F.col("y").alias("c"), F.md5(F.concat(F.col("id").cast("string"), F.lit("|42"))).alias("h"), F.col("id").cast("string").alias("k"))
    for band in (1, 20, 5_000):
        found = hash_order._cutoffs_by_digits(slim, {"a": 100, "b": 7}, band)
        assert found == {"a": wanted["a"][99][:2], "b": wanted["b"][6][:2]}
    assert {str(r["id"]) for r in sampling.sample_rows(train, "id", 50).collect()} == {h[1] for h in hashes[:50]}
