"""Sources, missing values, encodings, feature selection, preparation."""

import math

from pyspark.sql import functions as F, types as T

from tabulens.operators import encoding, feature_selection as fs, missing as mv
from tabulens.operators.project import drop_incomplete_rows, drop_listed, keep_kinds, numeric_with_target
from tabulens.plans.prepare import prepare_dataset
from tabulens.sources import tables as src


def test_csv_tokens_and_types(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text("i,f,b,s,e\n1,1.5,True,x,\nNA,nan,False,N/A,\n3,2,True,unknown,\n")
    df = src.read_csv(spark, path)
    assert [f.dataType for f in df.schema.fields] == [T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType(), T.DoubleType()]
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, True, "x", None), (None, None, False, None, None), (3, 2.0, True, "unknown", None)]
    typed = src.read_csv(spark, path, T.StructType([T.StructField("i", T.DoubleType()), T.StructField("s", T.StringType())]))
    assert typed.columns == ["i", "s"] and typed.first()["i"] == 1.0


def test_catalogue_skips_missing_files(spark, tmp_path):
    src.write_table(spark.range(3), str(tmp_path / "t"))
    opened, skipped = src.open_catalogue(spark, [("a", str(tmp_path / "t"), "id"), ("b", str(tmp_path / "no"), "id")])
    assert [o[0] for o in opened] == ["a"] and skipped == ["b"]


def test_projections(spark):
    df = spark.createDataFrame([(1, True, "a", 2.0), (2, False, None, float("nan"))], "i int, f boolean, s string, v double")
    assert keep_kinds(df, "number").columns == ["i", "v"]
    assert numeric_with_target(df, "s").columns == ["i", "v", "s"]
    assert drop_listed(df, ["f", "zzz"]).columns == ["i", "s", "v"]
    assert drop_incomplete_rows(df).count() == 1


def test_drop_sparse_counts_against_the_original_width(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, None), (None, None, None)], "a int, b int, c double")
    assert mv.drop_sparse(df, 0.1).columns == ["a", "c"]
    assert mv.drop_sparse(df, 0.1, 0.5).count() == 1
    assert mv.drop_sparse(df, 0.1, 0.3).count() == 2


def test_fill_frequent_and_constant(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "b", "y", "2024-01-01"), (2, None, "a", None, None), (3, 4.0, None, "n", "2024-01-03"), (4, 7.0, "c", "n", "2024-01-04")],
        "k int, v double, s string, t string, d string",
    )
    filled = {r["k"]: r for r in mv.fill_missing(df, "frequent", "k").collect()}
    assert filled[2]["v"] == 4.0 and filled[3]["s"] == "a" and filled[2]["t"] == "n" and filled[2]["d"] is None
    constant = mv.fill_missing(df, "constant", "k", drop_dates=True)
    assert constant.columns == ["k", "v", "s", "t"]
    row = {r["k"]: r for r in constant.collect()}
    assert row[2]["v"] == -1.0 and row[3]["s"] == "NA" and row[2]["t"] == "false"


def test_cyclic_and_one_hot(spark):
    df = spark.createDataFrame([(0, "a", "u"), (6, "b", "w"), (24, None, "u")], "h int, c string, t string")
    rows = encoding.encode_cyclic(df, ["h"]).collect()
    assert [(r["h_sin"], r["h_cos"]) for r in rows] == [(0.0, 1.0), (1.0, 0.0), (0.0, 1.0)] or math.isclose(rows[2]["h_sin"], 0.0)
    hot = encoding.one_hot(df, ["c", "t"])
    assert hot.columns == ["h", "c_a", "c_b", "c_None", "t_w"]
    assert [r["c_None"] for r in hot.collect()] == [False, False, True]


def test_redundancy_rule(spark):
    df = spark.range(40).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") * 3.0 + 1).alias("c"),
        (F.col("id") * 17 % 23).cast("double").alias("p"), (F.col("id") * 17 % 23 * 2.0).alias("q"), F.lit(1.0).alias("class"),
    )
    assert fs.redundant_variables(df, 0.9) == ["b", "c", "a"]
    assert fs.redundant_variables(df, 0.9, rule="keep_first") == ["b", "c", "q"]


def test_low_variance_keeps_the_target(spark):
    df = spark.createDataFrame([(1.0, 1.0, 10.0), (1.1, 1.0, 20.0)], "a double, class double, b double")
    assert fs.low_variance_variables(df, 1.0) == ["a"]


def test_prepare_dataset(spark, tmp_path):
    df = spark.range(200).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("a"), F.lit(1).alias("leak"),
        F.lit("t").alias("text"), F.concat(F.lit("y"), F.col("id") % 2).alias("y"),
    )
    prepared = prepare_dataset(df, "k", "y", excluded=["leak"])
    clean = {r["metric"]: r["value"] for r in prepared.clean_summary.collect()}
    assert clean["Records"] == 180 and clean["Variables"] == 2 and clean["Nan Instances"] == 0
    assert prepared.train.count() == 126 and prepared.test.count() == 54
    assert prepared.train.join(prepared.test, "k").count() == 0
    prepared.save(str(tmp_path / "out"))
    train, test, labels, features = src.read_train_test(spark, str(tmp_path / "out_train"), str(tmp_path / "out_test"), "y")
    assert [r["y"] for r in labels.collect()] == ["y0", "y1"] and features == ["k", "a"] and test.count() == 54


def test_long_whole_numbers_keep_their_digits(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("id,huge,both\n9223372036854775807,12345678901234567890123,1\n-1000000000000000000,1,1.5\n")
    df = src.read_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "decimal(38,0)", "double"]
    assert sorted(int(r["id"]) for r in df.collect()) == [-(10**18), 2**63 - 1] and max(int(r["huge"]) for r in df.collect()) == 12345678901234567890123


def test_positions_of_many_categories_are_dense_and_ordered(spark):
    df = spark.range(9_000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 2_500)).alias("c"))
    places = {r["value"]: r["position"] for r in encoding.category_positions(df, "c").collect()}
    named = sorted(v for v in places if v is not None)
    assert len(named) > 2_000 and [places[v] for v in named] == list(range(len(named))) and places[None] == len(named)
    assert encoding.one_hot_long(df, ["k"], "c").count() == 9_000
    assert encoding.one_hot_long(df.limit(0), ["k"], "c").count() == 0
