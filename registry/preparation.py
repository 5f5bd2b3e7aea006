"""Queries of sources, samples, splits, missing values, encodings and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.common import r, rounded, new_folder, table, union
from registry.profiling import CORRELATED, CORRELATED_NAMES, ORDERS_WITH_GAPS, correlated_lines, orders_with_gaps
from tabulens.operators import encoding, feature_selection as fs, missing as mv, sampling
from tabulens.plans.prepare import prepare_dataset
from tabulens.sources import tables as src


def hash_order(key: str) -> str:
    return f"md5(concat({key}, '|42')), {key}"


def split_sql(source: str, key: str, by: str, keep: str) -> str:
    """Train and test rows by class quotas (largest remainder) in hash order."""
    return f"""WITH source AS {source},
 sizes AS (SELECT {by} AS c, count(*) AS n FROM source GROUP BY 1),
 total AS (SELECT sum(n)::BIGINT AS n, ceil(round(0.3 * sum(n), 6))::BIGINT AS t FROM sizes),
 floors AS (SELECT c, s.n * t.t // t.n AS q, s.n * t.t % t.n AS rest, t.t FROM sizes s, total t),
 quotas AS (SELECT c, q + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= t - sum(q) OVER () THEN 1 ELSE 0 END AS q FROM floors),
 placed AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {hash_order(key)}) AS rn FROM source)
SELECT {keep}, CASE WHEN rn <= q THEN 'test' ELSE 'train' END AS part FROM placed JOIN quotas ON c = {by}"""


# --- sources ---------------------------------------------------------------------------------------------------


def s01(spark: SparkSession, folder: str) -> DataFrame:
    """CSV written by Spark and read with header and inferred types."""
    path = new_folder(spark) + ".csv"
    src.write_table(table(spark, folder, "customer"), path, "csv")
    return src.read_csv(spark, path)


def s02(spark: SparkSession, folder: str) -> DataFrame:
    """CSV with several missing-value tokens."""
    path = new_folder(spark) + ".csv"
    o = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "N/A").when(F.col("o_orderstatus") == "P", "null").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") < 50000, "nan").when(F.col("o_totalprice") < 90000, "#N/A").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
    )
    src.write_table(o, path, "csv")
    return src.read_csv(spark, path)


def s03(spark: SparkSession, folder: str) -> DataFrame:
    """Train and test files written and opened again: the sorted labels of the train file with sizes."""
    path = new_folder(spark)
    train, test = sampling.stratified_split(table(spark, folder, "orders"), "o_orderkey", "o_orderpriority")
    src.write_table(train, f"{path}_train")
    src.write_table(test, f"{path}_test")
    train, test, labels, features = src.read_train_test(spark, f"{path}_train", f"{path}_test", "o_orderpriority")
    sizes = [df.groupBy("o_orderpriority").agg(F.count("*").alias(n)) for df, n in ((train, "n_train"), (test, "n_test"))]
    joined = labels.join(sizes[0], "o_orderpriority").join(sizes[1], "o_orderpriority")
    return joined.withColumn("features", F.lit(len(features)).cast("bigint"))


def s05(spark: SparkSession, folder: str) -> DataFrame:
    """A result table written as one CSV file and read back."""
    from tabulens.operators.distribution import class_distribution

    path = new_folder(spark) + ".csv"
    src.write_result(rounded(class_distribution(table(spark, folder, "orders"), "o_orderstatus")), path)
    return src.read_csv(spark, path)


def s06(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue of three entries of which one has no file."""
    entries = [("orders", f"{folder}/orders.parquet", "o_orderstatus"), ("absent", f"{folder}/absent.parquet", "y"), ("part", f"{folder}/part.parquet", "p_type")]
    opened, skipped = src.open_catalogue(spark, entries)
    result = None
    for name, df, target in opened:
        row = df.agg(F.count("*").alias("records"), F.count_distinct(target).alias("classes")).select(F.lit(name).alias("dataset"), F.lit("open").alias("status"), "records", "classes")
        result = row if result is None else result.unionAll(row)
    rest = spark.createDataFrame(
        [(n, "skipped", None, None) for n in skipped], "dataset string, status string, records bigint, classes bigint"
    )
    return result.unionByName(rest)


# --- samples and splits ------------------------------------------------------------------------------------------


def p07(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    train, test = sampling.stratified_split(o, "o_orderkey", "o_orderstatus")
    train, test = sampling.cap_sample(train, test, "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


P07 = f"""WITH split AS ({split_sql('(SELECT o_orderkey, o_orderstatus FROM orders)', 'o_orderkey', 'o_orderstatus', 'o_orderkey, o_orderstatus')}),
 sized AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY {hash_order('o_orderkey')}) AS rn FROM split)
SELECT o_orderkey, o_orderstatus, part FROM sized WHERE part = 'test' OR rn <= 1000"""

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY_SQL = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def e13(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare_dataset(orders_with_gaps(spark, folder), "o_orderkey", "o_orderstatus", fraction=0.5, excluded=["o_custkey", "absent"])
    return prepared.marked


E13 = split_sql(
    f"(SELECT * FROM (SELECT * FROM {ORDERS_WITH_GAPS} ORDER BY {hash_order('o_orderkey')} LIMIT (SELECT round(0.5 * count(*))::BIGINT FROM orders)) "
    "WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL)",
    "o_orderkey", "o_orderstatus", "o_orderkey, o_totalprice, o_orderstatus",
)


def e13_summary(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare_dataset(orders_with_gaps(spark, folder), "o_orderkey", "o_orderstatus")
    return prepared.raw_summary.select(F.lit("raw").alias("state"), "*").unionByName(
        prepared.clean_summary.select(F.lit("clean").alias("state"), "*")
    )


def _summary_sql(state: str, source: str, counts: tuple[int, ...], gaps: str) -> list[str]:
    names = ("Variables", "Numerical", "Boolean", "Categorical", "Datetime")
    return (
        [f"SELECT '{state}' AS state, 'Records' AS metric, count(*)::BIGINT AS value FROM {source}"]
        + [f"SELECT '{state}' AS state, '{m}' AS metric, {v}::BIGINT AS value" for m, v in zip(names, counts)]
        + [f"SELECT '{state}' AS state, 'Nan Instances' AS metric, count_if({gaps})::BIGINT AS value FROM {source}"]
    )


# --- missing values, encodings -----------------------------------------------------------------------------------


def lines_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        *LINE_KEY,
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_discount") > 0.095, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_quantity") > 48, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_tax") > 0.01, F.col("l_linestatus")).alias("l_linestatus"),
        F.when(F.col("l_quantity") < 40, F.col("l_shipdate")).alias("l_shipdate"),
    )


LINES_WITH_GAPS = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax, CASE WHEN l_discount > 0.095 THEN l_discount END AS l_discount,
  CASE WHEN l_quantity > 48 THEN l_quantity END AS l_quantity, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS l_returnflag,
  CASE WHEN l_tax > 0.01 THEN l_linestatus END AS l_linestatus, CASE WHEN l_quantity < 40 THEN l_shipdate END AS l_shipdate FROM lineitem)"""

# l_discount is kept above 9.5 % only (about one row in eleven), l_quantity in one of twenty-five.
E03 = f"""WITH source AS {LINES_WITH_GAPS}, sizes AS (SELECT count(*) AS n, count(l_discount) AS d, count(l_quantity) AS q FROM source)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax, l_returnflag, l_linestatus FROM source, sizes
WHERE d < 0.1 * n AND q < 0.1 * n AND 4 + (l_tax IS NOT NULL)::INT + (l_returnflag IS NOT NULL)::INT + (l_linestatus IS NOT NULL)::INT + (l_shipdate IS NOT NULL)::INT >= 7"""

_MODE = "(SELECT first({c} ORDER BY n DESC, {c}) FROM (SELECT {c}, count(*) AS n FROM source WHERE {c} IS NOT NULL GROUP BY {c}))"


def e04(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(mv.fill_missing(lines_with_gaps(spark, folder), "frequent", LINE_KEY).drop("l_shipdate"))


E04 = f"""WITH source AS {LINES_WITH_GAPS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 {', '.join(r(f'coalesce({c}, (SELECT avg({c}) FROM source))', c) for c in ('l_tax', 'l_discount'))},
 round(coalesce(l_quantity, {_MODE.format(c='l_quantity')}), 6) + 0.0 AS l_quantity,
 {', '.join(f"coalesce({c}, {_MODE.format(c=c)}) AS {c}" for c in ('l_returnflag', 'l_linestatus'))} FROM source"""

E05 = f"""WITH source AS {LINES_WITH_GAPS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(l_tax, -1) AS l_tax,
 coalesce(l_discount, -1) AS l_discount, coalesce(l_quantity, 0) AS l_quantity, coalesce(l_returnflag, 'false') AS l_returnflag,
 coalesce(l_linestatus, 'false') AS l_linestatus FROM source"""


def parts_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select(
        "p_partkey",
        F.when(F.col("p_brand") != "Brand#1", F.col("p_size")).cast("double").alias("p_size"),
        F.when(~F.col("p_name").startswith("red"), F.col("p_retailprice")).alias("p_retailprice"),
        F.when(F.col("p_type") != "PROMO", F.length("p_name")).cast("double").alias("name_length"),
    )


def e06(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(mv.fill_missing(parts_with_gaps(spark, folder), "knn", "p_partkey"))


def _e06() -> str:
    names = ["p_size", "p_retailprice", "name_length"]
    known = " + ".join(f"(q.{c} IS NOT NULL AND d.{c} IS NOT NULL)::INT" for c in names)
    total = " + ".join(f"coalesce(pow(q.{c} - d.{c}, 2), 0)" for c in names)
    parts = []
    for c in names:
        parts.append(f"""SELECT p_partkey, '{c}' AS c, avg(v) AS v FROM (
 SELECT q.p_partkey, d.{c} AS v, row_number() OVER (PARTITION BY q.p_partkey ORDER BY round(sqrt(({total}) * 3.0 / ({known})), 9), d.p_partkey) AS rn
 FROM source q JOIN source d ON q.{c} IS NULL AND d.{c} IS NOT NULL AND ({known}) > 0) WHERE rn <= 5 GROUP BY p_partkey""")
    filled = ", ".join(
        r(f"coalesce(s.{c}, (SELECT v FROM near n WHERE n.p_partkey = s.p_partkey AND n.c = '{c}'), (SELECT avg({c}) FROM source))", c) for c in names
    )
    return f"""WITH source AS (SELECT p_partkey, CASE WHEN p_brand <> 'Brand#1' THEN p_size::DOUBLE END AS p_size,
 CASE WHEN NOT starts_with(p_name, 'red') THEN p_retailprice END AS p_retailprice,
 CASE WHEN p_type <> 'PROMO' THEN length(p_name)::DOUBLE END AS name_length FROM part),
near AS ({union(parts)}) SELECT s.p_partkey, {filled} FROM source s"""


def e01(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("event_id", F.hour("ts").alias("h"), F.dayofmonth("ts").alias("dom"))
    return encoding.encode_cyclic(e, ["h", "dom"])


def _cyclic(x: str, name: str) -> str:
    angle = f"2 * pi() * {x} / (SELECT max({x}) FROM source)"
    return f"{r(f'round(sin({angle}), 3)', name + '_sin', 3)}, {r(f'round(cos({angle}), 3)', name + '_cos', 3)}"


def e02(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("state"))
    return encoding.one_hot(c, ["c_mktsegment", "state"])


# --- feature selection -------------------------------------------------------------------------------------------


def e07(spark: SparkSession, folder: str) -> DataFrame:
    df = correlated_lines(spark, folder).withColumn("is_returned", F.col("is_returned").cast("int"))
    return fs.variable_list(df, fs.low_variance_variables(df, 0.5, target="l_tax"))


def e08(spark: SparkSession, folder: str) -> DataFrame:
    df = correlated_lines(spark, folder)
    return fs.variable_list(df, fs.redundant_variables(df, 0.9, target="l_tax"))


def _e08() -> str:
    names = [c for c in CORRELATED_NAMES if c not in ("l_tax", "constant")]
    pairs = union([
        f"SELECT '{a}' AS v1, '{b}' AS v2, abs(corr({a}::DOUBLE, {b}::DOUBLE)) AS r FROM source" for a in names for b in names if a != b
    ])
    return f"""WITH source AS {CORRELATED}, pairs AS ({pairs}),
 strong AS (SELECT *, count(*) OVER (PARTITION BY v1) AS partners FROM pairs WHERE r >= 0.9)
SELECT DISTINCT v2 AS variable FROM strong WHERE partners > 1"""


def lines_to_select(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *LINE_KEY, "l_linestatus", "l_quantity", "l_extendedprice", (F.col("l_extendedprice") * 1.1).alias("price_tax"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("price_plus"),
    )


def e11(spark: SparkSession, folder: str) -> DataFrame:
    """Redundant variables of the train table dropped from both tables, written and read back."""
    path = new_folder(spark)
    train, test = sampling.stratified_split(lines_to_select(spark, folder), LINE_KEY, "l_linestatus")
    dropped = fs.redundant_variables(train.drop(*LINE_KEY), 0.9, target="l_linestatus")
    fs.apply_selection(train, test, dropped, path, "kept")
    back = [spark.read.parquet(f"{path}_{p}_kept").withColumn("part", F.lit(p)) for p in ("train", "test")]
    return back[0].unionByName(back[1])


QUERIES = {
    "s01_csv_inferred": s01,
    "s02_csv_missing_tokens": s02,
    "s03_train_test_files": s03,
    "s05_result_table_file": s05,
    "s06_catalogue": s06,
    "p06_exact_sample": lambda s, d: sampling.sample_fraction(table(s, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 0.1),
    "p06_bernoulli_sample": lambda s, d: sampling.sample_fraction(table(s, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 0.1, exact=False),
    "p07_cap_sample": p07,
    "e01_cyclic_encoding": e01,
    "e02_one_hot": e02,
    "e02_one_hot_long": lambda s, d: encoding.one_hot_long(
        table(s, d, "lineitem").withColumn("part", F.when(F.col("l_linenumber") > 1, F.col("l_partkey"))), ["l_orderkey", "l_linenumber"], "part"
    ),
    "e03_drop_sparse": lambda s, d: mv.drop_sparse(lines_with_gaps(s, d), 0.1, 0.7).drop("l_shipdate"),
    "e04_fill_frequent": e04,
    "e05_fill_constant": lambda s, d: mv.fill_missing(lines_with_gaps(s, d), "constant", LINE_KEY, drop_dates=True),
    "e06_fill_knn": e06,
    "e07_low_variance": e07,
    "e08_redundant": e08,
    "e11_apply_selection": e11,
    "e12_stratified_split": lambda s, d: sampling.mark_split(table(s, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus"),
    "e12_stratified_split_lineitem": lambda s, d: sampling.mark_split(table(s, d, "lineitem").select(*LINE_KEY, "l_returnflag"), LINE_KEY, "l_returnflag"),
    "e13_prepare_dataset": e13,
    "e13_prepare_summaries": e13_summary,
}

ORACLES = {
    "s01_csv_inferred": "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "s02_csv_missing_tokens": """SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN o_orderstatus END AS o_orderstatus,
CASE WHEN o_totalprice >= 90000 THEN o_totalprice END AS o_totalprice FROM orders""",
    "s03_train_test_files": f"""SELECT o_orderpriority, count_if(part = 'train') AS n_train, count_if(part = 'test') AS n_test, 5::BIGINT AS features
FROM ({split_sql('(SELECT * FROM orders)', 'o_orderkey', 'o_orderpriority', 'o_orderpriority')}) GROUP BY 1""",
    "s05_result_table_file": f"SELECT o_orderstatus AS class, count(*) AS n, {r('count(*) / (SELECT count(*) FROM orders)', 'share')} FROM orders GROUP BY 1",
    "s06_catalogue": """SELECT 'orders' AS dataset, 'open' AS status, count(*) AS records, count(DISTINCT o_orderstatus) AS classes FROM orders
UNION ALL SELECT 'part', 'open', count(*), count(DISTINCT p_type) FROM part UNION ALL SELECT 'absent', 'skipped', NULL, NULL""",
    "p06_exact_sample": f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {hash_order('o_orderkey')} LIMIT (SELECT round(0.1 * count(*))::BIGINT FROM orders)",
    "p06_bernoulli_sample": "SELECT o_orderkey, o_custkey FROM orders WHERE ('0x' || substr(md5(concat(o_orderkey, '|42')), 1, 15))::BIGINT < (0.1 * pow(16::DOUBLE, 15))::BIGINT",
    "p07_cap_sample": P07,
    "e01_cyclic_encoding": f"WITH source AS (SELECT event_id, hour(ts)::INT AS h, day(ts)::INT AS dom FROM events) SELECT event_id, h, dom, {_cyclic('h', 'h')}, {_cyclic('dom', 'dom')} FROM source",
    "e02_one_hot": "SELECT c_custkey, " + ", ".join(
        f"c_mktsegment = '{v}' AS \"c_mktsegment_{v}\"" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    ) + ", c_acctbal < 0 AS state_debt FROM customer",
    "e02_one_hot_long": """WITH source AS (SELECT *, CASE WHEN l_linenumber > 1 THEN l_partkey END AS part FROM lineitem),
places AS (SELECT part, row_number() OVER (ORDER BY part NULLS LAST) - 1 AS position FROM (SELECT DISTINCT part FROM source))
SELECT l_orderkey, l_linenumber, position FROM source JOIN places ON source.part IS NOT DISTINCT FROM places.part""",
    "e03_drop_sparse": E03,
    "e04_fill_frequent": E04,
    "e05_fill_constant": E05,
    "e06_fill_knn": _e06(),
    "e07_low_variance": f"WITH source AS {CORRELATED} " + union(
        [f"SELECT '{c}' AS variable FROM source HAVING var_samp({c}::DOUBLE) < 0.5" for c in CORRELATED_NAMES if c != "l_tax"]
    ),
    "e08_redundant": _e08(),
    "e11_apply_selection": split_sql("(SELECT *, " + LINE_KEY_SQL + " AS k FROM lineitem)", "k", "l_linestatus", "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_quantity"),
    "e12_stratified_split": split_sql("(SELECT o_orderkey, o_orderstatus FROM orders)", "o_orderkey", "o_orderstatus", "o_orderkey, o_orderstatus"),
    "e12_stratified_split_lineitem": split_sql(
        "(SELECT *, " + LINE_KEY_SQL + " AS k FROM lineitem)", "k", "l_returnflag", "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag"
    ),
    "e13_prepare_dataset": E13,
    "e13_prepare_summaries": union(
        _summary_sql("raw", ORDERS_WITH_GAPS, (7, 3, 1, 2, 1), "o_totalprice IS NULL OR o_orderpriority IS NULL")
        + _summary_sql("clean", f"(SELECT * FROM {ORDERS_WITH_GAPS} WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL)", (3, 2, 0, 1, 0), "o_totalprice IS NULL")
    ),
}
