"""Queries of the classifiers, their studies and the feature-selection studies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.common import r, rounded, table, union
from registry.preparation import LINE_KEY, LINE_KEY_SQL, split_sql
from tabulens import fixed_values as fixed
from tabulens.functions.blocks import Blocks, weighted_points
from tabulens.operators import logistic, neighbours as nn, sampling
from tabulens.operators.bayes import fit_bayes
from tabulens.operators.evaluation import best_configuration
from tabulens.plans import studies

# --- tables with a target that can be learnt -----------------------------------------------------------------

LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
PART_FEATURES = ["p_size", "p_retailprice"]
PART_WIDE = ["p_size", "p_retailprice", "size_share", "price_share", "price_twice", "price_plus"]


def line_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, folder, "lineitem").select(
        *LINE_KEY, *LINE_FEATURES, (F.col("l_quantity") * (1 - F.col("l_discount")) > 20).cast("int").alias("y")
    )
    return sampling.stratified_split(li, LINE_KEY, "y")


def part_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_retailprice",
        (F.col("p_size") / 50).alias("size_share"), (F.col("p_retailprice") / 1000).alias("price_share"),
        (F.col("p_retailprice") * 2).alias("price_twice"), (F.col("p_retailprice") + F.col("p_size") / 100).alias("price_plus"),
        (F.col("p_size") * 20 + F.col("p_retailprice") > 1500).cast("int").alias("y"),
    )
    return sampling.stratified_split(p, "p_partkey", "y")


PRICE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def price_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Four features, nearly every row a point of its own, and a label that they explain only in part."""
    li = table(spark, folder, "lineitem").select(*LINE_KEY, *PRICE_FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return sampling.stratified_split(li, LINE_KEY, "y")


def vector_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    e = table(spark, folder, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    train, test = sampling.stratified_split(wide, "vec_id", "label")
    return train, test, names


LINE_SPLIT = split_sql(
    f"(SELECT {LINE_KEY_SQL} AS k, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, (l_quantity * (1 - l_discount) > 20)::INT AS y FROM lineitem)",
    "k", "y", "k, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, y",
)
PRICE_SPLIT = split_sql(
    f"(SELECT {LINE_KEY_SQL} AS k, l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(PRICE_FEATURES)}, (l_returnflag = 'R')::INT AS y FROM lineitem)",
    "k", "y", f"k, l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(PRICE_FEATURES)}, y",
)
PART_SPLIT = split_sql(
    """(SELECT p_partkey, p_size, p_retailprice, p_size / 50.0::DOUBLE AS size_share, p_retailprice / 1000 AS price_share, p_retailprice * 2 AS price_twice,
 p_retailprice + p_size / 100.0::DOUBLE AS price_plus, (p_size * 20 + p_retailprice > 1500)::INT AS y FROM part)""",
    "p_partkey", "y", "p_partkey, p_size, p_retailprice, size_share, price_share, price_twice, price_plus, y",
)
VECTOR_SPLIT = split_sql("(SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings)", "vec_id", "label", "vec_id, v, label")


# --- Naive Bayes in SQL ------------------------------------------------------------------------------------------


def bayes_sql(variant: str, features: list[str], name: str) -> str:
    """CTEs that give `<name>(row, y, p)`; the source has the columns key, y, part and the features."""
    if variant == "gaussian":
        fit = ", ".join(f"avg({f}) AS a_{f}, var_pop({f}) + 1e-9 * (SELECT greatest({', '.join(f'var_pop({g})' for g in features)}) FROM train) AS b_{f}" for f in features)
        score = " + ".join(f"(-0.5 * ln(2 * pi() * b_{f}) - 0.5 * pow(t.{f} - a_{f}, 2) / b_{f})" for f in features)
    elif variant == "multinomial":
        mass = " + ".join(f"sum({f})" for f in features)
        fit = ", ".join(f"ln((sum({f}) + 1) / ({mass} + {len(features)})) AS a_{f}" for f in features)
        score = " + ".join(f"t.{f} * a_{f}" for f in features)
    else:
        fit = ", ".join(f"(count_if({f} > 0) + 1) / (count(*) + 2) AS a_{f}" for f in features)
        score = " + ".join(f"CASE WHEN t.{f} > 0 THEN ln(a_{f}) ELSE ln(1 - a_{f}) END" for f in features)
    return f"""{name}_fit AS (SELECT y AS c, ln(count(*) / (SELECT count(*) FROM train)) AS prior, {fit} FROM train GROUP BY y),
 {name} AS (SELECT t.*, (SELECT first(c ORDER BY prior + {score} DESC, c) FROM {name}_fit) AS p FROM test t)"""


def _split_ctes(split: str, features: list[str]) -> str:
    return f"split AS ({split}), train AS (SELECT * FROM split WHERE part = 'train'), test AS (SELECT * FROM split WHERE part = 'test')"


def _bayes_oracle(variant: str) -> str:
    return f"WITH {_split_ctes(LINE_SPLIT, LINE_FEATURES)}, {bayes_sql(variant, LINE_FEATURES, 'nb')} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p AS prediction FROM nb"


def _bayes_query(variant: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        train, test = line_split(spark, folder)
        return fit_bayes(train, LINE_FEATURES, "y", variant).predict(test).select(*LINE_KEY, "prediction")

    return query


def weighted_sql(source: str, by: str, average: str = "weighted") -> str:
    """(by, accuracy, precision, recall) of a relation with the columns by, y, p, n."""
    avg = {"weighted": "sum({0} * support) / sum(support)", "macro": "avg({0})"}[average]
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""SELECT {group}{r('sum(tp) / sum(support)', 'accuracy')}, {r(avg.format('prec'), 'precision')}, {r(avg.format('rec'), 'recall')} FROM (
 SELECT {group}label, sum(tp) AS tp, sum(support) AS support, CASE WHEN sum(predicted) > 0 THEN sum(tp) / sum(predicted) ELSE 0 END AS prec,
  CASE WHEN sum(support) > 0 THEN sum(tp) / sum(support) ELSE 0 END AS rec
 FROM (SELECT {group}y AS label, n AS support, 0 AS predicted, CASE WHEN y = p THEN n ELSE 0 END AS tp FROM {source}
       UNION ALL SELECT {group}p AS label, 0, n, 0 FROM {source}) GROUP BY {group}label){tail}"""


def binary_sql(source: str, by: str) -> str:
    return f"""SELECT {by}, (tp + tn) / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
 CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc,
 CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1
 FROM (SELECT {by}, count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 1) AS fp, count_if(y = 1 AND p = 0) AS fn, count_if(y = 0 AND p = 0) AS tn FROM {source} GROUP BY {by})"""


def c04(spark: SparkSession, folder: str) -> DataFrame:
    train, test = line_split(spark, folder)
    return rounded(studies.bayes_study(train, test, LINE_FEATURES, "y"))


C04 = f"WITH {_split_ctes(LINE_SPLIT, LINE_FEATURES)}, " + ", ".join(bayes_sql(v, LINE_FEATURES, v) for v in ("gaussian", "multinomial", "bernoulli")) + ", counts AS (" + union(
    [f"SELECT '{v}' AS variant, y, p, count(*) AS n FROM {v} GROUP BY y, p" for v in ("gaussian", "multinomial", "bernoulli")]
) + ") " + weighted_sql("counts", "variant")


# --- nearest neighbours in SQL -----------------------------------------------------------------------------------


def distance_sql(features: list[str], metric: str) -> str:
    gaps = [f"(q.{f} - t.{f})" for f in features]
    if metric == "manhattan":
        return "round(" + " + ".join(f"abs({g})" for g in gaps) + ", 9)"
    if metric == "chebyshev":
        return "round(greatest(" + ", ".join(f"abs({g})" for g in gaps) + ")::DOUBLE, 9)"
    return "round(sqrt(" + " + ".join(f"pow({g}, 2)" for g in gaps) + "), 9)"


def near_sql(distance: str, key: str, target: str, k: int, name: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT q.{key} AS {key}, q.{target} AS y, t.{target} AS label,
 row_number() OVER (PARTITION BY q.{key} ORDER BY {distance}, t.{key}) AS place FROM test q, train t) WHERE place <= {k})"""


def votes_sql(near: str, key: str, ks: list[int], name: str) -> str:
    return f"""{name} AS (SELECT k, {key}, any_value(y) AS y, first(label ORDER BY votes DESC, label) AS p FROM (
 SELECT k, {key}, any_value(y) AS y, label, count(*) AS votes FROM {near}, (SELECT unnest({ks}) AS k) WHERE place <= k GROUP BY k, {key}, label) GROUP BY k, {key})"""


def _knn_query(metric: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        train, test = part_split(spark, folder)
        return nn.knn_predict(train, test, PART_FEATURES, "y", "p_partkey", 5, metric).select("p_partkey", "prediction")

    return query


def _knn_oracle(metric: str) -> str:
    return f"""WITH {_split_ctes(PART_SPLIT, PART_FEATURES)}, {near_sql(distance_sql(PART_FEATURES, metric), 'p_partkey', 'y', 5, 'near')},
 {votes_sql('near', 'p_partkey', [5], 'votes')} SELECT p_partkey, p AS prediction FROM votes"""


def c05_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest train rows of every test row."""
    train, test = part_split(spark, folder)
    near = nn.nearest_rows(nn.build_index(train, PART_FEATURES, "p_partkey", 5), test, 5, "euclidean")
    named = test.select("p_partkey", nn.query_id(test, PART_FEATURES).alias("query"))
    return rounded(named.join(near, "query").select("p_partkey", "place", "train_key", "distance"))


def c05_vectors(spark: SparkSession, folder: str) -> DataFrame:
    train, test, names = vector_split(spark, folder)
    return nn.knn_predict(train, test, names, "label", "vec_id", 5, "euclidean").select("vec_id", "prediction")


VECTOR_DISTANCE = "round(list_distance(q.v, t.v), 9)"
C05_VECTORS = f"""WITH {_split_ctes(VECTOR_SPLIT, [])}, {near_sql(VECTOR_DISTANCE, 'vec_id', 'label', 5, 'near')},
 {votes_sql('near', 'vec_id', [5], 'votes')} SELECT vec_id, p AS prediction FROM votes"""


def c05_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All of lineitem."""
    train, test = line_split(spark, folder)
    index = nn.build_index(train, LINE_FEATURES, LINE_KEY, 5, ["y"])
    counts = nn.knn_label_counts(index, test, "y", [5], "manhattan")
    return counts.select("k", F.col("y").alias("true_label"), F.col("p").alias("pred_label"), "n")


def c05_prices(spark: SparkSession, folder: str) -> DataFrame:
    """All of lineitem by four features; nearly every row is a point of its own."""
    train, test = price_split(spark, folder)
    counts = nn.knn_label_counts(nn.build_index(train, PRICE_FEATURES, LINE_KEY, 5, ["y"]), test, "y", [5], "manhattan")
    return counts.select("k", F.col("y").alias("true_label"), F.col("p").alias("pred_label"), "n")


def _knn_counts_oracle(split: str, features: list[str]) -> str:
    """Votes of the five nearest rows by a bounded minimum instead of ranked pairs; equal test points are searched once."""
    names = ", ".join(features)
    near = f"min(struct_pack(d := {distance_sql(features, 'manhattan')}, k := t.k, y := t.y), 5)"
    return f"""WITH {_split_ctes(split, features)}, asked AS (SELECT {names}, count_if(y = 0) AS n0, count_if(y = 1) AS n1 FROM test GROUP BY ALL),
 five AS (SELECT any_value(n0) AS n0, any_value(n1) AS n1, {near} AS near FROM asked q, (SELECT * FROM train QUALIFY row_number() OVER (PARTITION BY {names} ORDER BY k) <= 5) t GROUP BY {', '.join('q.' + f for f in features)}),
 voted AS (SELECT n0, n1, (2 * list_sum(list_transform(near, lambda s: s.y)) > len(near))::INT AS p FROM five)
 SELECT 5::INT AS k, y AS true_label, p AS pred_label, sum(n)::BIGINT AS n FROM (SELECT 0 AS y, p, n0 AS n FROM voted UNION ALL SELECT 1, p, n1 FROM voted) GROUP BY y, p HAVING sum(n) > 0"""


def c06(spark: SparkSession, folder: str) -> DataFrame:
    train, test = part_split(spark, folder)
    return rounded(studies.knn_study(train, test, PART_FEATURES, "y", "p_partkey"))


C06 = f"WITH {_split_ctes(PART_SPLIT, PART_FEATURES)}, " + ", ".join(
    f"{near_sql(distance_sql(PART_FEATURES, m), 'p_partkey', 'y', 49, 'near_' + m)}, {votes_sql('near_' + m, 'p_partkey', fixed.KNN_STUDY_K, 'votes_' + m)}"
    for m in fixed.KNN_STUDY_METRICS
) + ", counts AS (" + union(
    [f"SELECT '{m}' AS metric, k, y, p, count(*) AS n FROM votes_{m} GROUP BY k, y, p" for m in fixed.KNN_STUDY_METRICS]
) + ") " + weighted_sql("counts", "metric, k")


# --- evaluation of the two simple models, feature-selection studies -------------------------------------------------

_METRICS = ["accuracy", "recall", "precision", "auc", "f1"]


def c14(spark: SparkSession, folder: str) -> DataFrame:
    train, test = part_split(spark, folder)
    return rounded(studies.evaluate_approach(train, test, PART_FEATURES, "y", "p_partkey"))


def evaluate_ctes(features: list[str], tag: str) -> str:
    """CTEs ending in best_<tag>(metric..., kind): one row for Naive Bayes, one for nearest neighbours."""
    variants = ["gaussian", "multinomial", "bernoulli"]
    ks = fixed.KNN_EVALUATE_K

    def pick(scores: str, name: str, count: int) -> str:
        # Candidates in order; one replaces the best so far only by more than 0.001.
        return f"""{name} AS (WITH RECURSIVE walk(i, best, top) AS (
  SELECT 0, 0, 0.0::DOUBLE UNION ALL
  SELECT w.i + 1, CASE WHEN s.accuracy - w.top > 0.001 THEN s.i ELSE w.best END, CASE WHEN s.accuracy - w.top > 0.001 THEN s.accuracy ELSE w.top END
  FROM walk w JOIN {scores} s ON s.i = w.i + 1) SELECT s.* FROM {scores} s JOIN walk w ON w.i = {count} AND s.i = w.best)"""

    nb_counts = union([f"SELECT {i + 1} AS i, y, p FROM {v}_{tag}" for i, v in enumerate(variants)])
    order = " ".join(f"WHEN {k} THEN {i + 1}" for i, k in enumerate(ks))
    return ", ".join([
        *[bayes_sql(v, features, f"{v}_{tag}") for v in variants],
        f"nb_scores_{tag} AS ({binary_sql(f'({nb_counts})', 'i')})",
        near_sql(distance_sql(features, "euclidean"), "p_partkey", "y", max(ks), f"near_{tag}"),
        votes_sql(f"near_{tag}", "p_partkey", ks, f"votes_{tag}"),
        f"knn_scores_{tag} AS ({binary_sql(f'(SELECT CASE k {order} END AS i, y, p FROM votes_{tag})', 'i')})",
        pick(f"nb_scores_{tag}", f"nb_best_{tag}", len(variants)),
        pick(f"knn_scores_{tag}", f"knn_best_{tag}", len(ks)),
    ])


C14 = f"WITH {_split_ctes(PART_SPLIT, PART_FEATURES)}, {evaluate_ctes(PART_FEATURES, 'a')} " + union(
    [f"SELECT '{m}' AS metric, {r('n.' + m, 'nb')}, {r('k.' + m, 'knn')} FROM nb_best_a n, knn_best_a k" for m in _METRICS]
)


def e09(spark: SparkSession, folder: str) -> DataFrame:
    train, test = part_split(spark, folder)
    return rounded(studies.variance_study(train, test, PART_WIDE, "y", "p_partkey"))


def _e09() -> str:
    # The variances at hand: shares lie below 0.1, the others far above 1.
    small, rest = ["size_share", "price_share"], [f for f in PART_WIDE if f not in ("size_share", "price_share")]
    variance = {f: f"(SELECT var_samp({f}) FROM train)" for f in small}
    sets = {"both": PART_WIDE, "size": [f for f in PART_WIDE if f != "price_share"], "price": [f for f in PART_WIDE if f != "size_share"], "none": rest}
    ctes = ", ".join(evaluate_ctes(f, t) for t, f in sets.items())
    rows = []
    for t in studies.variance_options(1.0, 0.05):
        chosen = f"CASE WHEN {variance['size_share']} < {t} THEN CASE WHEN {variance['price_share']} < {t} THEN 'none' ELSE 'price' END WHEN {variance['price_share']} < {t} THEN 'size' ELSE 'both' END"
        rows.append(f"SELECT {t}::DOUBLE AS threshold, variables, {r('nb', 'nb')}, {r('knn', 'knn')} FROM results WHERE tag = {chosen}")
    results = union([f"SELECT '{t}' AS tag, {len(f)}::INT AS variables, n.accuracy AS nb, k.accuracy AS knn FROM nb_best_{t} n, knn_best_{t} k" for t, f in sets.items()])
    return f"WITH {_split_ctes(PART_SPLIT, PART_WIDE)}, {ctes}, results AS ({results}) " + union(rows)


def e10(spark: SparkSession, folder: str) -> DataFrame:
    train, test = part_split(spark, folder)
    return rounded(studies.redundancy_study(train, test, PART_WIDE, "y", "p_partkey"))


def _e10() -> str:
    # p_retailprice and its multiples correlate fully, price_plus nearly so
    sets = {"pair": ["p_size", "size_share"], "plus": ["p_size", "size_share", "price_plus"]}
    ctes = ", ".join(evaluate_ctes(f, t) for t, f in sets.items())
    results = union([f"SELECT '{t}' AS tag, {len(f)}::INT AS variables, n.accuracy AS nb, k.accuracy AS knn FROM nb_best_{t} n, knn_best_{t} k" for t, f in sets.items()])
    near = "(SELECT round(abs(corr(p_retailprice, price_plus)), 12) FROM train)"
    rows = [f"SELECT {t}::DOUBLE AS threshold, variables, {r('nb', 'nb')}, {r('knn', 'knn')} FROM results WHERE tag = CASE WHEN {near} >= {t} THEN 'pair' ELSE 'plus' END" for t in studies.redundancy_options(0.9, 0.05)]
    return f"WITH {_split_ctes(PART_SPLIT, PART_WIDE)}, {ctes}, results AS ({results}) " + union(rows)


def best_of_study(spark: SparkSession, folder: str) -> DataFrame:
    order = F.when(F.col("metric") == "manhattan", 0).when(F.col("metric") == "euclidean", 1).otherwise(2)
    study = c06(spark, folder).withColumn("position", order * 100 + F.col("k"))
    return best_configuration(study, "accuracy", "position").drop("position")


C15 = f"""SELECT metric, k, accuracy, "precision", recall FROM ({C06})
ORDER BY accuracy DESC, CASE metric WHEN 'manhattan' THEN 0 WHEN 'euclidean' THEN 1 ELSE 2 END, k LIMIT 1"""


# --- trees and logistic regression in SQL, for two classes 0 and 1 ------------------------------------------------


def tree_sql(features: list[str], criterion: str, depth: int, tag: str) -> str:
    """CTEs ending in `<tag>_counts(depth, y, p, n)`: the label counts of the test rows at every depth of one exact tree."""
    names = ", ".join(features)

    def impurity(a: str, b: str) -> str:
        if criterion == "gini":
            return f"(CASE WHEN {a} + {b} > 0 THEN {a} + {b} - ({a} * {a} + {b} * {b}) / ({a} + {b}) ELSE 0 END)"
        weighed = lambda c: f"(CASE WHEN {c} > 0 THEN ({c}) * ln({c}) ELSE 0 END)"
        return f"({weighed(f'{a} + {b}')} - ({weighed(a)} + {weighed(b)}))"

    pick = "CASE feature " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(features)) + " END"
    root = "(SELECT (count_if(y = 1) > count_if(y = 0))::INT FROM train)"
    ctes = [
        f"{tag}_rows_0 AS MATERIALIZED (SELECT {names}, y, count(*)::DOUBLE AS n, 1::BIGINT AS node FROM train GROUP BY ALL)",
        f"{tag}_test_0 AS MATERIALIZED (SELECT {names}, y, count(*) AS n, 1::BIGINT AS node, {root} AS p FROM test GROUP BY ALL)",
    ]
    for d in range(depth):
        cells = union([f"SELECT node, {i} AS feature, {f}::DOUBLE AS v, sum(n) FILTER (y = 0) AS a, sum(n) FILTER (y = 1) AS b FROM {tag}_rows_{d} GROUP BY node, {f}" for i, f in enumerate(features)])
        ctes.append(f"""{tag}_best_{d} AS MATERIALIZED (SELECT node, feature, CASE WHEN (v + next) / 2 < next THEN (v + next) / 2 ELSE v END AS threshold, (l1 > l0)::INT AS pl, (r1 > r0)::INT AS pr FROM (
 SELECT *, t0 - l0 AS r0, t1 - l1 AS r1 FROM (SELECT node, feature, v, lead(v) OVER w AS next, sum(coalesce(a, 0)) OVER w AS l0, sum(coalesce(b, 0)) OVER w AS l1,
  sum(coalesce(a, 0)) OVER (PARTITION BY node, feature) AS t0, sum(coalesce(b, 0)) OVER (PARTITION BY node, feature) AS t1 FROM ({cells}) WINDOW w AS (PARTITION BY node, feature ORDER BY v)))
 WHERE next IS NOT NULL AND t0 > 0 AND t1 > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(({impurity('l0', 'l1')} + {impurity('r0', 'r1')}) / (t0 + t1), 10), feature, v) = 1)""")
        child = f"CASE WHEN b.node IS NULL THEN s.node WHEN {pick} <= threshold THEN 2 * s.node ELSE 2 * s.node + 1 END AS node"
        moved = f"LEFT JOIN {tag}_best_{d} b ON b.node = s.node"
        ctes.append(f"{tag}_rows_{d + 1} AS MATERIALIZED (SELECT {names}, y, n, {child} FROM {tag}_rows_{d} s {moved})")
        ctes.append(f"{tag}_test_{d + 1} AS MATERIALIZED (SELECT {names}, y, n, {child}, CASE WHEN b.node IS NULL THEN p WHEN {pick} <= threshold THEN pl ELSE pr END AS p FROM {tag}_test_{d} s {moved})")
    ctes.append(f"{tag}_counts AS (" + union([f"SELECT {d} AS depth, y, p, sum(n) AS n FROM {tag}_test_{d} GROUP BY y, p" for d in range(depth + 1)]) + ")")
    return ", ".join(ctes)


def _trees_oracle(grid: dict[str, list[int]], split: str, features: list[str]) -> str:
    depths = {c: max(d) for c, d in grid.items()}
    counts = union([f"SELECT '{c}' AS criterion, depth AS max_depth, y, p, n FROM {c}_counts WHERE depth IN ({', '.join(map(str, d))})" for c, d in grid.items()])
    order = " ".join(f"WHEN criterion = '{c}' AND max_depth = {d} THEN {i}" for i, (c, d) in enumerate((c, d) for c, ds in grid.items() for d in ds))
    ctes = ", ".join(tree_sql(features, c, d, c) for c, d in depths.items())
    scores = f"SELECT * FROM ({weighted_sql('counts', 'criterion, max_depth')})"
    return f"""WITH {_split_ctes(split, features)}, {ctes}, counts AS ({counts})
 SELECT (CASE {order} END)::INT AS position, criterion, max_depth, round(accuracy, 4) AS accuracy, round("precision", 4) AS "precision", round(recall, 4) AS recall FROM ({scores})"""


def logistic_sql(features: list[str], steps: int) -> str:
    """CTEs ending in `logit(w0, w1, ...)`, the intercept last: so many Newton steps of the l2 problem from zero, over grouped rows."""
    n = len(features) + 1
    x = [f"x.{f}" for f in features] + ["1"]
    start = ", ".join(f"0::DOUBLE AS w{i}" for i in range(n))
    ctes = [f"points AS MATERIALIZED (SELECT {', '.join(features)}, y, count(*)::DOUBLE AS n FROM train GROUP BY ALL)", f"logit_0 AS (SELECT {start})"]
    for k in range(steps):
        z = " + ".join(f"w.w{i} * {x[i]}" for i in range(n))
        keep = ", ".join(f"any_value(w{i}) AS w{i}" for i in range(n))
        grad = ", ".join(f"sum(n * (p - y) * {'1' if i == n - 1 else features[i]}) + any_value(w{i}) AS a{i}_{n}" for i in range(n))
        column = lambda i: "1" if i == n - 1 else features[i]
        hess = ", ".join(f"sum(n * p * (1 - p) * {column(i)} * {column(j)}) + {int(i == j)} AS a{i}_{j}" for i in range(n) for j in range(n))
        query = f"SELECT {keep}, {grad}, {hess} FROM (SELECT x.*, w.*, 1 / (1 + exp(-({z}))) AS p FROM points x, logit_{k} w)"
        for i in range(n):  # elimination without pivots: the matrix is positive definite
            cells = [f"a{r}_{c} - a{i}_{c} * a{r}_{i} / a{i}_{i} AS a{r}_{c}" if r != i and c > i else f"a{r}_{c}" for r in range(n) for c in range(n + 1)]
            query = f"SELECT {', '.join(f'w{j}' for j in range(n))}, {', '.join(cells)} FROM ({query})"
        ctes.append(f"logit_{k + 1} AS MATERIALIZED (SELECT " + ", ".join(f"w{i} - a{i}_{n} / a{i}_{i} AS w{i}" for i in range(n)) + f" FROM ({query}))")
    return ", ".join(ctes) + f", logit AS (SELECT * FROM logit_{steps})"


_LOGIT = f"WITH {_split_ctes(LINE_SPLIT, LINE_FEATURES)}, {logistic_sql(LINE_FEATURES, 24)}"
_LOGIT_SCORE = " + ".join([*[f"w{i} * {f}" for i, f in enumerate(LINE_FEATURES)], f"w{len(LINE_FEATURES)}"])
C09 = f"""{_LOGIT}, counts AS (SELECT y, p, count(*) AS n FROM (SELECT y, ({_LOGIT_SCORE} > 0)::INT AS p FROM test, logit) GROUP BY y, p)
 SELECT 0 AS position, 'l2' AS penalty, 1000 AS max_iter, round(accuracy, 4) AS accuracy, round("precision", 4) AS "precision", round(recall, 4) AS recall FROM ({weighted_sql('counts', '')})"""
C09_WEIGHTS = f"{_LOGIT} " + union([f"SELECT '{f}' AS feature, {r(f'w{i}', 'weight', 4)} FROM logit" for i, f in enumerate([*LINE_FEATURES, "(intercept)"])])


def c09_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The weights of the l2 fit."""
    train, _ = line_split(spark, folder)
    with Blocks(weighted_points(train, LINE_FEATURES, "y", [0, 1]), len(LINE_FEATURES)) as blocks:
        weights = logistic.fit_path(blocks, [0, 1], "l2", 1000).after(1000)[0]
    return rounded(spark.createDataFrame(list(zip([*LINE_FEATURES, "(intercept)"], map(float, weights))), "feature string, weight double"), 4)


# --- studies of the fitted models --------------------------------------------------------------------------------


def c07(spark: SparkSession, folder: str) -> DataFrame:
    train, test = line_split(spark, folder)
    return rounded(studies.tree_study(train, test, LINE_FEATURES, "y", ["entropy"], [10]), 4)


def c08(spark: SparkSession, folder: str) -> DataFrame:
    train, test = line_split(spark, folder)
    return rounded(studies.tree_study(train, test, LINE_FEATURES, "y"), 4)


def c08_prices(spark: SparkSession, folder: str) -> DataFrame:
    train, test = price_split(spark, folder)
    return rounded(studies.tree_study(train, test, PRICE_FEATURES, "y", ["entropy", "gini"], [2, 4, 6]), 4)


def c09(spark: SparkSession, folder: str) -> DataFrame:
    train, test = line_split(spark, folder)
    return rounded(studies.logistic_study(train, test, LINE_FEATURES, "y", ["l2"], [1000]), 4)


def c10(spark: SparkSession, folder: str) -> DataFrame:
    train, test = line_split(spark, folder)
    return rounded(studies.logistic_study(train, test, LINE_FEATURES, "y"), 4)


def c11(spark: SparkSession, folder: str) -> DataFrame:
    train, test = line_split(spark, folder)
    settings = {"MLP": fixed.LEADERBOARD["MLP"]}
    return studies.leaderboard([("lineitem", train, test, LINE_FEATURES, "y", LINE_KEY)], settings)


def c12(spark: SparkSession, folder: str) -> DataFrame:
    train, test = part_split(spark, folder)
    features = ["size_share", "price_share"]
    table_, _ = studies.mlp_study(train, test, features, "y")
    return rounded(table_, 4)


def c13(spark: SparkSession, folder: str) -> DataFrame:
    lines, parts = line_split(spark, folder), part_split(spark, folder)
    return studies.leaderboard([("lineitem", *lines, LINE_FEATURES, "y", LINE_KEY), ("part", *parts, PART_FEATURES, "y", "p_partkey")])


def c13_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The leaderboard lines of the two models that SQL can compute."""
    settings = {m: fixed.LEADERBOARD[m] for m in ("NaiveBayes", "KNN")}
    return studies.leaderboard([("part", *part_split(spark, folder), PART_FEATURES, "y", "p_partkey")], settings)


C13_EXACT = f"""WITH {_split_ctes(PART_SPLIT, PART_FEATURES)}, {bayes_sql('gaussian', PART_FEATURES, 'nb')},
 {near_sql(distance_sql(PART_FEATURES, 'manhattan'), 'p_partkey', 'y', 5, 'near')}, {votes_sql('near', 'p_partkey', [5], 'votes')},
 counts AS (SELECT 'NaiveBayes' AS model, y, p, count(*) AS n FROM nb GROUP BY y, p UNION ALL SELECT 'KNN', y, p, count(*) FROM votes GROUP BY y, p)
SELECT 'part' AS dataset, model, round(accuracy, 4) AS accuracy, round("precision", 4) AS "precision", round(recall, 4) AS recall, 'Success' AS note
FROM ({weighted_sql('counts', 'model', 'macro')})"""


QUERIES = {
    "c01_bayes_gaussian": _bayes_query("gaussian"),
    "c02_bayes_multinomial": _bayes_query("multinomial"),
    "c03_bayes_bernoulli": _bayes_query("bernoulli"),
    "c04_bayes_study": c04,
    "c05_knn_manhattan": _knn_query("manhattan"),
    "c05_knn_euclidean": _knn_query("euclidean"),
    "c05_knn_chebyshev": _knn_query("chebyshev"),
    "c05_nearest_rows": c05_neighbours,
    "c05_knn_vectors": c05_vectors,
    "c05_knn_lineitem": c05_lines,
    "c05_knn_prices": c05_prices,
    "c06_knn_study": c06,
    "c07_decision_tree": c07,
    "c08_tree_study": c08,
    "c08_tree_study_prices": c08_prices,
    "c09_logistic": c09,
    "c09_logistic_weights": c09_weights,
    "c10_logistic_study": c10,
    "c11_perceptron": c11,
    "c12_mlp_study": c12,
    "c13_leaderboard": c13,
    "c13_leaderboard_exact_models": c13_exact,
    "c14_evaluate_approach": c14,
    "c15_best_configuration": best_of_study,
    "e09_variance_study": e09,
    "e10_redundancy_study": e10,
}

ORACLES = {
    "c01_bayes_gaussian": _bayes_oracle("gaussian"),
    "c02_bayes_multinomial": _bayes_oracle("multinomial"),
    "c03_bayes_bernoulli": _bayes_oracle("bernoulli"),
    "c04_bayes_study": C04,
    **{f"c05_knn_{m}": _knn_oracle(m) for m in fixed.KNN_STUDY_METRICS},
    "c05_nearest_rows": f"""WITH {_split_ctes(PART_SPLIT, PART_FEATURES)} SELECT * FROM (SELECT q.p_partkey, row_number() OVER (PARTITION BY q.p_partkey ORDER BY {distance_sql(PART_FEATURES, 'euclidean')}, t.p_partkey) AS place,
 t.p_partkey AS train_key, {r(distance_sql(PART_FEATURES, 'euclidean'), 'distance')} FROM test q, train t) WHERE place <= 5""",
    "c05_knn_vectors": C05_VECTORS,
    "c05_knn_lineitem": _knn_counts_oracle(LINE_SPLIT, LINE_FEATURES),
    "c05_knn_prices": _knn_counts_oracle(PRICE_SPLIT, PRICE_FEATURES),
    "c06_knn_study": C06,
    "c07_decision_tree": _trees_oracle({"entropy": [10]}, LINE_SPLIT, LINE_FEATURES),
    "c08_tree_study": _trees_oracle({c: fixed.TREE_STUDY_DEPTHS for c in fixed.TREE_STUDY_CRITERIA}, LINE_SPLIT, LINE_FEATURES),
    "c08_tree_study_prices": _trees_oracle({"entropy": [2, 4, 6], "gini": [2, 4, 6]}, PRICE_SPLIT, PRICE_FEATURES),
    "c09_logistic": C09,
    "c09_logistic_weights": C09_WEIGHTS,
    "c13_leaderboard_exact_models": C13_EXACT,
    "c14_evaluate_approach": C14,
    "c15_best_configuration": C15,
    "e09_variance_study": _e09(),
    "e10_redundancy_study": _e10(),
}
