"""Neighbours against brute force, Naive Bayes, metrics, studies."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabulens.functions.blocks import Blocks, weighted_points
from tabulens.operators import evaluation as ev, logistic, neighbours as nn, perceptron, trees
from tabulens.operators.bayes import NegativeValues, fit_bayes
from tabulens.operators.missing import fill_missing
from tabulens.plans import studies


def points(spark, n, seed, hot=0.0):
    """Random rows; a share of them are copies of one point."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)) * [10, 1, 3], 1)
    x[rng.random(n) < hot] = [1.0, 2.0, 3.0]
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "k long, a double, b double, c double, y int")


def brute(train, test, k, metric):
    fold = {"manhattan": lambda g: g.sum(-1), "euclidean": lambda g: np.sqrt((g * g).sum(-1)), "chebyshev": lambda g: g.max(-1)}[metric]
    t, q = train.toPandas().sort_values("k"), test.toPandas()
    result = {}
    for _, row in q.iterrows():
        d = np.round(fold(np.abs(t[["a", "b", "c"]].to_numpy() - row[["a", "b", "c"]].to_numpy(dtype=float))), 9)
        near = t.iloc[np.argsort(d, kind="stable")[:k]]["y"].tolist()
        result[int(row["k"])] = min(set(near), key=lambda v: (-near.count(v), v))
    return result


@pytest.mark.parametrize("metric", ["manhattan", "euclidean", "chebyshev"])
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_knn_equals_brute_force(spark, metric, hot):
    train, test = points(spark, 600, 1, hot), points(spark, 90, 2, hot)
    index = nn.build_index(train, ["a", "b", "c"], "k", 7, ["y"], block_rows=40)
    assert len(index.boxes.names) > 4
    votes = nn.knn_votes(index, test, "y", [7], metric, query_rows=10)
    named = test.withColumn("query", nn.query_id(test, ["a", "b", "c"])).join(votes, "query")
    assert {r["k"]: r["p"] for r in named.select(test["k"], "p").collect()} == brute(train, test, 7, metric)


def test_knn_with_fewer_rows_than_neighbours(spark):
    train, test = points(spark, 3, 1), points(spark, 5, 2)
    assert nn.knn_predict(train, test, ["a", "b", "c"], "y", "k", 10).filter("prediction is null").count() == 0


def test_vote_tie_takes_the_smallest_label(spark):
    train = spark.createDataFrame([(1, 0.0, 5), (2, 0.0, 3), (3, 9.0, 1)], "k int, x double, y int")
    test = spark.createDataFrame([(1, 0.0)], "k int, x double")
    assert nn.knn_predict(train, test, ["x"], "y", "k", 2).first()["prediction"] == 3


def test_knn_imputation_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(160, 3)) * 5, 1)
    x[rng.random(x.shape) < 0.15] = np.nan
    x[7] = np.nan
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "k int, a double, b double, c double")
    filled = {r["k"]: r for r in fill_missing(df, "knn", "k").collect()}
    assert len(filled) == 160
    for i, row in enumerate(x):
        for j, c in enumerate("abc"):
            if not np.isnan(row[j]):
                assert filled[i][c] == row[j]
                continue
            gaps = (x - row) ** 2
            known = (~np.isnan(gaps)).sum(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(known > 0, np.round(np.sqrt(np.nansum(gaps, 1) * 3 / known), 9), np.inf)
            d[np.isnan(x[:, j])] = np.inf
            order = [k for k in np.argsort(d, kind="stable")[:5] if np.isfinite(d[k])]
            expected = x[order, j].mean() if order else np.nanmean(x[:, j])
            assert math.isclose(filled[i][c], expected, abs_tol=1e-9)


def test_bayes_variants(spark):
    train = points(spark, 400, 3)
    model = fit_bayes(train, ["a", "b", "c"], "y")
    hits = model.predict(train).filter("prediction = y").count()
    assert hits > 350
    with pytest.raises(NegativeValues):
        fit_bayes(train, ["a"], "y", "multinomial")
    study = {r["variant"]: r for r in studies.bayes_study(train, train, ["a", "b", "c"], "y").collect()}
    assert study["multinomial"]["accuracy"] == 0.0 and study["gaussian"]["accuracy"] == hits / 400
    assert math.isclose(study["gaussian"]["recall"], study["gaussian"]["accuracy"])


def test_scores_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("c", "a"), ("b", "b")], "y string, p string")
    report = {r["label"]: r for r in ev.classification_report(df).collect()}
    assert report["c"]["precision"] == 0.0 and report["c"]["support"] == 2
    assert math.isclose(report["macro avg"]["recall"], (0.5 + 1 + 0) / 3)
    assert math.isclose(report["weighted avg"]["recall"], report["accuracy"]["recall"])
    cells = {(r["true_label"], r["pred_label"]): r["n"] for r in ev.confusion_matrix(df).collect()}
    assert len(cells) == 9 and cells[("c", "c")] == 0 and cells[("b", "b")] == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=30).filter(lambda v: len({y for y, _ in v}) == 2))
def test_auc_is_the_chance_of_a_right_order(spark, values):
    df = spark.createDataFrame(values, "y int, s int")
    pairs = [(a > b) + 0.5 * (a == b) for y, a in values if y for z, b in values if not z]
    assert math.isclose(ev.auc(df, "y", "s").first()["auc"], sum(pairs) / len(pairs))


def test_roc_curve_starts_and_ends_at_the_corners(spark):
    df = points(spark, 100, 4)
    curve = sorted((r["fpr"], r["tpr"]) for r in ev.roc_curve(df, "y", ["a"], range_rows=7).collect())
    assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0)


def test_best_configuration_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(0, "x", 0.5), (1, "y", 0.9), (2, "z", 0.9)], "position int, name string, accuracy double")
    assert ev.best_configuration(df, "accuracy", "position").first()["name"] == "y"


def test_studies_beat_the_majority(spark):
    train, test = points(spark, 500, 6), points(spark, 200, 7)
    features = ["a", "b", "c"]
    share = max(test.filter("y = 1").count(), test.filter("y = 0").count()) / 200
    trees_ = studies.tree_study(train, test, features, "y", ["gini"], [2, 6])
    assert trees_.agg(F.max("accuracy")).first()[0] > share
    logits = studies.logistic_study(train, test, features, "y", ["l2"], [5, 100, 200]).orderBy("max_iter").collect()
    assert logits[1]["accuracy"] > share and logits[1]["accuracy"] == logits[2]["accuracy"]
    table, weights = studies.mlp_study(train, test, features, "y", ["adaptive"], [0.5], 10, 20, hidden=5)
    assert table.count() == 2 and weights is not None
    board = studies.leaderboard([("d", train, test, features, "y", "k")], {"NaiveBayes": {"variant": "multinomial"}, "KNN": {"k": 5, "metric": "manhattan"}, "MLP": {"hidden": 8, "max_iter": 60}, "LogReg": {"penalty": "l1", "max_iter": 50}, "DecisionTree": {"criterion": "entropy", "max_depth": 4}})
    notes = {r["model"]: (r["note"], r["accuracy"]) for r in board.collect()}
    assert notes["NaiveBayes"] == ("Failed", 0.0) and all(notes[m][0] == "Success" and notes[m][1] > share for m in ("KNN", "LogReg", "DecisionTree"))
    assert notes["MLP"][0] == "Success"


def test_best_of_a_study_and_its_report(spark):
    train, test = points(spark, 300, 6), points(spark, 100, 7)
    study = studies.knn_study_full(train, test, ["a", "b", "c"], "y", "k", [1, 9], ["manhattan"])
    best = study.best.first()
    assert best["accuracy"] == study.scores.agg(F.max("accuracy")).first()[0]
    report = {r["label"]: r for r in study.report.collect()}
    assert math.isclose(report["accuracy"]["f1"], best["accuracy"]) and report["macro avg"]["support"] == 100
    assert studies.bayes_study_full(train, test, ["a", "b", "c"], "y").best.first()["variant"] in ("gaussian", "bernoulli")
    assert {r["label"] for r in studies.logistic_study_full(train, test, ["a"], "y", ["l1"], [3]).report.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def _best_split(x, y, w, n_labels, criterion):
    def impurity(c):
        n = c.sum()
        if criterion == "gini":
            return n - (c * c).sum() / n
        return -(c[c > 0] * np.log(c[c > 0] / n)).sum()

    found = []
    for f in range(x.shape[1]):
        for a, b in zip(*(lambda v: (v[:-1], v[1:]))(np.unique(x[:, f]))):
            left = x[:, f] <= a
            sides = [np.bincount(y[s], w[s], n_labels) for s in (left, ~left)]
            found.append((round(sum(map(impurity, sides)) / w.sum(), 10), f, a, (a + b) / 2))
    return min(found) if found else None


@pytest.mark.parametrize("criterion", ["gini", "entropy"])
@pytest.mark.parametrize("range_points", [10**6, 15])
def test_trees_take_the_best_of_all_splits(spark, criterion, range_points):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(150, 2)) * 4, 1)
    y = ((x[:, 0] * x[:, 1] > 1).astype(int) + (x[:, 0] > 3)) % 3
    y[rng.random(150) < 0.1] = 2
    rows = [(*map(float, r), "abc"[v]) for r, v in zip(x, y)] + [(0.5, 0.5, "a"), (0.5, 0.5, "b")] * 3
    x, y = np.array([r[:2] for r in rows]), np.array(["abc".index(r[2]) for r in rows])
    frame = spark.createDataFrame(rows, "a double, b double, y string")
    grown = trees.grow(frame, ["a", "b"], "y", ["a", "b", "c"], [criterion], 30, range_points=range_points)

    def expected(at, depth):
        counts = np.bincount(y[at], minlength=3)
        split = _best_split(x[at], y[at], np.ones(len(at)), 3, criterion) if depth and (counts > 0).sum() > 1 else None
        if split is None:
            return lambda q: "abc"[counts.argmax()]
        left = x[at, split[1]] <= split[2]
        below = expected(at[left], depth - 1), expected(at[~left], depth - 1)
        return lambda q: below[int(q[split[1]] > split[3])](q)

    asked = [tuple(map(float, r)) for r in np.round(rng.normal(size=(60, 2)) * 4, 2)]
    for depth in (0, 2, 5, 30):
        tree = expected(np.arange(len(x)), depth)
        got = trees.predict(grown, spark.createDataFrame(asked, "a double, b double"), depth=depth)
        assert {(r["a"], r["b"]): r["prediction"] for r in got.collect()} == {q: tree(q) for q in asked}


@pytest.mark.parametrize("settings", [{}, {"MANY_VALUES": 0}, {"MANY_VALUES": 30}, {"MANY_VALUES": 0, "MOST_NODES": 3}, {"MANY_VALUES": 0, "MOST_COLUMNS": 2}])
def test_trees_over_blocks_and_over_tables_are_equal(spark, monkeypatch, settings):
    """Features of few and of many values, equal values across blocks, and a change to tables on the way."""
    rng = np.random.default_rng(8)
    x = np.stack([np.round(rng.normal(size=300), 2), rng.integers(0, 4, 300), np.where(rng.random(300) < 0.5, 0.0, np.round(rng.normal(size=300), 1))], axis=1)
    y = (x[:, 0] + x[:, 1] + rng.normal(size=300) > 1).astype(int) + (rng.random(300) < 0.2)
    frame = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(np.vstack([x, x[:40]]), [*y, *y[:40]])], "a double, b double, c double, y int")
    asked = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(rng.normal(size=(50, 3)) * 2, rng.integers(0, 5, 50))], "a double, b double, c double, y int")

    def grown():
        seen = {}
        made = trees.grow(frame, ["a", "b", "c"], "y", [0, 1, 2], ["gini", "entropy"], 5, asked,
                          lambda depth, rows: seen.update({depth: sorted(map(str, rows.groupBy("tree", "y", "p").agg(F.sum("w")).collect()))}), range_points=17)
        return [sorted(map(str, level.select("tree", "node", "feature", "threshold", "left", "all").collect())) for level in made.levels], seen

    with monkeypatch.context() as patch:
        patch.setattr(trees, "BLOCK_CLASSES", 0)
        expected = grown()
    asked_of = []
    for name, value in settings.items():
        monkeypatch.setattr(trees if hasattr(trees, name) else trees.tree_blocks, name, value)
    monkeypatch.setattr(trees, "_grow_tables", lambda *given, run=trees._grow_tables: (asked_of.append(given[4]), run(*given)))
    assert grown() == expected and len(expected[0]) == 5
    assert asked_of == ([2] if "MOST_NODES" in settings else [0] if "MOST_COLUMNS" in settings else [])


@pytest.mark.parametrize("penalty", ["l1", "l2"])
@pytest.mark.parametrize("labels", [2, 3])
def test_logistic_weights_are_optimal(spark, penalty, labels):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(400, 3)) * [5, 1, 0.1], 1)
    y = np.clip((x[:, 0] / 4 + rng.logistic(size=400)).round().astype(int) + 1, 0, labels - 1)
    frame = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, y int")
    with Blocks(weighted_points(frame, ["a", "b", "c"], "y", list(range(labels))), 3, block_points=40) as blocks:
        path = logistic.fit_path(blocks, list(range(labels)), penalty, 200)
    ones = np.c_[x, np.ones(400)]
    for c, w in enumerate(path.weights[-1]):
        grad = ones.T @ (1 / (1 + np.exp(-ones @ w)) - (y == (1 if labels == 2 else c)))
        if penalty == "l2":
            assert np.abs(grad + w).max() < 1e-4
        else:
            assert np.abs(grad[w != 0] + np.sign(w[w != 0])).max(initial=0) < 1e-4 and np.abs(grad[w == 0]).max(initial=0) <= 1 + 1e-4
    assert len(path.weights) < 40 and path.after(10_000) is path.weights[-1] and not path.after(0).any()


@pytest.mark.parametrize("activation,labels", [("relu", 2), ("logistic", 3)])
def test_perceptron_steps(spark, activation, labels):
    """The gradient against differences of the loss; the first steps of both solvers by hand; schedules."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(90, 2)).round(1), rng.integers(0, labels, 90)
    frame = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, y int")
    shape = perceptron.Shape(2, 4, labels, activation)
    start = shape.start(1)

    def loss(v):
        z = perceptron._forward(shape, v, x)[1]
        z = np.c_[np.zeros(len(z)), z] if labels == 2 else z
        return -(z[np.arange(90), y] - np.log(np.exp(z).sum(1))).mean() + 0.5 * perceptron.ALPHA / 90 * (shape.penalised() * v * v).sum()

    grad = np.array([(loss(start + h) - loss(start - h)) / 2e-6 for h in np.eye(shape.size) * 1e-6])
    with Blocks(weighted_points(frame, ["a", "b"], "y", list(range(labels))), 2, block_points=20) as blocks:
        trainer = perceptron.Trainer(blocks, shape, [("adam", "constant", 0.01), ("sgd", "constant", 0.1), ("sgd", "invscaling", 0.1), ("sgd", "adaptive", 1e-5)], seed=1)
        after = trainer.run(1)
        assert trainer.losses[0] == pytest.approx(loss(start))
        assert after[0] == pytest.approx(start - 0.01 * grad / (np.abs(grad) + 1e-8 / np.sqrt(1 - 0.999)), abs=1e-5)
        assert after[1] == pytest.approx(start - 0.1 * 1.9 * grad, abs=1e-6)
        trainer.run(12)
    assert trainer.rates[2] == pytest.approx(0.1 / np.sqrt(14)) and trainer.rates[3] == pytest.approx(2e-6) and trainer.losses[1] < loss(start)


def test_points_with_gaps_are_refused(spark):
    train = points(spark, 50, 1)
    holes = train.withColumn("b", F.when(F.col("k") != 3, F.col("b")))
    for study in (studies.tree_study, studies.logistic_study, studies.mlp_study):
        with pytest.raises(ValueError, match="lacks a feature"):
            study(holes, train, ["a", "b"], "y")


def test_registered_perceptrons_run_the_full_grids(spark, monkeypatch):
    """What the registered queries ask the trainer for, without training."""
    from registry import modelling
    from tabulens import fixed_values as fixed

    asked = []

    class Trained:
        def __init__(self, _, shape, settings):
            self.hidden, self.weights = shape.hidden, np.tile(shape.start(), (len(settings), 1))

        def run(self, steps):
            asked.append((self.hidden, len(self.weights), steps))
            return self.weights

    monkeypatch.setattr(studies.perceptron, "Trainer", Trained)
    folder = "/root/testdata/sf0.001"
    assert modelling.c12(spark, folder).count() == 120 and asked == [(100, 12, fixed.MLP_STUDY_LAG)] * 10
    for query, datasets in ((modelling.c11, 1), (modelling.c13, 2)):
        asked.clear()
        query(spark, folder)
        assert asked == [(fixed.LEADERBOARD["MLP"]["hidden"], 1, fixed.LEADERBOARD["MLP"]["max_iter"])] * datasets


def test_study_options():
    assert studies.variance_options(1.0, 0.05)[0] == 0.05 and len(studies.variance_options(1.0, 0.05)) == 20
    assert studies.redundancy_options(0.9, 0.05) == [0.9, 0.95, 1.0]


def test_feature_selection_studies(spark):
    train, test = points(spark, 200, 8), points(spark, 80, 9)
    found = studies.redundancy_study(train, test, ["a", "b", "c"], "y", "k").collect()
    assert [r["threshold"] for r in found] == [0.9, 0.95, 1.0] and {r["variables"] for r in found} == {3}


@pytest.mark.parametrize("variant", ["gaussian", "multinomial", "bernoulli"])
def test_bayes_refuses_missing_features(spark, variant):
    whole = spark.createDataFrame([(float(i % 5), float(i % 3), i % 2) for i in range(40)], "a double, b double, y int")
    holes = whole.withColumn("a", F.when(F.col("b") != 1, F.col("a")))
    with pytest.raises(ValueError, match="lacks a feature"):
        fit_bayes(holes, ["a", "b"], "y", variant)
    model = fit_bayes(whole, ["a", "b"], "y", variant)
    assert model.predict(whole).where("prediction is null").count() == 0
    with pytest.raises(Exception, match="lacks a feature"):
        model.predict(holes).collect()


@pytest.mark.parametrize("metric", ["manhattan", "euclidean", "chebyshev"])
def test_pivot_boxes_are_exact_and_exclude(spark, metric):
    """Clustered rows of twelve features: the same neighbours as brute force, from few boxes."""
    rng = np.random.default_rng(7)
    names, centres = [f"f{i}" for i in range(12)], rng.normal(size=(20, 12)) * 50
    made = lambda n: np.round(centres[rng.integers(0, 20, n)] + rng.normal(size=(n, 12)), 2)
    x, q = made(900), made(60)
    x[:200] = x[0]
    frame = lambda v: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], "k long, " + ", ".join(f"{n} double" for n in names))
    index = nn.build_index(frame(x), names, "k", 4, block_rows=30)
    assert index.boxes.pivots is not None and len(index.boxes.names) > 8
    near = nn.nearest_rows(index, frame(q), 4, metric)
    fold = {"manhattan": lambda g: g.sum(-1), "euclidean": lambda g: np.sqrt((g * g).sum(-1)), "chebyshev": lambda g: g.max(-1)}[metric]
    named = frame(q).withColumn("query", nn.query_id(frame(q), names)).select("k", "query").join(near, "query")
    got = {(r["k"], r["place"]): r["train_key"] for r in named.collect()}
    for i, row in enumerate(q):
        d = np.round(fold(np.abs(x - row)), 9)
        assert [got[i, p] for p in range(1, 5)] == np.argsort(d, kind="stable")[:4].tolist()
    assert nn.boxes_searched(index, frame(q), 4, metric).agg(F.avg("boxes")).first()[0] < 0.3 * len(index.boxes.names)


def test_rows_without_structure_are_searched_by_shelves(spark, monkeypatch):
    """Directions at random: no box is excluded, yet a query meets few groups; copies, split shelves and split queries change nothing."""
    rng = np.random.default_rng(11)
    names = [f"f{i}" for i in range(16)]
    made = lambda n: (lambda v: v / np.linalg.norm(v, axis=1)[:, None])(rng.normal(size=(n, 16)))
    x, q = made(1500), made(70)
    x[700:800], q[:20] = x[0], x[:20]
    frame = lambda v: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], "k long, " + ", ".join(f"{n} double" for n in names))
    monkeypatch.setattr(nn, "SHELF_ROWS", 200)
    index = nn.build_index(frame(x), names, "k", 4, block_rows=30)
    shelves = np.unique(index.boxes.shelves)
    assert 1 < len(shelves) <= len(index.boxes.names) / 3 and index.boxes.parts[shelves].max() > 1
    near = nn.nearest_rows(index, frame(q), 4, query_rows=20)
    named = frame(q).withColumn("query", nn.query_id(frame(q), names)).select("k", "query").join(near, "query")
    got = {(r["k"], r["place"]): r["train_key"] for r in named.collect()}
    for i, row in enumerate(q):
        d = np.round(np.sqrt(((x - row) ** 2).sum(-1)), 9)
        assert [got[i, p] for p in range(1, 5)] == np.argsort(d, kind="stable")[:4].tolist()


@pytest.mark.parametrize("shift, scale, most", [(0.0, 1.0, 0.02), (1e6, 1.0, 0.02), (0.0, 1e-12, 1.0), (0.0, 1e25, 0.02)])
def test_matrix_products_leave_few_pairs_and_none_out(monkeypatch, shift, scale, most):
    """All distances that decide are computed from the features, whatever the offset and size of the values; most pairs need none."""
    rng = np.random.default_rng(3)
    x, q = (np.round(rng.normal(size=(n, 12)), 2) * scale + shift for n in (6_000, 300))
    x[3_000:3_050] = x[:50]
    q[:50], pairs, paired = x[:50], [], nn._paired
    monkeypatch.setattr(nn, "_paired", lambda x, r, a, b: pairs.append(len(a)) or paired(x, r, a, b))
    a, b, dist = nn._by_product(q, np.full(len(q), np.inf), nn._Rows(x), 5)
    total = np.zeros((len(q), len(x)))
    for j in range(12):
        total += (q[:, j, None] - x[None, :, j]) ** 2
    d = np.round(np.sqrt(total), 9)
    order = np.argsort(d, axis=1, kind="stable")[:, :5]
    assert (a == np.repeat(np.arange(300), 5)).all() and (b == order.ravel()).all() and (dist == np.take_along_axis(d, order, 1).ravel()).all()
    assert sum(pairs) <= most * d.size


def test_single_precision_that_separates_too_little_is_not_used():
    """Two far groups in one box: the rows of a group are nearer to each other than single precision can tell."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4_000, 12)) * 1e-4
    x[::2] += 1e3
    a, b, dist = nn._by_product(x[:64], np.full(64, np.inf), nn._Rows(x), 3)
    d = np.round(nn._distances(x[:64], x, "euclidean"), 9)
    assert (b.reshape(-1, 3) == np.argsort(d, axis=1, kind="stable")[:, :3]).all() and (dist[::3] == 0).all()


def test_neighbours_refuse_gaps(spark):
    train = points(spark, 40, 1)
    holes = train.withColumn("b", F.when(F.col("k") != 3, F.col("b")))
    for a, b in ((holes, train), (train, holes)):
        with pytest.raises(ValueError, match="lacks a feature"):
            nn.knn_predict(a, b, ["a", "b"], "y", "k")


def test_a_tree_study_reads_each_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    rows = [(float(i % 7), float(i), "ab"[i % 3 == 0]) for i in range(60)]
    train, test = [spark.createDataFrame(part, "a double, b double, y string").mapInPandas(counted, "a double, b double, y string") for part in (rows[:40], rows[40:])]
    scores = studies.tree_study(train, test, ["a", "b"], "y", ["gini"], [2, 3]).collect()
    assert len(scores) == 2 and read.value == 60
    gap = spark.createDataFrame([(None, 1.0, "a")], "a double, b double, y string")
    with pytest.raises(ValueError):
        studies.tree_study(gap, test, ["a", "b"], "y", ["gini"], [2])


def test_ranges_of_many_cuts_count_the_cuts_below(spark):
    points = spark.createDataFrame([([float(i), 1.0],) for i in range(500)], "x array<double>")
    for size in (3, 10, 100):
        number = trees._ranges(points, 500, 2, size)
        found = points.select(F.get("x", F.lit(0)).alias("v"), number(F.lit(0), F.get("x", F.lit(0))).alias("r"), number(F.lit(1), F.lit(1.0)).alias("one")).collect()
        parts = [r["r"] for r in sorted(found, key=lambda r: r["v"])]
        assert parts == sorted(parts) and {r["one"] for r in found} == {0}
        assert set(parts) == set(range(max(parts) + 1)) and max(parts.count(p) for p in set(parts)) <= 2 * size


@pytest.mark.parametrize("features, scale", [(1, 1.0), (4, 1.0), (4, 1e4)])
def test_search_by_cells_finds_the_same_rows_as_all_distances(features, scale):
    rng = np.random.default_rng(features)
    rows = np.round(rng.normal(size=(700, features)) * scale, 1)
    rows[:60] = rows[0]
    asked = np.vstack([np.round(rng.normal(size=(150, features)) * scale, 1), rows[:20]])
    _assert_same_rows(asked, rows, nn.METRICS, lambda far, k, metric: nn._by_cells(asked, far, rows, k, metric))


@pytest.mark.parametrize("metric", nn.METRICS)
@pytest.mark.parametrize("features, k", [(1, 5), (3, 5), (3, 40)])
def test_queries_go_to_few_boxes_and_miss_none(metric, features, k):
    """A sample of the rows limits the distances, closer than the boxes' far corners do."""
    rng = np.random.default_rng(features)
    rows = rng.normal(size=(6_000, features)) * [100, 1, 1][:features]
    rows[:50] = rows[0]
    box = np.searchsorted(np.quantile(rows[:, 0], np.arange(1, 60) / 60), rows[:, 0])
    held = [rows[box == i] for i in range(60)]
    boxes = nn._Boxes(list(range(60)), *(np.array([f(h, axis=0) for h in held]) for f in (np.min, np.max)), np.array([len(h) for h in held]), np.ones(60, int), np.ones((60, features), bool))
    asked = np.vstack([rng.normal(size=(300, features)) * 100, rows[:20], rows[rng.integers(0, len(rows), 1_500)]])
    q, b, limit = nn._near_boxes(asked, boxes, nn._Sample(rows[rng.permutation(len(rows))[:1_800]]), k, metric)
    dist = np.round(nn._distances(asked, rows, metric), 9)
    last = np.sort(dist, axis=1)[:, k - 1]
    assert (limit >= last).all() and (np.diff(q) >= 0).all()
    near = {(i, int(box[j])) for i, j in zip(*np.nonzero(dist <= last[:, None]))}
    assert near <= set(zip(q.tolist(), b.tolist()))
    if k == 5:
        assert len(q) < 0.7 * np.count_nonzero(nn._reachable(asked, None, boxes, k, metric)[0])


def _assert_same_rows(asked, rows, metrics, search):
    for metric in metrics:
        for k in (1, 5, 49):
            for far in (np.full(len(asked), np.inf), np.linspace(0, np.abs(rows).max(), len(asked))):
                dist = np.round(nn._distances(asked, rows, metric), 9)
                dist[dist > far[:, None]] = np.inf
                q, t = nn._k_smallest(dist, k)
                found = list(zip(*search(far, k, metric)))
                assert sorted(found) == sorted(zip(q, t, dist[q, t]))


@pytest.mark.parametrize("features, scale, rows", [(10, 1.0, 500), (64, 1e4, 300), (64, 1e-3, 3)])
def test_search_by_product_finds_the_same_rows_as_all_distances(features, scale, rows):
    rng = np.random.default_rng(features)
    train = rng.normal(size=(rows, features)) * scale + 3
    train[: rows // 5] = train[0]
    asked = np.vstack([rng.normal(size=(60, features)) * scale + 3, train[:20]])
    _assert_same_rows(asked, train, ["euclidean"], lambda far, k, _: nn._by_product(asked, far, train, k))


def test_blocks_use_the_cores_whatever_the_partitions(spark):
    one = spark.createDataFrame([([float(i)], 0, 1) for i in range(400)], "x array<double>, y int, w long").coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    for frame in (one, one.repartition(3 * cores)):
        with Blocks(frame, 1, 8) as blocks:
            assert blocks.parts == cores
            assert blocks.sum(lambda x, y, w: np.array([w.sum()]))[0] == 400


def test_a_feature_of_one_wide_scale_gets_many_slices(spark):
    train, test = points(spark, 600, 1), points(spark, 60, 2)
    wide = [df.withColumn("a", F.col("a") * 1000) for df in (train, test)]
    index = nn.build_index(wide[0], ["a", "b", "c"], "k", 5, ["y"], block_rows=4)
    assert len(index.boxes.names) > nn.MAX_SLICES
    named = wide[1].withColumn("query", nn.query_id(wide[1], ["a", "b", "c"])).join(nn.knn_votes(index, wide[1], "y", [5], "manhattan"), "query")
    assert {r["k"]: r["p"] for r in named.select(wide[1]["k"], "p").collect()} == brute(*wide, 5, "manhattan")
