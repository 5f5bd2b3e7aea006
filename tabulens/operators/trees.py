"""Decision trees with exhaustive splits, grown level by level over weighted distinct rows.

A level counts the classes of every (node, feature, value) cell of its open nodes; running sums over the values give the class counts on
both sides of every split point, and each node takes the split of least impurity (ties: first feature, smallest value). No value is
binned. Several trees (one per criterion) grow in the same passes, and one tree answers for every smaller depth limit. The splits of each
level are stored, so nothing is computed twice and the plan does not grow.

While a level has few nodes, rows are numpy blocks (`tree_blocks`): stored once per feature of many values, in its order, so no level sorts
or sends rows. With more nodes or many classes, nodes and rows are tables. Values are cut into ranges there, so a feature with very many
values is summed range by range and the ranges' sums are put in order afterwards; no task sees all values of a feature. A value finds its
range in two steps over about the square root of their number.

An impure node is split as long as its rows differ, even where no split lowers the impurity. A leaf takes its most frequent class, the
first on a tie. Rows that lack a feature are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulens.functions.blocks import weighted_points
from tabulens.operators import tree_blocks
from tabulens.operators.tree_blocks import stored

CRITERIA = ("gini", "entropy")
#: Distinct points of a range of values, on average.
RANGE_POINTS = 200_000
#: Node numbers are 64-bit paths.
MAX_DEPTH = 60
DIGITS = 10
#: Features with more values are searched in their order; classes beyond which nodes and rows are tables from the root on.
MANY_VALUES, BLOCK_CLASSES = 1_000, 32


def _impurity(criterion: str, counts: list[Column]) -> Column:
    """Impurity times rows."""
    n = sum(counts[1:], counts[0]).cast("double")
    if criterion == "gini":
        return F.when(n > 0, n - sum((c.cast("double") * c.cast("double") for c in counts[1:]), counts[0].cast("double") * counts[0].cast("double")) / n).otherwise(0.0)
    weighed = lambda c: F.when(c > 0, c * F.ln(c)).otherwise(0.0)
    return weighed(n) - sum((weighed(c.cast("double")) for c in counts[1:]), weighed(counts[0].cast("double")))


def _first_largest(counts: Column) -> Column:
    return (F.array_position(counts, F.array_max(counts)) - 1).cast("int")


def _open(counts: Column) -> Column:
    return F.size(F.filter(counts, lambda c: c > 0)) > 1


@dataclass
class Trees:
    """levels[i]: (tree, node, feature, threshold, left, total): the splits of depth i; the root is node 1, children are 2 n and 2 n + 1."""

    features: list[str]
    labels: list
    criteria: list[str]
    root: list[int]
    levels: list[DataFrame] = field(default_factory=list)


def _ranges(points: DataFrame, n: int, n_features: int, range_points: int) -> Callable[[Column, Column], Column]:
    """Number of the range a value of a feature lies in: how many cut points are below it."""
    pieces = min(4_096, n // range_points + 1)
    if pieces == 1:
        return lambda f, v: F.lit(0)
    shares = [i / pieces for i in range(1, pieces)]
    found = points.agg(*[F.percentile_approx(F.get("x", F.lit(i)), shares, 10 * pieces).alias(f"c{i}") for i in range(n_features)]).first()
    cuts = [sorted(set(c)) for c in found]
    step = max(1, math.isqrt(pieces))
    literal = lambda values: F.array(*[F.lit(float(c)) for c in values])
    coarse = F.array(*[literal(c[step - 1 :: step]) for c in cuts])
    fine = F.array(*[F.array(*[literal(c[j : j + step]) for j in range(0, len(c) + 1, step)]) for c in cuts])
    below = lambda values, v: F.size(F.filter(values, lambda c: c < v))

    def number_of(f: Column, v: Column) -> Column:
        block = below(F.get(coarse, f), v)
        return block * step + F.coalesce(below(F.get(F.get(fine, f), block), v), F.lit(0))

    return number_of


def _cells(rows: DataFrame, trees: Trees, range_of: Callable) -> DataFrame:
    """Class counts of every (node, feature, value) of the open nodes."""
    counts, totals = _count_names(trees)
    # totals are numbers of their own: an array in the aggregate would have all cells sorted
    long = rows.where("open and w > 0").select(
        "tree", "node", "y", "w", *[F.get("total", F.lit(i)).alias(t) for i, t in enumerate(totals)], F.posexplode("x").alias("feature", "v"))
    return long.withColumn("part", range_of(F.col("feature"), F.col("v"))).groupBy("tree", "node", "feature", "part", "v").agg(
        *[F.sum(F.when(F.col("y") == i, F.col("w")).otherwise(0)).alias(c) for i, c in enumerate(counts)], *[F.max(t).alias(t) for t in totals])


def _count_names(trees: Trees) -> tuple[list[str], list[str]]:
    return [f"c{i}" for i in range(len(trees.labels))], [f"t{i}" for i in range(len(trees.labels))]


def _split_points(cells: DataFrame, trees: Trees, one_range: bool) -> DataFrame:
    """Values with the next value of their node and feature, and the class counts up to them."""
    counts, totals = _count_names(trees)
    group = ["tree", "node", "feature"]
    inside = Window.partitionBy(*group, "part").orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    run = cells.select(*group, "part", "v", *totals, F.lead("v").over(inside).alias("next"), *[F.sum(c).over(upto).alias(c) for c in counts])
    if not one_range:
        parts = cells.groupBy(*group, "part").agg(F.min("v").alias("least"), *[F.sum(c).alias(c) for c in counts])
        order = Window.partitionBy(*group).orderBy("part")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(*group, "part", F.lead("least").over(order).alias("after"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b_{c}") for c in counts])
        run = run.join(parts, [*group, "part"]).withColumns({"next": F.coalesce("next", "after"), **{c: F.col(c) + F.col(f"b_{c}") for c in counts}})
    return run.where("next is not null").select(*group, "part", "v", "next", *counts, *totals)


def _best_splits(run: DataFrame, trees: Trees) -> DataFrame:
    """The split of every open node that has one."""
    counts, totals = _count_names(trees)
    group = ["tree", "node", "feature"]
    left = [F.col(c) for c in counts]
    right = [F.col(t) - F.col(c) for c, t in zip(counts, totals)]
    score = F.lit(None).cast("double")
    for i, criterion in enumerate(trees.criteria):
        score = F.when(F.col("tree") == i, _impurity(criterion, left) + _impurity(criterion, right)).otherwise(score)
    n = sum((F.col(t) for t in totals[1:]), F.col(totals[0]))
    found = run.select(
        *group, "part", F.struct(F.round(score / n, DIGITS).alias("score"), "feature", "v", "next", F.array(*left).alias("left"), F.array(*totals).alias("total")).alias("s"))
    # the windows leave the rows in order of feature and part, so the first minimum needs no sort
    best = found.groupBy(*group, "part").agg(F.min("s").alias("s")).groupBy("tree", "node").agg(F.min("s").alias("s"))
    middle = (F.col("s.v") + F.col("s.next")) / 2
    threshold = F.when(middle < F.col("s.next"), middle).otherwise(F.col("s.v"))
    return best.select("tree", "node", F.col("s.feature").alias("feature"), threshold.alias("threshold"), F.col("s.left").alias("left"), F.col("s.total").alias("all"))


def _moved(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """The rows one level down, with the class `p` of their new node."""
    names = rows.columns
    right = F.zip_with("all", "left", lambda a, b: a - b)
    ends = {f"{name}_{side}": of(c) for side, c in (("left", F.col("left")), ("right", right)) for name, of in (("p", _first_largest), ("open", _open), ("total", lambda c: c))}
    joined = rows.join(splits.select("tree", "node", "feature", "threshold", *[e.alias(n) for n, e in ends.items()]), ["tree", "node"], "left")
    split = F.col("threshold").isNotNull()
    goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
    side = lambda name, other: F.when(~split, other).when(goes_left, F.col(f"{name}_left")).otherwise(F.col(f"{name}_right"))
    changed = {
        "node": F.when(split, F.col("node") * 2 + F.when(goes_left, 0).otherwise(1)).otherwise(F.col("node")),
        "p": side("p", F.col("p")),
    }
    if "open" in names:
        changed |= {"total": side("total", F.col("total")), "open": side("open", F.lit(False))}
    return joined.withColumns(changed).select(*names)


def grow(
    train: DataFrame, features: Sequence[str], target: str, labels: Sequence, criteria: Sequence[str] = ("gini",), max_depth: int = 10,
    watched: DataFrame | None = None, at_level: Callable[[int, DataFrame], None] | None = None, range_points: int = RANGE_POINTS,
) -> Trees:
    """Trees of up to `max_depth` levels, one per criterion.

    `watched` rows go down with the train rows; `at_level(depth, rows)` sees them at every depth up to the last with a split as (tree, y, p, w): label, class of their
    node (as positions in `labels`, null for other labels) and number of rows.
    """
    points = weighted_points(train, features, target, labels)
    below = None if watched is None else weighted_points(watched, features, target, labels)
    return grow_points(stored(points.where("y is not null")), features, labels, criteria, max_depth, below, at_level, range_points)


def grow_points(
    points: DataFrame, features: Sequence[str], labels: Sequence, criteria: Sequence[str] = ("gini",), max_depth: int = 10,
    watched: DataFrame | None = None, at_level: Callable[[int, DataFrame], None] | None = None, range_points: int = RANGE_POINTS,
) -> Trees:
    """As `grow`, from stored points (x, y, w); train points without a known label are left out already."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"trees are at most {MAX_DEPTH} levels deep")
    if set(criteria) - set(CRITERIA):
        raise ValueError(f"criteria are {', '.join(CRITERIA)}")
    width = len(features)
    about = points.groupBy("y").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(F.get("x", F.lit(i))).alias(f"v{i}") for i in range(width)]).collect()
    if not about:
        raise ValueError("no rows to learn from")
    sums = {r["y"]: r["w"] for r in about}
    total = [sums.get(i, 0) for i in range(len(labels))]
    trees = Trees(list(features), list(labels), list(criteria), total)
    n = sum(r["n"] for r in about)
    depth = 0
    if len(labels) <= BLOCK_CLASSES:
        wide = [i for i in range(width) if max(r[f"v{i}"] for r in about) > MANY_VALUES]
        depth = tree_blocks.grow(points, trees, wide, n, range_points, max_depth, watched, at_level, _best_of_blocks)
    if depth is not None:
        _grow_tables(points, trees, n, range_points, depth, max_depth, watched, at_level)
    return trees


def _best_of_blocks(cells: DataFrame | None, ends: DataFrame | None, trees: Trees) -> DataFrame:
    """The stored splits from the cells of features of few values and the candidates of the others."""
    counts, totals = _count_names(trees)
    found = []
    if cells is not None:
        summed = cells.groupBy("tree", "node", "feature", "v").agg(*[F.sum(c).alias(c) for c in counts], *[F.max(t).alias(t) for t in totals])
        found.append(_split_points(summed.withColumn("part", F.lit(0)), trees, True))
    if ends is not None:
        found.append(ends.withColumn("part", F.lit(0)).select("tree", "node", "feature", "part", "v", "next", *counts, *totals))
    return stored(_best_splits(found[0].union(found[1]) if len(found) > 1 else found[0], trees))


def _grow_tables(points: DataFrame, trees: Trees, n: int, range_points: int, start: int, max_depth: int, watched: DataFrame | None, at_level: Callable | None) -> None:
    """Levels from `start` on, with nodes and rows as tables: for any number of nodes and classes."""
    range_of, one_range = _ranges(points, n, len(trees.features), range_points), n < range_points
    first = F.array(*[F.lit(t).cast("long") for t in trees.root])
    rows = points.select("x", "y", "w", F.lit(0).cast("long").alias("seen"))
    if watched is not None:
        rows = rows.union(watched.select("x", "y", F.lit(0).cast("long"), "w"))
    rows = rows.select(
        F.explode(F.array(*[F.lit(i) for i in range(len(trees.criteria))])).alias("tree"), F.lit(1).cast("long").alias("node"), "x", "y", "w", "seen",
        first.alias("total"), _first_largest(first).alias("p"), _open(first).alias("open"))
    rows = stored(rows)
    for splits in trees.levels:
        rows = stored(_moved(rows, splits).where("open or seen > 0"))
    for depth in range(start, max_depth + 1):
        if at_level is not None:
            at_level(depth, rows.where("seen > 0").select("tree", "y", "p", F.col("seen").alias("w")))
        if depth == max_depth:
            break
        splits = stored(_best_splits(_split_points(_cells(rows, trees, range_of), trees, one_range), trees))
        if splits.isEmpty():
            break
        trees.levels.append(splits)
        # train rows in leaves have said what they know
        rows = stored(_moved(rows, splits).where("open or seen > 0"))


def predict(trees: Trees, df: DataFrame, tree: int = 0, depth: int | None = None, name: str = "prediction") -> DataFrame:
    """The rows with their predicted label; `depth` cuts the tree."""
    from tabulens.functions.columns import number

    gap = F.raise_error(F.lit("a row lacks a feature; fill or drop such rows first")).cast("double")
    start = trees.root.index(max(trees.root))
    rows = df.select(F.struct("*").alias("row"), F.array(*[F.coalesce(number(df, f), gap) for f in trees.features]).alias("x"), F.lit(tree).alias("tree"), F.lit(1).cast("long").alias("node"), F.lit(start).alias("p"))
    for i, splits in enumerate(trees.levels[:depth]):
        rows = _moved(rows, splits)
        if i % 4 == 3:
            rows = stored(rows)
    labels = F.array(*[F.lit(v) for v in trees.labels])
    return rows.select("row.*", F.get(labels, F.col("p")).alias(name))
