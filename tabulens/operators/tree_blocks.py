"""Levels of decision trees with few nodes, over numpy blocks of weighted points.

Points are stored once per feature of many values, cut into blocks in the order of that feature. The nodes so far go to every block, which
finds the node of each of its points. For a feature of many values a first pass counts the classes of every node in each block, so that a
second one knows the counts before its block, and of each node only the split points of least impurity leave it. Features of few values
leave as class counts per (node, feature, value). No level sorts or sends points. What reaches the driver is a number per block, open node
and class; with more than MOST_NUMBERS of them the caller goes on with tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulens.session import shared_folder

#: Bytes of a block's points, points of a task where there are fewer than the cores need, open nodes of a tree, and numbers on the driver.
BLOCK_BYTES, LEAST_POINTS, MOST_NODES, MOST_NUMBERS = 8 << 20, 20_000, 30_000, 4_000_000
#: Copies times features beyond which tables take less room.
MOST_COLUMNS = 32
#: Split points so near to the least impurity leave a block; the caller rounds and compares them.
NEAR = 2e-10
BLOCK = "name string, by int, low double, high double, x binary, y binary, w binary"


def stored(df: DataFrame) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/tree-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _packed(points: DataFrame, width: int, by: int, rows: int, n: int = 0) -> DataFrame:
    """The points as blocks of up to `rows`; the n points are in the order of a feature if `by` is one."""

    def block(table: pa.Table) -> pa.RecordBatch:
        x = np.stack([table.column(i).to_numpy() for i in range(width)]) if width else np.zeros((0, len(table)))
        y, w = (table.column(c).to_numpy().astype(np.int64) for c in ("y", "w"))
        ends = (float(x[by, 0]), float(x[by, -1])) if by >= 0 else (0.0, 0.0)
        values = [uuid.uuid4().hex, by, *ends, x.tobytes(), y.tobytes(), w.tobytes()]
        kinds = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], ["name", "by", "low", "high", "x", "y", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, rows))
                held, n = table.slice(rows).to_batches(), n - rows
        if n:
            yield block(pa.Table.from_batches(held))

    flat = points.select(*[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(width)], F.coalesce("y", F.lit(-1)).alias("y"), F.col("w").cast("long").alias("w"))
    if by >= 0:
        pieces = max(n // rows + 1, min(points.sparkSession.sparkContext.defaultParallelism, n // LEAST_POINTS + 1))
        # equal values are dealt out too
        order = [f"x{by}", F.xxhash64(*[f"x{i}" for i in range(width)], "y")]
        flat = flat.repartitionByRange(pieces, *order).sortWithinPartitions(f"x{by}")
    return flat.mapInArrow(run, BLOCK)


class _Nodes:
    """The nodes of one tree; a leaf leads to itself."""

    def __init__(self, total: list[int]):
        self.total = np.array([total], np.int64)
        self.node, self.feature, self.threshold = np.ones(1, np.int64), np.zeros(1, np.int32), np.zeros(1)
        self.child = np.zeros(2, np.int32)
        self.levels = 0
        self.fresh = np.zeros(1, np.int64)  # of the last level

    @property
    def label(self) -> np.ndarray:
        return self.total.argmax(axis=1)

    def open(self) -> np.ndarray:
        """Numbers of the open nodes of the last level."""
        return self.fresh[(self.total[self.fresh] > 0).sum(axis=1) > 1]

    def split(self, found: list) -> None:
        """Add the children of (node, feature, threshold, left, all)."""
        order = np.argsort(self.node[self.fresh])
        place = self.fresh[order][np.searchsorted(self.node[self.fresh][order], np.array([r[0] for r in found], np.int64))] if found else np.zeros(0, np.int64)
        n, k = len(self.node), self.total.shape[1]
        left = np.array([r[3] for r in found], np.int64).reshape(-1, k)
        both = np.stack([left, np.array([r[4] for r in found], np.int64).reshape(-1, k) - left], axis=1).reshape(-1, k)
        new = np.arange(n, n + len(both))
        self.feature[place], self.threshold[place] = [r[1] for r in found], [r[2] for r in found]
        self.child.reshape(-1, 2)[place] = new.reshape(-1, 2)
        self.node = np.append(self.node, (self.node[place, None] * 2 + np.array([0, 1])).ravel())
        self.feature, self.threshold = np.append(self.feature, np.zeros(len(new), np.int32)), np.append(self.threshold, np.zeros(len(new)))
        self.child = np.append(self.child, np.repeat(new, 2)).astype(np.int32)
        self.total, self.fresh, self.levels = np.concatenate([self.total, both]), new, self.levels + 1

    def find(self, x: np.ndarray) -> np.ndarray:
        """The node of each point, as its number."""
        n = x.shape[1]
        at, flat, every = np.zeros(n, np.int32), x.ravel(), np.arange(n)
        for _ in range(self.levels):
            at = self.child[2 * at + (flat[self.feature[at] * n + every] > self.threshold[at])]
        return at


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            name, by = batch.column("name")[i].as_py(), batch.column("by")[i].as_py()
            x, y, w = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (("x", np.float64), ("y", np.int64), ("w", np.int64)))
            yield name, by, x.reshape(width, len(y)), y, w


def _ranks(nodes: _Nodes) -> tuple[np.ndarray, int]:
    """The place of each node among the open ones, -1 for others, and how many are open."""
    here = nodes.open()
    rank = np.full(len(nodes.node), -1, np.int32)
    rank[here] = np.arange(len(here))
    return rank, len(here)


def _impurity(criterion: str, c: np.ndarray) -> np.ndarray:
    """Impurity times rows; the rows of c are class counts."""
    n = c.sum(axis=1)
    if criterion == "gini":
        return np.where(n > 0, n - (c * c).sum(axis=1) / np.maximum(n, 1), 0.0)
    return n * np.log(np.maximum(n, 1)) - (c * np.log(np.maximum(c, 1))).sum(axis=1)


def _in_blocks(blocks: DataFrame, forest: list[_Nodes], width: int, k: int) -> list:
    """(name, by, low, high, counts, least): per tree and open node the class counts of a block and its least value of the block's feature."""
    ranks = [_ranks(nodes) for nodes in forest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, by, x, y, w in _blocks(batches, width):
            counts, least = [], []
            for nodes, (rank, n) in zip(forest, ranks):
                at = rank[nodes.find(x)]
                keep = np.flatnonzero(at >= 0)
                at, first = at[keep], np.full(n, np.nan)
                first[at[::-1]] = x[by][keep][::-1]  # the last to be written is the least
                counts.append(np.bincount(at.astype(np.int64) * k + y[keep], w[keep], n * k).astype(np.int64))
                least.append(first)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([np.concatenate(counts).tobytes()], pa.binary()), pa.array([np.concatenate(least).tobytes()], pa.binary())], ["name", "counts", "least"])

    seen = blocks.mapInArrow(run, "name string, counts binary, least binary").collect()
    return [(r["name"], np.frombuffer(r["counts"], np.int64).reshape(-1, k), np.frombuffer(r["least"])) for r in seen]


def _around(found: list, ends: dict[str, tuple]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """name: per open node of all trees the class counts before the block, and the least value behind it."""
    out = {}
    by = lambda f: ends[f[0]][0]
    for feature in {by(f) for f in found}:
        # blocks of one feature only meet at equal values: those that hold nothing else are in the middle
        mine = sorted((f for f in found if by(f) == feature), key=lambda f: ends[f[0]][1:])
        before, after = np.cumsum([c for _, c, _ in mine], axis=0) - [c for _, c, _ in mine], np.full(len(mine[0][2]), np.nan)
        for i in reversed(range(len(mine))):
            name, _, least = mine[i]
            out[name] = before[i], after
            after = np.where(np.isnan(least), after, least)
    return out


def _split_points(
    by: int, x: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, total: np.ndarray, criterion: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(open node, value, next value, class counts up to it) of the least impurities of each node in a block; at: the open nodes of the points."""
    keep = np.flatnonzero(at >= 0)
    order = keep[np.argsort(at[keep].astype(np.int16), kind="stable")]
    node, v, k = at[order], x[by][order], total.shape[1]
    if not len(node):
        return node, v, v, np.zeros((0, k), np.int64)
    left = np.zeros((len(node), k), np.int64)
    left[np.arange(len(node)), y[order]] = w[order]
    left = np.cumsum(left, axis=0)
    last = np.append(node[1:] != node[:-1], True)
    starts = np.append(0, np.flatnonzero(last)[:-1] + 1)
    own = np.where(starts[:, None] > 0, left[starts - 1], 0)
    left += np.repeat(before[node[starts]] - own, np.diff(np.append(starts, len(node))), axis=0)
    behind = np.append(v[1:], np.nan)
    behind[last] = after[node[last]]
    ends = np.flatnonzero((behind != v) & ~np.isnan(behind))
    if not len(ends):
        return node[:0], v[:0], v[:0], left[:0]
    node, v, behind, left = node[ends], v[ends], behind[ends], left[ends]
    right = total[node] - left
    score = (_impurity(criterion, left.astype(float)) + _impurity(criterion, right.astype(float))) / total[node].sum(axis=1)
    starts = np.append(0, np.flatnonzero(node[1:] != node[:-1]) + 1)
    least = np.repeat(np.minimum.reduceat(score, starts), np.diff(np.append(starts, len(node))))
    best = np.flatnonzero(score <= least + NEAR)
    return node[best], v[best], behind[best], left[best]


def _cells(values: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, w: np.ndarray, at: np.ndarray, n: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the feature, open node, value, class counts) of the points' (open node, value) pairs."""
    keep = np.flatnonzero(at >= 0)
    at, y, w = at[keep].astype(np.int64), y[keep], w[keep]
    for i, (names, code) in enumerate(values):
        cell = at * len(names) + code[keep]
        held = np.arange(n * len(names)) if n * len(names) <= 4 * len(keep) else np.unique(cell)
        place = cell if len(held) == n * len(names) else np.searchsorted(held, cell)
        counts = np.bincount(place * k + y, w, len(held) * k).astype(np.int64).reshape(-1, k)
        some = np.flatnonzero(counts.any(axis=1))
        yield i, held[some] // len(names), names[held[some] % len(names)], counts[some]


def _candidates(
    blocks: DataFrame, forest: list[_Nodes], criteria: list[str], width: int, k: int, narrow: list[int], counting: int, around: dict
) -> DataFrame:
    """(tree, node, feature, v, next, c0.., t0..): split points of features of many values, and, without next, cells of the others."""
    ranks, kinds = [_ranks(nodes) for nodes in forest], ["tree", "node", "feature", "v", "next", *[f"c{i}" for i in range(k)], *[f"t{i}" for i in range(k)]]
    starts = np.append(0, np.cumsum([n for _, n in ranks]))

    def rows(tree: int, feature: int, at: np.ndarray, v: np.ndarray, behind: np.ndarray | None, counts: np.ndarray) -> pa.RecordBatch:
        here = forest[tree].open()[at]
        total = forest[tree].total[here]
        columns = [pa.array(np.full(len(at), tree, np.int32)), pa.array(forest[tree].node[here]), pa.array(np.full(len(at), feature, np.int32)), pa.array(np.ascontiguousarray(v)),
                   pa.nulls(len(at), pa.float64()) if behind is None else pa.array(np.ascontiguousarray(behind))]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array(np.ascontiguousarray(c)) for c in (*counts.T, *total.T)]], kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, by, x, y, w in _blocks(batches, width):
            values = [np.unique(x[f], return_inverse=True) for f in narrow] if by == counting else []
            for tree, (nodes, (rank, n)) in enumerate(zip(forest, ranks)):
                if not n:
                    continue
                at = rank[nodes.find(x)]
                for i, node, v, counts in _cells(values, y, w, at, n, k):
                    yield rows(tree, narrow[i], node, v, None, counts)
                if by >= 0:
                    here = slice(starts[tree], starts[tree + 1])
                    before, after = (a[here] for a in around[name])
                    node, v, behind, left = _split_points(by, x, y, w, at, before, after, nodes.total[nodes.open()], criteria[tree])
                    yield rows(tree, by, node, v, behind, left)

    return blocks.mapInArrow(run, "tree int, node long, feature int, v double, next double, " + ", ".join(f"{c} long" for c in kinds[5:]))


def _classes(blocks: DataFrame, forest: list[_Nodes], width: int) -> DataFrame:
    """(tree, y, p, w): known label (null for others), class of the node and number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, x, y, w in _blocks(batches, width):
            for tree, nodes in enumerate(forest):
                k = nodes.total.shape[1]
                counts = np.bincount((y + 1) * k + nodes.label[nodes.find(x)], w, (k + 1) * k).astype(np.int64)
                some = np.flatnonzero(counts)
                label = some // k - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), tree, np.int32)), pa.array(label.astype(np.int32), mask=label < 0), pa.array((some % k).astype(np.int32)), pa.array(counts[some])], ["tree", "y", "p", "w"])

    return blocks.mapInArrow(run, "tree int, y int, p int, w long")


def grow(
    points: DataFrame, trees, wide: list[int], n: int, range_points: int, max_depth: int, watched: DataFrame | None,
    at_level: Callable[[int, DataFrame], None] | None, best: Callable[[DataFrame | None, DataFrame | None, object], DataFrame],
) -> int | None:
    """Add levels of splits to `trees`. None when they are done, else the depth from which tables have to go on."""
    spark: SparkSession = points.sparkSession
    width, k = len(trees.features), len(trees.labels)
    if len(wide) * width > MOST_COLUMNS:
        return 0
    rows = max(1, min(range_points, BLOCK_BYTES // (8 * (width + 2))))
    narrow, counting = [f for f in range(width) if f not in wide], wide[0] if wide else -1
    blocks, ends = None, {}
    for by in wide or [-1]:
        copy = stored(_packed(points, width, by, rows, n))
        blocks = copy if blocks is None else blocks.union(copy)
    if wide:
        ends = {r["name"]: (r["by"], r["low"], r["high"]) for r in blocks.select("name", "by", "low", "high").collect()}
    seen = None if watched is None or at_level is None else stored(_packed(watched, width, -1, rows))
    forest = [_Nodes(trees.root) for _ in trees.criteria]
    for depth in range(max_depth + 1):
        here = [len(nodes.open()) for nodes in forest]
        if max(here) > MOST_NODES or sum(here) * len(ends) * (k + 1) > MOST_NUMBERS:
            return depth
        if at_level is not None:
            at_level(depth, spark.createDataFrame([], "tree int, y int, p int, w long") if seen is None else _classes(seen, forest, width))
        if depth == max_depth or not sum(here):
            break
        around = _around(_in_blocks(blocks, forest, width, k), ends) if wide else {}
        found = stored(_candidates(blocks, forest, list(trees.criteria), width, k, narrow, counting, around))
        splits = best(found.where("next is null") if narrow else None, found.where("next is not null") if wide else None, trees)
        each = splits.select("tree", "node", "feature", "threshold", "left", "all").collect()
        if not each:
            break
        trees.levels.append(splits)
        for i, nodes in enumerate(forest):
            nodes.split([tuple(r)[1:] for r in each if r["tree"] == i])
    return None
