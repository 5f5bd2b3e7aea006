"""Exact nearest rows, the k-nearest-neighbour classifier, and imputation from neighbours.

The train rows are cut into boxes: by quantile slices of the widest features, or, with many features (where slices of a few
exclude little), by their nearest pivot. Pivots are the means of a bounded sample; a box then also knows the least and largest
distance of its rows to the pivot, and the triangle inequality bounds distances in every metric offered. For every distinct query
point a bounded sample of the rows (else the boxes) gives an upper limit of its k-th distance, and only boxes that can hold a closer row are
searched; neighbouring query points are placed together, so that few boxes are looked at for each.
Query points travel to their boxes by an equi-key shuffle; a box and its query points meet in groups of bounded
size (large boxes and busy boxes are split by hash), and each group returns at most k rows per query point. Boxes around pivots meet
their query points by shelves of neighbouring boxes, so that a point that no box excludes travels to few groups. Within a group rows and
queries are cut into small cells, and only cells within reach are compared; on a shelf every query takes the boxes by their distance, and
euclidean distances are bounded by a matrix product first and computed for what can be among the nearest.
Equal train points are cut to their first k keys and equal query points are searched once, so copies do not
make a group hot. The result is exact for every metric offered. Rows that lack a feature are refused, in the train table and
among the queries, unless the index is made for gaps. The cut and boxed train points are
checkpointed once and serve every search on them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabulens.functions.blocks import refuse_gaps
from tabulens.functions.columns import key_list, key_text, number, number_sql
from tabulens.functions.running import range_number
from tabulens.session import ensure_checkpoint_dir

METRICS = ["manhattan", "euclidean", "chebyshev"]
BLOCK_ROWS = 2_048
#: Queries of a box, beyond which they are split by hash.
QUERY_ROWS = 65_536
MAX_BOXES = 4_096
MAX_SLICES = 64
#: Boxes of larger tables hold more rows, up to this; a box is split by hash beyond so many times its planned rows.
LARGE_ROWS, PART_BOXES = 16_384, 4
#: Rows or queries of a cell within a group.
CELL_ROWS = 64
#: Sampled rows per box that limit distances, rows of a cell of them, queries that are placed at a time, and in a cell of those.
SAMPLE_ROWS, SAMPLE_CELL, PLACE_ROWS, PLACE_CELL = 32, 32, 131_072, 128
#: From so many features on, boxes are made around pivots; sampled rows per pivot, and rounds of moving pivots to their means.
PIVOT_FEATURES, PIVOT_SAMPLE, PIVOT_ROUNDS = 8, 8, 4
#: Boxes around pivots that are searched together; rows of a shelf of such boxes and queries of it, beyond which they are split by hash.
SHELF_BOXES, SHELF_ROWS, SHELF_QUERIES = 8, 65_536, 32_768
#: Queries and rows of one matrix product, pairs whose distances are computed at a time, and pairs per neighbour that are too many.
PRODUCT_QUERIES, PRODUCT_ROWS, PAIR_ROWS, MANY_PAIRS = 256, 2_048, 8_192, 4
_DIGITS = 9


@dataclass
class _Boxes:
    """Box edges, row counts, number of parts per box, with missing values the present features, with pivots these, the rows' distances and
    the shelf of each box; parts are then those of the shelves."""

    names: list
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    parts: np.ndarray
    present: np.ndarray
    pivots: np.ndarray | None = None
    least: dict[str, np.ndarray] | None = None
    most: dict[str, np.ndarray] | None = None
    shelves: np.ndarray | None = None


def query_id(df: DataFrame, features: Sequence[str]) -> Column:
    """A key that is equal for equal feature vectors; missing values are equal to each other."""
    values = [f"{number_sql(df, f)} + 0.0D" for f in features]
    gaps = [f"{v} IS NULL" for v in values]
    # Two differently seeded 64-bit hashes; missing values are hashed as flags because they are skipped as values.
    both = ", ".join([*values, *gaps])
    return F.expr(f"concat(hex(xxhash64({both})), '-', hex(xxhash64(1, {both})))")


def _train_key(key: str | Sequence[str]) -> Column:
    keys = key_list(key)
    return F.col(keys[0]) if len(keys) == 1 else key_text(keys)


def _planned_rows(points: DataFrame, block_rows: int | None) -> int:
    return block_rows or max(BLOCK_ROWS, min(LARGE_ROWS, points.count() // 64))


def _slices(points: DataFrame, names: list[str], block_rows: int, max_slices: int = MAX_SLICES) -> list[tuple[str, list[float]]]:
    """Cut points: the feature with the widest remaining slice is halved until the boxes are small enough."""
    row = points.agg(F.count("*").alias("n"), *[F.stddev_pop(x).alias(x) for x in names]).first()
    widths = np.array([row[x] or 0.0 for x in names])
    pieces = np.ones(len(names), dtype=int)
    target = min(MAX_BOXES, row["n"] // block_rows + 1)
    while pieces.prod() < target:
        reach = np.where(pieces < max_slices, widths / pieces, 0.0)
        if reach.max() <= 0:
            break
        pieces[int(reach.argmax())] *= 2
    chosen = [(x, int(p)) for x, p in zip(names, pieces) if p > 1]
    if not chosen:
        return []
    found = points.agg(
        *[F.percentile_approx(x, [j / p for j in range(1, p)], max(1_000, 10 * p)).alias(x) for x, p in chosen]
    ).first()
    return [(x, sorted(set(found[x] or []))) for x, _ in chosen]


def _box_name(names: list[str], slices: list[tuple[str, list[float]]]) -> Column:
    """The box of a point with gaps: its present features, and a slice of each cut feature."""
    parts = [F.expr("concat(" + ", ".join(f"IF({x} IS NULL, '0', '1')" for x in names) + ")")]
    for x, cuts in slices:
        parts.append(F.expr(f"IF({x} IS NULL, '-', CAST({_above(x, cuts)} AS STRING))"))
    return F.concat_ws("/", *parts)


def _box_number(slices: list[tuple[str, list[float]]]) -> Column:
    """The box of a point without gaps."""
    number = F.lit(0).cast("long")
    for x, cuts in slices:
        place = range_number(F.col(x), cuts) if len(cuts) >= MAX_SLICES else F.expr(_above(x, cuts))
        number = number * (len(cuts) + 1) + place
    return number


def _above(x: str, cuts: list[float]) -> str:
    return " + ".join(f"IF({x} > {c!r}D, 1, 0)" for c in cuts) or "0"


def _pivots(points: DataFrame, names: list[str], block_rows: int) -> np.ndarray:
    """One pivot per `block_rows` rows, MAX_BOXES at most: means of a hashed sample, moved as in k-means. Only the sample reaches the driver."""
    n = points.count()
    target = min(MAX_BOXES, n // block_rows + 1)
    share = min(1.0, PIVOT_SAMPLE * target / max(n, 1))
    picked = points.where(F.pmod(F.xxhash64(*names), F.lit(1 << 30)) < int(share * (1 << 30))).select(*names).limit(4 * PIVOT_SAMPLE * target)
    sample = np.array(sorted(map(tuple, picked.collect())), float).reshape(-1, len(names))
    if not len(sample):
        return np.zeros((1, len(names)))
    pivots = sample[np.linspace(0, len(sample) - 1, min(target, len(sample))).astype(int)]
    for _ in range(PIVOT_ROUNDS):
        near = _nearest_pivot(sample, pivots)
        held = np.bincount(near, minlength=len(pivots))
        sums = np.stack([np.bincount(near, c, len(pivots)) for c in sample.T], axis=1)
        pivots = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], pivots)
    return pivots


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return ((pivots**2).sum(1) - 2 * x @ pivots.T).argmin(1)


def _shelves(pivots: np.ndarray) -> np.ndarray:
    """The shelf of each pivot: neighbouring pivots are put together."""
    found = np.zeros(len(pivots), dtype=np.int64)
    for i, group in enumerate(_leaves(pivots, SHELF_BOXES)):
        found[group] = i
    return found


def _by_pivot(points: DataFrame, names: list[str], pivots: np.ndarray, shelves: np.ndarray) -> DataFrame:
    """The points with their box (the number of the pivot), its shelf and, per metric, their distance to its pivot."""
    fields = [
        *points.schema.fields, T.StructField("box", T.LongType()), T.StructField("shelf", T.LongType()),
        *[T.StructField(f"to_{m}", T.DoubleType()) for m in METRICS],
    ]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            near = _nearest_pivot(x, pivots)
            gaps = np.abs(x - pivots[near])
            yield pdf.assign(box=near, shelf=shelves[near], **{f"to_{m}": _fold(gaps, m) for m in METRICS})

    return points.mapInPandas(assign, T.StructType(fields))


def _collect_boxes(
    boxed: DataFrame, names: list[str], part_rows: int, pivots: np.ndarray | None = None, shelves: np.ndarray | None = None
) -> _Boxes:
    edges = [f(x).alias(f"{p}_{x}") for x in names for p, f in (("low", F.min), ("high", F.max))]
    if pivots is not None:
        edges += [f(f"to_{m}").alias(f"{p}_{m}") for m in METRICS for p, f in (("low", F.min), ("high", F.max))]
    rows = boxed.groupBy("box").agg(F.count("*").alias("n"), *edges).orderBy("box").collect()

    def table(side: str) -> np.ndarray:
        cells = [[np.nan if r[f"{side}_{x}"] is None else r[f"{side}_{x}"] for x in names] for r in rows]
        return np.array(cells, dtype=float).reshape(-1, len(names))

    counts = np.array([r["n"] for r in rows], dtype=np.int64)
    low = table("low")
    found = _Boxes([r["box"] for r in rows], low, table("high"), counts, counts // part_rows + 1, ~np.isnan(low))
    if pivots is not None:
        place = np.array(found.names, dtype=np.int64)
        found.pivots, found.shelves = pivots[place].reshape(-1, len(names)), shelves[place]
        found.parts = np.bincount(found.shelves, counts, len(pivots)).astype(np.int64) // part_rows + 1
        found.least, found.most = ({m: np.array([r[f"{side}_{m}"] for r in rows]) for m in METRICS} for side in ("low", "high"))
    return found


class _Sample:
    """Some train rows in small cells. Any k of them limit the distance of the k-th nearest row."""

    def __init__(self, rows: np.ndarray):
        cells = _leaves(rows, SAMPLE_CELL)
        self.rows = rows[np.concatenate(cells)]
        self.starts = np.cumsum([0, *map(len, cells)])
        self.low, self.high = (np.array([f(rows[c], axis=0) for c in cells]) for f in (np.min, np.max))

    def limits(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, metric: str) -> np.ndarray:
        """For queries between low and high no less than the distance of the k-th nearest row, from the cells near by."""
        away = _apart(low, high, self.low, self.high, metric)
        few = min(len(away), max(8, k // SAMPLE_CELL * 4))
        near = np.argpartition(away, few - 1)[:few] if few < len(away) else np.arange(len(away))
        inside = np.flatnonzero(away == 0)
        near = np.union1d(near, inside[:: -(-len(inside) // 64)] if len(inside) else inside)
        rows = np.concatenate([self.rows[self.starts[c] : self.starts[c + 1]] for c in near])
        if len(rows) < k:
            rows = self.rows
        return np.partition(np.round(_distances(x, rows, metric), _DIGITS), k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-9


def _sampled(points: DataFrame, names: list[str], boxes: _Boxes) -> _Sample | None:
    n, wanted = int(boxes.rows.sum()), SAMPLE_ROWS * len(boxes.names)
    picked = points.where(F.pmod(F.xxhash64("train_key", *names), F.lit(1 << 30)) < int(min(1.0, wanted / max(n, 1)) * (1 << 30)))
    found = picked.select(*names).limit(4 * wanted).toArrow()
    rows = np.stack([found.column(x).to_numpy() for x in names], axis=1) if found.num_rows else np.empty((0, len(names)))
    rows = rows[np.isfinite(rows).all(axis=1)]
    return _Sample(rows) if len(rows) else None


@dataclass
class Index:
    """Train points cut to k rows per point, with their box; `names` are the feature columns x0, x1, ..."""

    features: list[str]
    names: list[str]
    carry: list[str]
    k: int
    gaps: bool
    boxed: DataFrame
    boxes: _Boxes
    sample: _Sample | None = None


def build_index(
    train: DataFrame,
    features: Sequence[str],
    key: str | Sequence[str],
    k: int,
    carry: Sequence[str] = (),
    gaps: bool = False,
    block_rows: int | None = None,
) -> Index:
    """Prepare a train table for searches of up to k neighbours. `gaps` allows missing feature values."""
    ensure_checkpoint_dir(train.sparkSession)
    features, carry = list(features), list(carry)
    names = [f"x{i}" for i in range(len(features))]
    first = Window.partitionBy("point").orderBy("train_key")
    points = (
        train.select(
            query_id(train, features).alias("point"), _train_key(key).alias("train_key"),
            *[number(train, f).alias(x) for f, x in zip(features, names)], *carry,
        )
        .withColumn("copy", F.row_number().over(first)).filter(F.col("copy") <= k).drop("copy", "point")
        .checkpoint()
    )
    if not gaps:
        refuse_gaps(points, names)
    if not gaps and len(names) >= PIVOT_FEATURES:
        block_rows = _planned_rows(points, block_rows)
        pivots = _pivots(points, names, block_rows)
        shelves = _shelves(pivots)
        boxed = _by_pivot(points, names, pivots, shelves).checkpoint()
        boxes = _collect_boxes(boxed, names, SHELF_ROWS, pivots, shelves)
        return Index(features, names, carry, k, gaps, boxed.drop(*[f"to_{m}" for m in METRICS]), boxes)
    if gaps:
        block_rows = block_rows or BLOCK_ROWS
        boxed = points.withColumn("box", _box_name(names, _slices(points, names, block_rows)))
        return Index(features, names, carry, k, gaps, boxed, _collect_boxes(boxed, names, block_rows))
    block_rows = _planned_rows(points, block_rows)
    boxed = points.withColumn("box", _box_number(_slices(points, names, block_rows, MAX_BOXES)))
    boxes = _collect_boxes(boxed, names, PART_BOXES * block_rows)
    return Index(features, names, carry, k, gaps, boxed, boxes, _sampled(points, names, boxes))


def _fold(gaps: np.ndarray, metric: str) -> np.ndarray:
    """Distance from per-feature gaps (last axis); missing gaps only occur with nan_euclidean."""
    if metric == "manhattan":
        return gaps.sum(axis=-1)
    if metric == "chebyshev":
        return gaps.max(axis=-1)
    if metric == "euclidean":
        return np.sqrt((gaps * gaps).sum(axis=-1))
    known = ~np.isnan(gaps)
    n = known.sum(axis=-1)
    total = np.where(known, gaps * gaps, 0.0).sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, np.sqrt(total * gaps.shape[-1] / n), np.inf)


def _bounds(x: np.ndarray, boxes: _Boxes, metric: str, some: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """Query-by-box tables: no row of the box is nearer, and none is farther."""
    low, high = boxes.low[some], boxes.high[some]
    nearest, farthest = np.empty((len(x), len(low))), np.empty((len(x), len(low)))
    step = max(1, 250_000 // max(1, low.size))
    for i in range(0, len(x), step):
        below, above = low[None] - x[i : i + step, None], x[i : i + step, None] - high[None]
        nearest[i : i + step] = _fold(np.maximum(np.maximum(below, above), 0.0), metric)
        farthest[i : i + step] = _fold(np.maximum(np.abs(below), np.abs(above)), metric)
    if boxes.pivots is not None:
        away, least, most = _distances(x, boxes.pivots[some], metric), boxes.least[metric][some], boxes.most[metric][some]
        nearest = np.maximum(nearest, np.maximum(away - most, least - away))
        farthest = np.minimum(farthest, away + most)
    return nearest, farthest


def _reachable(x: np.ndarray, need: np.ndarray | None, boxes: _Boxes, k: int, metric: str):
    """Query-by-box table of boxes that can hold one of the k nearest rows, and the distance limit."""
    nearest, farthest = _bounds(x, boxes, metric)
    usable = np.isfinite(nearest)
    if need is not None:
        usable &= boxes.present[:, need].T
    farthest = np.where(usable, farthest, np.inf)
    full = boxes.rows >= k
    if need is None and full.any():
        limit = farthest[:, full].min(axis=1) * (1 + 1e-9) + 1e-9
        return usable & (nearest <= limit[:, None]), limit
    order = np.argsort(farthest, axis=1, kind="stable")
    seen = np.cumsum(np.where(np.take_along_axis(usable, order, 1), boxes.rows[order], 0), axis=1)
    enough = seen >= k
    place = np.where(enough.any(axis=1), enough.argmax(axis=1), order.shape[1] - 1)
    limit = np.take_along_axis(farthest, np.take_along_axis(order, place[:, None], 1), 1)[:, 0]
    limit = np.where(enough.any(axis=1), limit * (1 + 1e-9) + 1e-9, np.inf)
    return usable & (nearest <= limit[:, None]), limit


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray, metric: str) -> np.ndarray:
    """Distance between a box and each of several."""
    return _fold(np.maximum(np.maximum(lows - high, low - highs), 0.0), metric)


def _near_boxes(x: np.ndarray, boxes: _Boxes, sample: _Sample, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, box) of the boxes that can hold one of the k nearest rows, and the distance limits. Queries are taken by cells."""
    limit, pairs = np.empty(len(x)), []
    for mine in _leaves(x, PLACE_CELL):
        for here in np.array_split(mine, -(-len(mine) // (4 * PLACE_CELL))):  # equal points are one cell
            q = x[here]
            low, high = q.min(axis=0), q.max(axis=0)
            limit[here] = far = sample.limits(q, low, high, k, metric)
            some = np.flatnonzero(_apart(low, high, boxes.low, boxes.high, metric) <= far.max())
            gaps = np.maximum(np.maximum(boxes.low[some][None] - q[:, None], q[:, None] - boxes.high[some][None]), 0.0)
            a, b = np.nonzero(_fold(gaps, metric) <= far[:, None])
            pairs.append((here[a], some[b]))
    q, b = (np.concatenate(part) for part in zip(*pairs))
    order = np.argsort(q, kind="stable")
    return q[order], b[order], limit


def _k_smallest(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) indices of the k smallest finite distances; ties go to the row that comes first."""
    if d.shape[1] > k:
        last = np.partition(d, k - 1, axis=1)[:, k - 1]
        q, r = np.nonzero((d <= last[:, None]) & np.isfinite(d))
    else:
        q, r = np.nonzero(np.isfinite(d))
    order = np.lexsort((r, d[q, r], q))
    q, r = q[order], r[order]
    first = np.searchsorted(q, np.arange(d.shape[0]))
    keep = np.arange(len(q)) - first[q] < k
    return q[keep], r[keep]


def _leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers in cells: halved at the median of the widest feature until small or equal."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        spread = np.ptp(x[rows], axis=0)
        j = int(spread.argmax())
        if len(rows) <= size or not spread[j] > 0:
            done.append(rows)
            continue
        half = len(rows) // 2
        cut = np.argpartition(x[rows, j], half)
        todo += [rows[cut[:half]], rows[cut[half:]]]
    return done


def _by_cells(q: np.ndarray, far: np.ndarray, r: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k nearest rows of every query within its limit; only cells within reach are compared."""
    cells = _leaves(r, CELL_ROWS)
    low, high = np.array([r[c].min(axis=0) for c in cells]), np.array([r[c].max(axis=0) for c in cells])
    sizes = np.array([len(c) for c in cells])
    found = []
    for mine in _leaves(q, CELL_ROWS):
        x, reach = q[mine], far[mine]
        away = _fold(np.maximum(np.maximum(low - x.max(axis=0), x.min(axis=0) - high), 0.0), metric)
        order = np.argsort(away, kind="stable")
        enough = int(np.searchsorted(np.cumsum(sizes[order]), k)) + 1
        rows = np.concatenate([cells[c] for c in order[:enough]])
        if len(rows) >= k:
            near = np.round(_distances(x, r[rows], metric), _DIGITS)
            reach = np.minimum(reach, np.partition(near, k - 1, axis=1)[:, k - 1])
        rest = order[enough:]
        rest = rest[away[rest] <= reach.max() * (1 + 1e-9) + 1e-9 + 10.0**-_DIGITS]
        # rows are numbered in the order of their keys, which decides ties
        rows = np.sort(np.concatenate([rows, *[cells[c] for c in rest]]))
        step = max(1, 2_000_000 // len(rows))
        for i in range(0, len(mine), step):
            here = mine[i : i + step]
            dist = np.round(_distances(q[here], r[rows], metric), _DIGITS)
            dist[dist > far[here][:, None]] = np.inf
            a, b = _k_smallest(dist, k)
            found.append((here[a], rows[b], dist[a, b]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _first_k(q: np.ndarray, row: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of every query, in order; ties go to the row that comes first."""
    order = np.lexsort((row, dist, q))
    q, row, dist = q[order], row[order], dist[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], row[keep], dist[keep]


def _tighter(reach: np.ndarray, q: np.ndarray, dist: np.ndarray, k: int) -> None:
    """Lower the limits of queries that have k rows to the distance of the last; the rows are those of `_first_k`."""
    last = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == k - 1)
    reach[q[last]] = np.minimum(reach[q[last]], dist[last])


def _paired(x: np.ndarray, r: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the pairs (x[a], r[b]), summed in the order of the features."""
    total = np.zeros(len(a))
    for i in range(0, len(a), PAIR_ROWS):
        gaps = np.ascontiguousarray((x[a[i : i + PAIR_ROWS]] - r[b[i : i + PAIR_ROWS]]).T)
        gaps *= gaps
        for gap in gaps:
            total[i : i + PAIR_ROWS] += gap
    return np.round(np.sqrt(total), _DIGITS)


def _close_pairs(
    xc: np.ndarray, x2: np.ndarray, right: np.ndarray, longest: float, reach: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of all pairs that can be among the k nearest within reach, from one matrix product in the precision of `right`.

    `right` holds the rows and their squared lengths, so the product is the squared distance less that of the query's length. It is off by
    `error` at most, whatever the order of its sums.
    """
    most = (np.sqrt(x2) + longest) ** 2
    error = (0.5 * float(np.finfo(right.dtype).eps) + 1e-13) * (xc.shape[1] + 16) * most + 1e-30
    slack = 2 * 10.0**-_DIGITS
    square = np.column_stack([-2.0 * xc, np.ones(len(xc))]).astype(right.dtype) @ right.T
    limit = np.minimum((reach + slack) ** 2, 1.01 * most) - x2 + error
    near = square <= limit.astype(right.dtype)[:, None]
    few = MANY_PAIRS * k * len(xc)
    if np.count_nonzero(near) > few and square.shape[1] > k:
        last = np.partition(square, k - 1, axis=1)[:, k - 1]
        last = (np.sqrt(np.maximum(last + error + x2, 0.0)) + slack) ** 2
        near = square <= np.minimum(limit, last - x2 + error).astype(right.dtype)[:, None]
    return np.divmod(np.flatnonzero(near), near.shape[1])


class _Rows:
    """Rows of a box, ready for matrix products."""

    def __init__(self, r: np.ndarray):
        self.r, self.middle = r, r.mean(axis=0)
        centred = r - self.middle
        self.square = (centred * centred).sum(axis=1)
        self.longest = float(np.sqrt(self.square.max()))
        # single precision where nothing can overflow or vanish
        self.single = np.column_stack([centred.astype(np.float32), self.square.astype(np.float32)]) if 1e-10 < self.longest < 1e10 else None

    def double(self, here: slice) -> np.ndarray:
        return np.column_stack([self.r[here] - self.middle, self.square[here]])


def _by_product(q: np.ndarray, far: np.ndarray, rows: _Rows | np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `_by_cells` for euclidean distances: squares from matrix products leave few rows, whose distances are then computed exactly.

    Blocks of queries and rows are small enough for the processor's cache, and what a block finds limits the next. Where single precision
    leaves too many rows, the block is done in double precision.
    """
    rows, found = rows if isinstance(rows, _Rows) else _Rows(rows), []
    for i in range(0, len(q), PRODUCT_QUERIES):
        x, reach = q[i : i + PRODUCT_QUERIES], far[i : i + PRODUCT_QUERIES].copy()
        xc = x - rows.middle
        x2 = (xc * xc).sum(axis=1)
        single = rows.single if x2.max() < 1e20 else None
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for j in range(0, len(rows.r), PRODUCT_ROWS):
            here = slice(j, j + PRODUCT_ROWS)
            if single is not None:
                a, b = _close_pairs(xc, x2, single[here], rows.longest, reach, k)
            if single is None or len(a) > 2 * MANY_PAIRS * k * len(x):
                a, b = _close_pairs(xc, x2, rows.double(here), rows.longest, reach, k)
            if not len(a):
                continue
            b += j
            exact = _paired(x, rows.r, a, b)
            there = exact <= reach[a]
            best = _first_k(*(np.concatenate([old, new[there]]) for old, new in zip(best, (a, b, exact))), k)
            _tighter(reach, best[0], best[2], k)
        found.append((best[0] + i, *best[1:]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _by_boxes(
    q: np.ndarray, far: np.ndarray, r: np.ndarray, box: np.ndarray, boxes: _Boxes, k: int, metric: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k nearest rows of every query within its limit, from rows of several boxes around pivots.

    Every query takes the boxes by their distance, and only those that can hold a row nearer than what it has.
    """
    there, place = np.unique(box, return_inverse=True)
    at = np.searchsorted(np.array(boxes.names), there)
    nearest, _ = _bounds(q, boxes, metric, at)
    order = np.argsort(nearest, axis=1, kind="stable")
    # rows are numbered in the order of their keys, which decides ties
    members = [np.flatnonzero(place == i) for i in range(len(there))]
    ready = [_Rows(r[m]) if metric == "euclidean" else r[m] for m in members]
    search = _by_product if metric == "euclidean" else lambda *given: _by_cells(*given, metric)
    reach, best = far.copy(), (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    for turn in order.T:
        gained = [best]
        for i, rows in enumerate(ready):
            mine = np.flatnonzero(turn == i)
            mine = mine[nearest[mine, i] <= reach[mine] * (1 + 1e-9) + 1e-9 + 10.0**-_DIGITS]
            if len(mine):
                a, b, dist = search(q[mine], reach[mine], rows, k)
                gained.append((mine[a], members[i][b], dist))
        best = _first_k(*(np.concatenate(part) for part in zip(*gained)), k)
        _tighter(reach, best[0], best[2], k)
    return best


def nearest_rows(
    index: Index,
    queries: DataFrame,
    k: int,
    metric: str = "euclidean",
    need: str | None = None,
    query_rows: int | None = None,
) -> DataFrame:
    """The k nearest train rows of every distinct query point: (query, [need,] place, distance, train_key, carry...).

    Distances are compared after rounding to nine digits, ties by train key. `need` names a query column with
    a feature number; only rows that have this feature count then, and its value is returned as `value`.
    """
    by = ["query", "need"] if need else ["query"]
    row = F.posexplode("near").alias("at", "row")
    names = {"distance": "d", "train_key": "t", **({"value": "v"} if need else {}), **{c: f"c{i}" for i, c in enumerate(index.carry)}}
    listed = nearest_lists(index, queries, k, metric, need, query_rows).select(*by, row)
    return listed.select(*by, *[F.col("row")[n].alias(c) for c, n in names.items()], (F.col("at") + 1).alias("place"))


def nearest_lists(
    index: Index,
    queries: DataFrame,
    k: int,
    metric: str = "euclidean",
    need: str | None = None,
    query_rows: int | None = None,
) -> DataFrame:
    """As `nearest_rows`, with a query's rows in order in an array `near` of (d: distance, t: train key, [v: value,] c0...: carried columns)."""
    if k > index.k:
        raise ValueError(f"the index keeps {index.k} rows per point, not {k}")
    features, names, carry, boxes = index.features, index.names, index.carry, index.boxes
    spark, d = queries.sparkSession, len(names)

    asked = queries.select(
        query_id(queries, features).alias("query"),
        *([F.col(need).cast("int").alias("need")] if need else []),
        *[number(queries, f).alias(n) for f, n in zip(features, names)],
    )
    by = ["query", "need"] if need else ["query"]
    asked = asked.groupBy(*by).agg(*[F.any_value(n).alias(n) for n in names])

    on_shelves = boxes.shelves is not None
    if on_shelves or not boxes.names:
        asked = asked.checkpoint()
        if not index.gaps:
            refuse_gaps(asked, names)
    query_rows = query_rows or (SHELF_QUERIES if on_shelves else QUERY_ROWS)
    spots = np.unique(boxes.shelves) if on_shelves else np.array(boxes.names, dtype=object)  # a shelf or box is a number, with gaps a name
    parts = boxes.parts[spots] if on_shelves else boxes.parts
    groups = ["shelf" if on_shelves else "box", "part", "salt"]
    spot = groups[0]
    limited = T.StructType([asked.schema[c] for c in by] + [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField("far", T.DoubleType())])
    schema = T.StructType([*limited.fields, index.boxed.schema[spot], T.StructField("part", T.LongType())])

    sample, box_names = index.sample, np.array(boxes.names, dtype=object if index.gaps else np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, 4_000_000 // max(1, len(boxes.names) * d))
        for pdf in _gathered(batches, 1 if sample is None else PLACE_ROWS):
            x = pdf[names].to_numpy(dtype=float)
            if sample is not None and not need and k <= len(sample.rows):
                known = np.flatnonzero(np.isfinite(x).all(axis=1))
                q, b, limit = np.arange(0), np.arange(0), np.full(len(x), np.nan)
                if len(known):
                    q, b, limit[known] = _near_boxes(x[known], boxes, sample, k, metric)
                    q = known[q]
                rest = np.setdiff1d(np.arange(len(x)), known)
            else:
                q, b, limit, rest = np.arange(0), np.arange(0), np.full(len(x), np.nan), np.arange(len(x))
            found = [(q, b)]
            for i in range(0, len(rest), step):
                some = rest[i : i + step]
                hit, limit[some] = _reachable(x[some], pdf["need"].to_numpy(dtype=int)[some] if need else None, boxes, k, metric)
                a, c = np.nonzero(hit)
                found.append((some[a], c))
            q, b = (np.concatenate(part) for part in zip(*found))
            order = np.argsort(q, kind="stable")
            lists = np.split(box_names[b[order]], np.searchsorted(q[order], np.arange(1, len(x))))
            yield pdf.assign(far=limit, boxes=lists)

    def shelve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_shelf = np.argsort(boxes.shelves, kind="stable")
        starts = np.searchsorted(boxes.shelves[of_shelf], spots)
        step = max(1, 4_000_000 // len(boxes.names))
        for batch in batches:
            for i in range(0, len(batch), step):
                pdf = batch.iloc[i : i + step]
                wanted = pdf["need"].to_numpy(dtype=int) if need else None
                hit, limit = _reachable(pdf[names].to_numpy(dtype=float), wanted, boxes, k, metric)
                hit = np.logical_or.reduceat(hit[:, of_shelf], starts, axis=1)
                yield pdf.assign(far=limit, shelves=[spots[row] for row in hit])

    part_of = _by_box({n: int(p) for n, p in zip(spots.tolist(), parts) if p > 1}, spot)
    if not boxes.names:
        routed = spark.createDataFrame([], schema)
    elif on_shelves:
        # a query leaves Python once, with the shelves that it goes to
        sent = asked.mapInPandas(shelve, T.StructType([*limited.fields, T.StructField("shelves", T.ArrayType(T.LongType()))])).checkpoint()
        sent = sent.withColumn("shelf", F.explode("shelves")).drop("shelves")
        routed = sent.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), part_of.cast("bigint") - 1)))
    else:
        kind = index.boxed.schema["box"].dataType
        sent = asked.mapInPandas(place, T.StructType([*limited.fields, T.StructField("boxes", T.ArrayType(kind))])).checkpoint()
        if not index.gaps:
            refuse_gaps(sent, names)
        routed = sent.withColumn("box", F.explode("boxes")).drop("boxes")
        routed = routed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), part_of.cast("bigint") - 1)))

    salts: dict = {}
    if boxes.names and sent.count() > query_rows:
        load = routed.groupBy(spot, "part").agg(F.count("*").alias("n")).groupBy(spot).agg(F.max("n").alias("n"))
        salts = {r[spot]: r["n"] // query_rows + 1 for r in load.collect() if r["n"] > query_rows}
    salt_of = _by_box(salts, spot)
    routed = routed.withColumn("salt", F.pmod(F.xxhash64("query"), salt_of).cast("int"))

    rows = (
        index.boxed
        .withColumn("part", F.pmod(F.xxhash64("train_key"), part_of).cast("bigint"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salt_of - 1)))
    )

    near_type = T.StructType([
        T.StructField("d", T.DoubleType()), T.StructField("t", rows.schema["train_key"].dataType), *([T.StructField("v", T.DoubleType())] if need else []),
        *[T.StructField(f"c{i}", rows.schema[c].dataType) for i, c in enumerate(carry)],
    ])
    found_schema = T.StructType([asked.schema[c] for c in by] + [T.StructField("near", T.ArrayType(near_type))])

    def matrix(table: pa.Table) -> np.ndarray:
        return np.stack([table[n].to_numpy() for n in names], axis=1).astype(float)

    def search(asked_here: pa.Table, rows_here: pa.Table) -> pa.Table:
        if not asked_here.num_rows or not rows_here.num_rows:
            q, t, dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        else:
            rows_here = rows_here.take(pc.sort_indices(rows_here, [("train_key", "ascending")])).combine_chunks()
            r, asked_at, far = matrix(rows_here), matrix(asked_here), asked_here["far"].to_numpy()
            wanted = asked_here["need"].to_numpy().astype(int) if need else None
            if not need and np.isfinite(r).all() and np.isfinite(asked_at).all():
                if on_shelves:
                    q, t, dist = _by_boxes(asked_at, far, r, rows_here["box"].to_numpy(), boxes, k, metric)
                else:
                    q, t, dist = _by_cells(asked_at, far, r, k, metric)
            else:
                step, parts_found = max(1, 2_000_000 // len(r)), []
                for i in range(0, len(asked_at), step):
                    some = np.round(_distances(asked_at[i : i + step], r, metric), _DIGITS)
                    some[some > far[i : i + step, None]] = np.inf
                    if need:
                        some[np.isnan(r[:, wanted[i : i + step]].T)] = np.inf
                    a, b = _k_smallest(some, k)
                    parts_found.append((a + i, b, some[a, b]))
                q, t, dist = (np.concatenate(part) for part in zip(*parts_found))
        # the rows of a query stand together
        starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
        taken = lambda table, c, at: table[c].combine_chunks().take(pa.array(at)) if table.num_rows else pa.array([], table.schema.field(c).type)
        values = [pa.array(dist), taken(rows_here, "train_key", t), *([pa.array(r[t, wanted[q]] if len(q) else dist)] if need else []), *[taken(rows_here, c, t) for c in carry]]
        listed = to_arrow_type(found_schema["near"].dataType)
        fields = [pa.field(f.name, v.type, f.nullable) for f, v in zip(listed.value_type, values)]
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(q)), pa.int32()), pa.StructArray.from_arrays(values, fields=fields))
        return pa.table({**{c: taken(asked_here, c, q[starts]) for c in by}, "near": lists})

    held = int(sum(p * salts.get(s, 1) for s, p in zip(spots.tolist(), parts)))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(20_000, 2 * held if on_shelves else int(parts.sum()) // 4))
    found = (
        routed.repartition(n, *groups).groupBy(*groups)
        .cogroup(rows.repartition(n, *groups).groupBy(*groups))
        .applyInArrow(search, found_schema)
    )
    lists = found.groupBy(*by).agg(F.collect_list("near").alias("lists"))
    merged = F.when(F.size("lists") == 1, F.get("lists", F.lit(0))).otherwise(F.slice(F.array_sort(F.flatten("lists")), 1, k))
    return lists.select(*by, merged.alias("near"))


def boxes_searched(index: Index, queries: DataFrame, k: int, metric: str = "euclidean") -> DataFrame:
    """(query, boxes): to how many boxes each distinct query point is sent, of `len(index.boxes.names)`."""
    names, boxes = index.names, index.boxes
    asked = queries.select(query_id(queries, index.features).alias("query"), *[number(queries, f).alias(n) for f, n in zip(index.features, names)])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hit, _ = _reachable(pdf[names].to_numpy(dtype=float), None, boxes, k, metric)
            yield pd.DataFrame({"query": pdf["query"], "boxes": hit.sum(axis=1)})

    return asked.dropDuplicates(["query"]).mapInPandas(count, "query string, boxes long")


def _by_box(values: dict, box: str) -> Column:
    """The value of the row's box (or shelf), 1 where it has none."""
    if not values:
        return F.lit(1)
    if all(isinstance(v, int) for v in values):  # a map would be searched from its start for every row
        return F.coalesce(F.get(F.array(*[F.lit(values.get(i, 1)) for i in range(max(values) + 1)]), F.col(box).cast("int")), F.lit(1))
    table = F.create_map(*[F.lit(v) for pair in sorted(values.items()) for v in pair])
    return F.coalesce(F.element_at(table, F.col(box)), F.lit(1))


def _gathered(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The same rows in larger batches."""
    held = []
    for batch in batches:
        held += [batch] if len(batch) else []
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _distances(q: np.ndarray, r: np.ndarray, metric: str) -> np.ndarray:
    """Distances of all query points of a group to all its rows, feature by feature."""
    total = np.zeros((len(q), len(r)))
    known = np.zeros((len(q), len(r)), dtype=np.int32) if metric == "nan_euclidean" else None
    for j in range(q.shape[1]):
        gap = np.abs(q[:, j, None] - r[None, :, j])
        if metric == "manhattan":
            total += gap
        elif metric == "chebyshev":
            np.maximum(total, gap, out=total)
        elif metric == "euclidean":
            total += gap * gap
        else:
            there = ~np.isnan(gap)
            known += there
            total += np.where(there, gap * gap, 0.0)
    if metric == "euclidean":
        return np.sqrt(total)
    if metric == "nan_euclidean":
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(known > 0, np.sqrt(total * q.shape[1] / known), np.inf)
    return total


def _vote(labels: Column, k: int) -> Column:
    """Most frequent of the first k labels, the smallest on a tie."""
    near = F.slice(labels, 1, k)
    ranked = F.transform(
        F.array_distinct(near),
        lambda v: F.struct((-F.size(F.filter(near, lambda w: w == v))).alias("votes"), v.alias("label")),
    )
    return F.array_min(ranked)["label"]


def knn_votes(index: Index, test: DataFrame, target: str, ks: Sequence[int], metric: str = "euclidean", **limits: int) -> DataFrame:
    """(query, k, p): the prediction of every distinct test point for every k, from one neighbour search."""
    label = f"c{index.carry.index(target)}"
    labels = nearest_lists(index, test, max(ks), metric, **limits).select("query", F.transform("near", lambda s: s[label]).alias("labels"))
    votes = F.array(*[F.struct(F.lit(k).alias("k"), _vote(F.col("labels"), k).alias("p")) for k in ks])
    return labels.select("query", F.inline(votes))


def knn_predict(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    target: str,
    key: str | Sequence[str],
    k: int = 5,
    metric: str = "euclidean",
    name: str = "prediction",
    **limits: int,
) -> DataFrame:
    """Test rows with the uniform vote of their k nearest train rows."""
    index = build_index(train, features, key, k, [target])
    votes = knn_votes(index, test, target, [k], metric, **limits)
    return (
        test.withColumn("query", query_id(test, features))
        .join(votes.select("query", F.col("p").alias(name)), "query", "left").drop("query")
    )


def knn_label_counts(
    index: Index, test: DataFrame, target: str, ks: Sequence[int], metric: str = "euclidean", **limits: int
) -> DataFrame:
    """(k, y, p, n) on the test rows. Test rows are counted per point before they meet the predictions."""
    votes = knn_votes(index, test, target, ks, metric, **limits)
    query = query_id(test, index.features).alias("query")
    points = test.groupBy(query, F.col(target).alias("y")).agg(F.count("*").alias("n"))
    return points.join(votes, "query").groupBy("k", "y", "p").agg(F.sum("n").alias("n"))


def fill_from_neighbours(df: DataFrame, key: str | Sequence[str], neighbours: int = 5, **limits: int) -> DataFrame:
    """Fill missing numbers with the plain mean of the nearest rows that have the value.

    Distances use the features present in both rows, scaled up to all features. Only incomplete rows are
    searched and joined; complete rows pass through. A value without any comparable row gets the column mean.
    """
    keys = key_list(key)
    features = [c for c in df.columns if c not in keys]
    holes = F.array(*[F.when(number(df, f).isNull(), F.lit(i)) for i, f in enumerate(features)])
    marked = df.withColumn("_holes", F.filter(holes, lambda h: h.isNotNull()))
    asked = marked.filter(F.size("_holes") > 0)
    queries = asked.select(*features, F.explode("_holes").alias("_need"))
    index = build_index(df, features, key, neighbours, gaps=True)
    near = nearest_rows(index, queries, neighbours, "nan_euclidean", need="_need", **limits)
    values = near.groupBy("query", "need").agg(F.avg("value").alias("v"))
    wide = values.groupBy("query").agg(
        *[F.max(F.when(F.col("need") == i, F.col("v"))).alias(f"_v{i}") for i in range(len(features))]
    )
    means = df.agg(*[F.avg(number(df, f)).alias(f) for f in features]).first()
    filled = asked.withColumn("query", query_id(df, features)).join(wide, "query", "left")
    filled = filled.select(
        *keys,
        *[
            F.coalesce(number(df, f), F.col(f"_v{i}"), F.lit(means[f]).cast("double")).alias(f)
            for i, f in enumerate(features)
        ],
    )
    whole = marked.filter(F.size("_holes") == 0).select(*keys, *[number(df, f).alias(f) for f in features])
    return whole.unionByName(filled)
