"""Correlation and pairwise density of numeric variables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabulens.functions.columns import chunks, columns_of, number
from tabulens.operators.distribution import Bins, bin_number, summarise
from tabulens.operators.project import drop_incomplete_rows

_PAIRS_PER_JOB = 80
_GAP_PAIRS_PER_JOB = 9
_COLUMNS_PER_JOB = 30
#: Columns whose products one task sums (four matrices of doubles), and rows multiplied at a time.
_GRAM_COLUMNS = 1_024
_GRAM_ROWS = 2_048


def _correlation(a: Column, b: Column) -> Column:
    # Rows that lack either value do not count; `corr` itself raises on a constant column in ANSI mode.
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


@dataclass
class Moments:
    """Rows of the table, and of a column its values, their mean, smallest and largest."""

    rows: int
    count: dict[str, int]
    mean: dict[str, float]
    constant: set[str]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, _GRAM_ROWS):
            yield np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.slice(at, _GRAM_ROWS).columns])


def _numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[number(df, c).alias(f"c{i}") for i, c in enumerate(names)])


def _wide_moments(df: DataFrame, names: Sequence[str]) -> list:
    """(i, rows, n, m, a, b) of all columns in one scan, summed by task in numpy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n, total = 0, np.zeros(len(names), np.int64), np.zeros(len(names))
        low, high = np.full(len(names), np.inf), np.full(len(names), -np.inf)
        for x in _matrices(batches):
            there = ~np.isnan(x)
            rows += len(x)
            n += there.sum(axis=0)
            total += np.where(there, x, 0.0).sum(axis=0)
            low = np.minimum(low, np.where(there, x, np.inf).min(axis=0))
            high = np.maximum(high, np.where(there, x, -np.inf).max(axis=0))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (np.arange(len(names)), np.full(len(names), rows), n, total, low, high)], ["i", "rows", "n", "m", "a", "b"]
            )

    sums = _numbers(df, names).mapInArrow(run, "i long, rows long, n long, m double, a double, b double")
    mean = F.try_divide(F.sum("m"), F.sum("n")).alias("m")
    return sums.groupBy("i").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), mean, F.min("a").alias("a"), F.max("b").alias("b")).collect()


def moments(df: DataFrame, names: Sequence[str]) -> Moments:
    """One scan: as an aggregate where the columns fit into one, else in numpy."""
    names = list(names)
    if len(names) > _COLUMNS_PER_JOB:
        found = {names[r["i"]]: r for r in _wide_moments(df, names)}
        rows = max((r["rows"] for r in found.values()), default=0)
        values = {c: (r["n"], r["m"], r["a"], r["b"]) for c, r in found.items()}
    else:
        row = df.agg(F.count(F.lit(1)).alias("rows"), *[f(number(df, c)).alias(f"{p}{i}") for i, c in enumerate(names) for p, f in (("n", F.count), ("m", F.avg), ("a", F.min), ("b", F.max))]).first()
        rows = row["rows"]
        values = {c: tuple(row[f"{p}{i}"] for p in "nmab") for i, c in enumerate(names)}
    empty = (0, None, None, None)
    values = {c: values[c] if c in values and values[c][0] else empty for c in names}
    # the mean of equal values need not be that value
    return Moments(rows, {c: v[0] for c, v in values.items()}, {c: v[1] for c, v in values.items()}, {c for c, v in values.items() if v[2] == v[3]})


def _products(df: DataFrame, left: Sequence[str], right: Sequence[str], known: Moments) -> dict[tuple[str, str], tuple]:
    """Sums over the rows that have both columns, of values less their means, for pairs of a left and a right column (or of the left ones).

    Every task sums Gram matrices of its rows and of the places that hold values; matching cells are then summed by Spark.
    """
    names = [*left, *right]
    means = np.array([known.mean[c] or 0.0 for c in names])
    first, second = np.triu_indices(len(left), 1) if not right else (np.repeat(np.arange(len(left)), len(right)), np.tile(np.arange(len(left), len(names)), len(left)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, xy, x, xx = (np.zeros((len(names), len(names))) for _ in range(4))
        for v in _matrices(batches):
            v = v - means
            there = (~np.isnan(v)).astype(float)
            v[there == 0] = 0.0
            n += there.T @ there
            xy += v.T @ v
            x += v.T @ there
            xx += (v * v).T @ there
        cells = [first, second, n[first, second], xy[first, second], x[first, second], x[second, first], xx[first, second], xx[second, first]]
        for at in range(0, len(first) if n.any() else 0, 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in cells], ["i", "j", *fields])

    fields = ["n", "xy", "x", "y", "xx", "yy"]
    sums = _numbers(df, names).mapInArrow(run, "i long, j long, " + ", ".join(f"{f} double" for f in fields))
    found = sums.groupBy("i", "j").agg(*[F.sum(f).alias(f) for f in fields])
    return {(names[r["i"]], names[r["j"]]): tuple(r[f] for f in fields) for r in found.toLocalIterator()}


def _wide_pairs(df: DataFrame, names: Sequence[str], known: Moments) -> dict[tuple[str, str], float | None]:
    """All pairs in one scan up to _GRAM_COLUMNS columns, beyond that one per pair of column blocks.

    A spread below 1e-13 of the squares it comes from is that of a constant: the sums hold no more digits.
    """
    blocks = list(chunks(list(names), _GRAM_COLUMNS if len(names) <= _GRAM_COLUMNS else _GRAM_COLUMNS // 2))
    result: dict[tuple[str, str], float | None] = dict.fromkeys(combinations(names, 2))
    for i, left in enumerate(blocks):
        for right in [[], *blocks[i + 1 :]]:
            for pair, (n, xy, x, y, xx, yy) in _products(df, left, right, known).items():
                if n and not known.constant.intersection(pair):
                    a, b = xx - x * x / n, yy - y * y / n
                    if a > 1e-13 * xx and b > 1e-13 * yy:
                        result[pair] = min(1.0, abs(xy - x * y / n) / (math.sqrt(a) * math.sqrt(b)))
    return result


def correlation_pairs(df: DataFrame, names: Sequence[str], known: Moments | None = None) -> dict[tuple[str, str], float | None]:
    """Absolute Pearson correlation of every pair i < j; None where a column is constant.

    Values are centred by the means of a first scan. Pairs with missing values use the rows that have both. Where all sums fit into one
    aggregate it makes the second scan, else Gram matrices do.
    """
    names, result = list(names), {}
    known = known or moments(df, names)
    whole = [c for c in names if known.rows and known.count[c] == known.rows]
    sums = [(c, c) for c in whole] + list(combinations(whole, 2))
    rest = [(a, b) for a, b in combinations(names, 2) if known.count[a] < known.rows or known.count[b] < known.rows]
    if len(sums) > _PAIRS_PER_JOB or len(rest) > _GAP_PAIRS_PER_JOB:
        return _wide_pairs(df, names, known)
    if sums:
        centred = {c: number(df, c) - F.lit(known.mean[c]) for c in whole}
        row = df.agg(*[F.sum(centred[a] * centred[b]).alias(f"s{i}") for i, (a, b) in enumerate(sums)]).first()
        products = {pair: row[f"s{i}"] for i, pair in enumerate(sums)}
    for a, b in combinations(whole, 2):
        spread = math.sqrt(products[(a, a)]) * math.sqrt(products[(b, b)])
        result[(a, b)] = min(1.0, abs(products[(a, b)]) / spread) if spread > 0 and not {a, b} & known.constant else None
    if rest:
        row = df.agg(*[F.abs(_correlation(number(df, a), number(df, b))).alias(f"r{i}") for i, (a, b) in enumerate(rest)]).first()
        result.update({pair: row[f"r{i}"] for i, pair in enumerate(rest)})
    return {pair: result.get(pair) for pair in combinations(names, 2)}


def correlation_matrix(df: DataFrame, names: Sequence[str] | None = None, drop_incomplete: bool = True) -> DataFrame:
    """(v1, v2, r) for all ordered pairs after dropping incomplete rows; constants give NULL."""
    if names is None:
        names = columns_of(df, "number", "bool")
    rows = drop_incomplete_rows(df) if drop_incomplete else df
    known = moments(rows, names)
    pairs = correlation_pairs(rows, names, known)
    table = []
    for a in names:
        for b in names:
            if a == b:
                r = 1.0 if known.count[a] and a not in known.constant else None
            else:
                r = pairs[(a, b)] if (a, b) in pairs else pairs[(b, a)]
            table.append((a, b, r))
    return df.sparkSession.createDataFrame(table, "v1 string, v2 string, r double")


def study_pairs(names: Sequence[str], chunk_size: int | None = None):
    """Pairs i < j; on demand only those of the same chunk of names."""
    return [p for part in chunks(list(names), chunk_size or len(names)) for p in combinations(part, 2)]


def pair_density(
    df: DataFrame,
    names: Sequence[str] | None = None,
    target: str | None = None,
    bins: int = 10,
    drop_incomplete: bool = True,
    chunk_size: int | None = None,
) -> DataFrame:
    """Rows per cell of a bins x bins grid for every variable pair, and per class when a target is given.

    The binned form of a scatter plot: one pass, whose map-side aggregation leaves at most
    pairs x cells x classes rows per task to shuffle.
    """
    rows = drop_incomplete_rows(df) if drop_incomplete else df
    if names is None:
        names = columns_of(df, "number")
    names = [c for c in names if c != target]
    if len(names) < 2:
        raise ValueError("a pair study needs at least two numeric variables")
    places = {}
    for c, s in summarise(rows, names, quartiles=False).items():
        places[c] = bin_number(number(rows, c), Bins(s.low, s.high, bins)) if s.n and s.low != s.high else F.lit(0).cast("bigint")
    binned = rows.select(
        *([F.col(target).cast("string").alias("class")] if target else []), *[p.alias(f"_b_{c}") for c, p in places.items()]
    )
    by = ["class"] if target else []
    result = None
    pairs = study_pairs(names, chunk_size)
    for part in chunks(pairs, 200):
        entries = [
            F.struct(F.lit(a).alias("v1"), F.lit(b).alias("v2"), F.col(f"`_b_{a}`").alias("bx"), F.col(f"`_b_{b}`").alias("by"))
            for a, b in part
        ]
        counted = (
            binned.select(*by, F.inline(F.array(*entries)))
            .groupBy("v1", "v2", *by, "bx", "by").agg(F.count("*").alias("n"))
        )
        result = counted if result is None else result.unionAll(counted)
    return result


def pair_occupancy(density: DataFrame, bins: int = 10) -> DataFrame:
    """Share of non-empty grid cells per pair (and class)."""
    by = [c for c in ("v1", "v2", "class") if c in density.columns]
    return density.groupBy(*by).agg(F.count("*").alias("cells"), F.sum("n").alias("n")).withColumn(
        "occupancy", F.col("cells") / F.lit(float(bins * bins))
    )
