"""Exact order statistics without sorting the table in one place.

Each round narrows every wanted rank to the values strictly between two cut points. The cut points come
from the quantile sketch of a row sample; the decision comes from exact counts over all rows, so the result
is exact whatever the sample was, and no task ever holds more than FETCH_LIMIT values. A value that fills
many rows becomes a cut point and is answered by its count. A round costs two scans of the wanted columns
and leaves about one row in a thousand, so ten billion rows take three rounds. Tables of a bounded size are
kept in memory during the rounds, and spread over the cores when they come from few files.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from tabulens.functions.columns import chunks

FETCH_LIMIT = 200_000
SKETCH_ACCURACY = 5_000
SAMPLE_SHARE = 0.05
SAMPLE_MIN = 50_000
SAMPLE_MAX = 10_000_000
# Wider aggregates than this leave whole-stage code generation.
_COUNTS_PER_JOB = 60
_BRACKETS_PER_JOB = 12
# Tables up to HELD_CELLS values are kept in memory during the rounds (tiny ones are not worth it).
SPREAD_CELLS = 500_000
HELD_CELLS = 50_000_000


@dataclass
class _Bracket:
    """Values of column `name` strictly between `low` and `high`; `below` values are <= low."""

    name: str
    ranks: list[int]
    low: object
    high: object
    below: int
    inside: int

    def test(self) -> str:
        """SQL text that is true for the values inside."""
        parts = [f"{self.name} IS NOT NULL"]
        if self.low is not None:
            parts.append(f"{self.name} > {_literal(self.low)}")
        if self.high is not None:
            parts.append(f"{self.name} < {_literal(self.high)}")
        return "(" + " AND ".join(parts) + ")"

    def values(self) -> str:
        return f"IF({self.test()}, {self.name}, NULL)"


def _literal(v: object) -> str:
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{v}L" if isinstance(v, int) else f"CAST('{v!r}' AS DOUBLE)"


@contextmanager
def _held(df: DataFrame, cells: int) -> Iterator[DataFrame]:
    """The table itself, or a kept copy when it is small enough to keep."""
    if not SPREAD_CELLS < cells <= HELD_CELLS:
        yield df
        return
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def order_statistics(
    df: DataFrame,
    columns: dict[str, Column],
    counts: dict[str, int],
    ranks: dict[str, Sequence[int]],
    fetch_limit: int | None = None,
) -> dict[str, dict[int, object]]:
    """Values at zero-based `ranks` of the sorted non-null values; `counts` are the non-null counts."""
    limit = fetch_limit or FETCH_LIMIT
    answers: dict[str, dict[int, object]] = {n: {} for n in columns}
    alias = {n: f"v{i}" for i, n in enumerate(columns)}
    work = [
        _Bracket(alias[n], sorted({r for r in ranks.get(n, []) if 0 <= r < counts[n]}), None, None, 0, counts[n])
        for n in columns
    ]
    work = [b for b in work if b.ranks]
    slim = df.select(*[c.alias(alias[n]) for n, c in columns.items()])
    found: dict[str, dict[int, object]] = {alias[n]: answers[n] for n in columns}
    with _held(slim, len(work) * max([counts[n] for n in columns], default=0)) as rows:
        while work:
            following: list[_Bracket] = []
            for part in chunks(work, _BRACKETS_PER_JOB):
                following += _narrow(rows, part, found, limit)
            work = following
    return answers


def _narrow(df, brackets, answers, limit) -> list[_Bracket]:
    small = [b for b in brackets if b.inside <= limit]
    large = [b for b in brackets if b.inside > limit]
    if small:
        rows = df.filter(" OR ".join(b.test() for b in small))
        ordered = rows.agg(*[F.expr(f"sort_array(collect_list({b.values()}))").alias(f"o{i}") for i, b in enumerate(small)])
        found = ordered.select(
            *[F.expr("array(" + ", ".join(f"get(o{i}, {r - b.below})" for r in b.ranks) + ")").alias(f"b{i}") for i, b in enumerate(small)]
        ).first()
        for i, b in enumerate(small):
            answers[b.name].update(zip(b.ranks, found[f"b{i}"]))
    return _split(df, large, answers) if large else []


def _cut_points(df, brackets) -> list[list]:
    """Two cut points around every wanted rank, from a sample that is about ten million values at most."""
    rows = max(b.inside for b in brackets)
    share = min(1.0, max(SAMPLE_MIN, min(SAMPLE_MAX, rows * SAMPLE_SHARE)) / min(b.inside for b in brackets))
    sampled = df.sample(share, seed=1) if share < 1.0 else df
    slack = 2.0 / SKETCH_ACCURACY + (2.5 / math.sqrt(share * min(b.inside for b in brackets)) if share < 1.0 else 0.0)
    sketches = []
    for i, b in enumerate(brackets):
        places = set()
        for r in b.ranks:
            at = (r - b.below) / b.inside
            places |= {max(0.0, at - slack), min(1.0, at + slack)}
        wanted = ", ".join(f"{p!r}D" for p in _thinned(sorted(places)))
        sketches.append(F.expr(f"percentile_approx({b.values()}, array({wanted}), {SKETCH_ACCURACY})").alias(f"b{i}"))
    found = sampled.agg(*sketches).first()
    return [sorted(set(found[f"b{i}"] or [])) for i in range(len(brackets))]


def _thinned(places: list[float]) -> list[float]:
    """Drop places that are as good as the one before (the two ranks of one quantile share their cut points)."""
    kept: list[float] = []
    for p in places:
        if not kept or p - kept[-1] > 1e-4:
            kept.append(p)
    return kept


def _split(df, brackets, answers) -> list[_Bracket]:
    wide = list(zip(brackets, _cut_points(df, brackets)))
    aggregates = []
    for i, (b, cuts) in enumerate(wide):
        for j, cut in enumerate(cuts):
            aggregates += [
                F.expr(f"count_if({b.values()} < {_literal(cut)})").alias(f"lt_{i}_{j}"),
                F.expr(f"count_if({b.values()} = {_literal(cut)})").alias(f"eq_{i}_{j}"),
            ]
    counted: dict[str, int] = {}
    for part in chunks(aggregates, _COUNTS_PER_JOB):
        counted.update(df.agg(*part).first().asDict())

    following = []
    for i, (b, cuts) in enumerate(wide):
        start, low = b.below, b.low
        steps = [(counted[f"lt_{i}_{j}"], counted[f"eq_{i}_{j}"], c) for j, c in enumerate(cuts)]
        steps.append((b.inside, 0, b.high))
        for lower, equal, cut in steps:
            end = b.below + lower
            between = [r for r in b.ranks if start <= r < end]
            if between:
                following.append(_Bracket(b.name, between, low, cut, start, end - start))
            answers[b.name].update({r: cut for r in b.ranks if end <= r < end + equal})
            start, low = end + equal, cut
    return following


def quantile_ranks(n: int, share: float) -> tuple[int, int, float]:
    """Lower rank, upper rank and weight of the linear-interpolation quantile."""
    position = share * (n - 1)
    lower = math.floor(position)
    return lower, min(lower + 1, n - 1), position - lower


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    counts: dict[str, int],
    shares: Sequence[float] = (0.25, 0.5, 0.75),
    fetch_limit: int | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, per column, None for an empty column."""
    ranks = {
        n: [r for s in shares for r in quantile_ranks(counts[n], s)[:2]] if counts[n] else []
        for n in columns
    }
    at = order_statistics(df, columns, counts, ranks, fetch_limit)
    result: dict[str, list[float | None]] = {}
    for n in columns:
        row: list[float | None] = []
        for s in shares:
            if not counts[n]:
                row.append(None)
                continue
            lower, upper, weight = quantile_ranks(counts[n], s)
            a, b = at[n][lower], at[n][upper]
            row.append(a if a == b else a + (b - a) * weight)
        result[n] = row
    return result


def kth_row(df: DataFrame, order: Sequence[Column], k: int, fetch_limit: int | None = None) -> tuple | None:
    """The sort values of the k-th row (one-based) in the order of `order`, compared left to right.

    Each column is searched only among the rows that tie on the columns before it. NULLs are not expected.
    """
    rows, found, rank = df, [], k - 1
    for c in order:
        n = rows.agg(F.count(c)).first()[0]
        if rank < 0 or rank >= n:
            return None
        cut = order_statistics(rows, {"v": c}, {"v": n}, {"v": [rank]}, fetch_limit)["v"][rank]
        found.append(cut)
        rank -= rows.agg(F.count_if(c < F.lit(cut))).first()[0]
        rows = rows.filter(c == F.lit(cut))
    return tuple(found)


def not_after(order: Sequence[Column], cut: Sequence[object]) -> Column:
    """True for rows whose sort values are at or before `cut`."""
    result = F.lit(True)
    for c, v in reversed(list(zip(order, cut))):
        result = (c < F.lit(v)) | ((c == F.lit(v)) & result)
    return result
