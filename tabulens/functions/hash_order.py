"""Exact, reproducible "first k rows in hash order", overall or per class.

The hash of a key is uniform, so the k-th smallest of n hashes lies within a few standard deviations
(about sqrt(n) rows) of k/n. Only the rows inside that narrow band are ordered; everything below is only
counted. The band is checked against the counts. Where it misses (the rows left by an earlier split have no small hashes), rows are
counted by the leading digits of their hashes until few are in question, so the result is always exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulens.functions.columns import key_hash, key_text

HASH_DIGITS = 15
MD5_DIGITS = 32
#: Rows of a class that are ordered after a miss, and counts that reach the driver at once.
BAND_ROWS = 50_000
MAX_COUNTS = 65_536
MAX_CLASSES = 1_000
_NO_CLASS = "<missing>"


def class_text(by: str | None) -> Column:
    return F.lit("") if by is None else F.coalesce(F.col(by).cast("string"), F.lit(_NO_CLASS))


def class_sizes(df: DataFrame, by: str | None) -> dict[str, int]:
    """Rows per class; refuses targets that are not classes at all."""
    grouped = df.groupBy(class_text(by).alias("c")).count()
    rows = grouped.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{by}' has more than {MAX_CLASSES} classes; it cannot be used to stratify")
    return {r["c"]: r["count"] for r in rows}


def _per_class(classes: Column, values: dict[str, object]) -> Column:
    if len(values) == 1:
        (only,) = values.values()
        return F.lit(only)
    entries = [F.lit(x) for pair in sorted(values.items()) for x in pair]
    return F.element_at(F.create_map(*entries), classes)


def hash_at(share: float) -> str:
    """The hex text below which this share of all hashes lies."""
    if share >= 1:
        return "g"
    return format(int(max(0.0, share) * 16**HASH_DIGITS), f"0{HASH_DIGITS}x")


def hash_cutoffs(
    df: DataFrame,
    key: str | Sequence[str],
    quotas: dict[str, int],
    sizes: dict[str, int],
    by: str | None,
    seed: int,
) -> dict[str, tuple[str, str]]:
    """(hash, key) of the last row of each class that belongs to its quota.

    One pass per try: rows below the band shrink to one counted group per class before the shuffle, so only
    the band itself is ordered.
    """
    slim = df.select(class_text(by).alias("c"), key_hash(key, seed).alias("h"), key_text(key).alias("k"))
    open_classes = {c: q for c, q in quotas.items() if q > 0}
    if not open_classes:
        return {}
    spread = {c: (6.0 * math.sqrt(sizes[c]) + 50) / sizes[c] for c in open_classes}
    low = _per_class(F.col("c"), {c: hash_at(q / sizes[c] - spread[c]) for c, q in open_classes.items()})
    high = _per_class(F.col("c"), {c: hash_at(q / sizes[c] + spread[c]) for c, q in open_classes.items()})
    rows = slim.filter(F.col("c").isin(list(open_classes))).filter(F.col("h") <= high)
    found = _last_within(rows, F.col("h") < low, open_classes)
    missed = {c: q for c, q in open_classes.items() if c not in found}
    if missed:
        found.update(_cutoffs_by_digits(slim, missed))
    if len(found) < len(open_classes):
        raise ValueError(f"the key {key!r} repeats or is null where the quota ends; add columns that make it unique")
    return found


def _last_within(rows: DataFrame, below: Column, quotas: dict[str, int]) -> dict[str, tuple[str, str]]:
    """(hash, key) of the row that fills the quota of its class; rows below the band are only counted."""
    counted = (
        rows.select("c", F.when(below, "").otherwise(F.col("h")).alias("h"), F.when(below, "").otherwise(F.col("k")).alias("k"))
        .groupBy("c", "h", "k").agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("c").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, 0)
    cut = counted.withColumn("upto", F.sum("n").over(order)).filter((F.col("upto") == _per_class(F.col("c"), quotas)) & (F.col("h") != ""))
    return {r["c"]: (r["h"], r["k"]) for r in cut.collect()}


def _cutoffs_by_digits(slim: DataFrame, quotas: dict[str, int], band_rows: int = BAND_ROWS) -> dict[str, tuple[str, str]]:
    """As `_last_within`, for hashes in any distribution: the digits of the last hash are found by counting, some digits a pass."""
    prefix, left, wide = dict.fromkeys(quotas, ""), dict(quotas), set(quotas)
    while wide:
        digits = max(1, int(math.log(MAX_COUNTS / len(wide), 16) + 1e-9))
        rows = slim.filter(F.col("c").isin(list(wide)))
        start = _per_class(F.col("c"), {c: prefix[c] for c in wide})
        counts: dict[str, list] = {c: [] for c in wide}
        for r in rows.filter(F.startswith("h", start)).groupBy("c", F.substr("h", F.length(start) + 1, F.lit(digits)).alias("d")).count().collect():
            counts[r["c"]].append((r["d"], r["count"]))
        for c in list(wide):
            for d, n in sorted(counts[c]):
                if left[c] <= n:
                    prefix[c] += d
                    if n <= band_rows or len(prefix[c]) >= MD5_DIGITS:
                        wide.discard(c)
                    break
                left[c] -= n
            else:
                raise ValueError("a class has fewer rows than its quota")
    start = _per_class(F.col("c"), prefix)
    return _last_within(slim.filter(F.col("c").isin(list(quotas))).filter(F.startswith("h", start)), F.lit(False), left)


def within_quota(
    key: str | Sequence[str], cutoffs: dict[str, tuple[str, str]], by: str | None, seed: int
) -> Column:
    """True for the rows at or before the cutoff of their class; classes without a cutoff have none."""
    if not cutoffs:
        return F.lit(False)
    c = class_text(by)
    h, k = key_hash(key, seed), key_text(key)
    last_h = _per_class(c, {n: v[0] for n, v in cutoffs.items()})
    last_k = _per_class(c, {n: v[1] for n, v in cutoffs.items()})
    inside = (h < last_h) | ((h == last_h) & (k <= last_k))
    return F.coalesce(c.isin(list(cutoffs)) & inside, F.lit(False))


def share_quotas(sizes: dict[str, int], total: int) -> dict[str, int]:
    """Split `total` over the classes in proportion to their sizes, largest remainder first."""
    n = sum(sizes.values())
    quotas = {c: size * total // n for c, size in sizes.items()}
    by_remainder = sorted(sizes, key=lambda c: (-(sizes[c] * total % n), c))
    for c in by_remainder[: total - sum(quotas.values())]:
        quotas[c] += 1
    return quotas
