"""Samples and splits that give the same rows on every run and every partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabulens.fixed_values import FIT_ROWS, SEED, TEST_SHARE
from tabulens.functions.columns import key_hash, key_list
from tabulens.functions.hash_order import class_sizes, hash_at, hash_cutoffs, share_quotas, within_quota
from tabulens.functions.order_statistics import kth_row, not_after


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int, seed: int = SEED) -> DataFrame:
    """Exactly n rows without replacement (all rows when there are fewer)."""
    sizes = class_sizes(df, None)
    total = sizes.get("", 0)
    if n >= total:
        return df
    cutoffs = hash_cutoffs(df, key, {"": n}, sizes, None, seed)
    return df.filter(within_quota(key, cutoffs, None, seed))


def sample_fraction(
    df: DataFrame, key: str | Sequence[str], fraction: float, seed: int = SEED, exact: bool = True
) -> DataFrame:
    """round(fraction * n) rows; `exact=False` is one narrow filter whose size is only about right."""
    if not exact:
        return df.filter(key_hash(key, seed) < F.lit(hash_at(fraction)))
    return sample_rows(df, key, round(fraction * df.count()), seed)


def cap_sample(
    train: DataFrame,
    test: DataFrame,
    key: str | Sequence[str],
    fit_rows: int = FIT_ROWS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """At most `fit_rows` train rows to fit on, and all test rows."""
    return sample_rows(train, key, fit_rows, seed), test


def mark_split(
    df: DataFrame,
    key: str | Sequence[str],
    stratify: str | None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    name: str = "part",
) -> DataFrame:
    """Add a train/test column: ceil(share * n) test rows, class shares kept.

    A class with one row, or a part smaller than the number of classes, makes the split unstratified.
    """
    sizes = class_sizes(df, stratify)
    n = sum(sizes.values())
    test_total = math.ceil(round(test_share * n, 9))
    if stratify is not None and (
        min(sizes.values(), default=0) < 2 or min(test_total, n - test_total) < len(sizes)
    ):
        stratify, sizes = None, {"": n}
    quotas = share_quotas(sizes, test_total) if n else {}
    cutoffs = hash_cutoffs(df, key, quotas, sizes, stratify, seed)
    is_test = within_quota(key, cutoffs, stratify, seed)
    return df.withColumn(name, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def stratified_split(
    df: DataFrame,
    key: str | Sequence[str],
    stratify: str | None,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, key, stratify, test_share, seed, "_part")
    return (
        marked.filter(F.col("_part") == "train").drop("_part"),
        marked.filter(F.col("_part") == "test").drop("_part"),
    )


def mark_temporal_split(
    df: DataFrame, ts: str, key: str | Sequence[str] | None = None, train_share: float = 0.9, name: str = "part"
) -> DataFrame:
    """Add a train/test column: the first int(n * share) rows in time order are train.

    `key` orders rows with the same time; without it the times must be unique.
    """
    order = [_micros(df, ts)]
    for k in key_list(key) if key is not None else []:
        if isinstance(df.schema[k].dataType, T.StringType):
            order += _leading_bytes(F.col(k))
        order.append(F.col(k))
    rows = int(df.count() * train_share)
    cut = kth_row(df, order, rows)
    is_train = F.lit(False) if cut is None else not_after(order, cut)
    return df.withColumn(name, F.when(is_train, F.lit("train")).otherwise(F.lit("test")))


def temporal_split(
    df: DataFrame, ts: str, key: str | Sequence[str] | None = None, train_share: float = 0.9
) -> tuple[DataFrame, DataFrame]:
    marked = mark_temporal_split(df, ts, key, train_share, "_part")
    return (
        marked.filter(F.col("_part") == "train").drop("_part"),
        marked.filter(F.col("_part") == "test").drop("_part"),
    )


def series_split(
    df: DataFrame, ts: str, value: str, key: str | Sequence[str] | None = None, train_share: float = 0.9
) -> tuple[DataFrame, DataFrame]:
    """The temporal split of one value column."""
    train, test = temporal_split(df, ts, key, train_share)
    return train.select(ts, value), test.select(ts, value)


def _leading_bytes(text: Column) -> list[Column]:
    """The first bytes of a text as whole numbers of six bytes, in the order of the text: unlike texts these have quantiles.

    What ties on all of them is ordered by the text itself.
    """
    digits = F.hex(text.cast("binary"))
    return [F.conv(F.rpad(F.substring(digits, 12 * i + 1, 12), 12, "0"), 16, 10).cast("long") for i in range(8)]


def _micros(df: DataFrame, ts: str):
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(F.col(ts).cast("timestamp"))
