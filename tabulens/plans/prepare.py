"""From a raw table to a train and a test table for the baselines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tabulens.fixed_values import SEED, TEST_SHARE
from tabulens.functions.columns import key_list
from tabulens.operators.dimensionality import dimensionality_table
from tabulens.operators.project import drop_incomplete_rows, drop_listed, numeric_with_target
from tabulens.operators.sampling import mark_split, sample_fraction
from tabulens.sources.tables import write_result, write_table


@dataclass
class Prepared:
    raw_summary: DataFrame
    clean_summary: DataFrame
    marked: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.marked.filter("part = 'train'").drop("part")

    @property
    def test(self) -> DataFrame:
        return self.marked.filter("part = 'test'").drop("part")

    def save(self, path: str, kind: str = "parquet") -> None:
        write_table(self.train, f"{path}_train", kind)
        write_table(self.test, f"{path}_test", kind)
        write_result(self.raw_summary, f"{path}_raw_summary")
        write_result(self.clean_summary, f"{path}_clean_summary")


def prepare_dataset(
    df: DataFrame,
    key: str | Sequence[str],
    target: str,
    fraction: float = 1.0,
    excluded: Sequence[str] = (),
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    key_is_feature: bool = False,
) -> Prepared:
    """Sample, drop incomplete rows, keep numbers and target, drop listed columns, split by class.

    The key stays in the split tables to break ties later. Summaries count it only when it is a feature.
    """
    keys = key_list(key)
    raw = dimensionality_table(df)
    rows = sample_fraction(df, keys, fraction, seed) if fraction < 1.0 else df
    rows = drop_incomplete_rows(rows)
    clean = drop_listed(numeric_with_target(rows, target), excluded)
    kept = clean.columns if key_is_feature else [c for c in clean.columns if c not in keys]
    final = rows.select(*[k for k in keys if k not in kept], *kept)
    clean_summary = dimensionality_table(rows.select(*kept))
    return Prepared(raw, clean_summary, mark_split(final, keys, target, test_share, seed))
