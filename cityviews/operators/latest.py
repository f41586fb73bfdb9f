"""Last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``order`` columns per key.

    Ties are broken by all other columns, greatest wins and null is lowest, so the result
    does not depend on how the rows are spread. Each task keeps one row per key before
    the shuffle, so a key with very many rows does not load one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    winner = F.max(F.struct(*order, *rest)).alias("_winner")
    merged = df.groupBy(*keys).agg(winner)
    return merged.select(
        *[c if c in keys else F.col(f"_winner.`{c}`") for c in df.columns])
