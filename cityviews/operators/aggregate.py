"""Means per key, whole or as additive parts, and stacking of drifting inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def mean_by(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    *extra: Column,
) -> DataFrame:
    """Mean of each metric per key; nulls are ignored, a null key is a key.

    Sums and counts are combined before the shuffle, so a hot key costs one row per task.
    """
    return df.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in metrics], *extra)


def mean_parts(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], *extra: Column
) -> DataFrame:
    """Sum and count of each metric per key, to be added up later."""
    parts = []
    for m in metrics:
        parts += [F.sum(F.col(m).cast("double")).alias(f"{m}_sum"),
                  F.count(m).alias(f"{m}_count")]
    return df.groupBy(*keys).agg(*parts, *extra)


def finish_means(df: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Means from added-up sums and counts; null where nothing was counted."""
    means = [
        F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_count")).alias(m) for m in metrics
    ]
    return df.select(*keep, *means)


def stack(frames: Sequence[DataFrame], schema: StructType | None = None) -> DataFrame:
    """All rows of all frames, duplicates kept, matched by name.

    A column that is whole-numbered in one frame and double in another comes out double.
    With ``schema`` each frame is cast to it first and missing columns are null.
    """
    if schema is not None:
        frames = [
            df.select(*[
                (F.col(f.name) if f.name in df.columns else F.lit(None))
                .cast(f.dataType).alias(f.name)
                for f in schema.fields
            ])
            for df in frames
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
