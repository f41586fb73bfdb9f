"""Helpers shared by the operators: written tables, running sums, fixed-size tallies."""

from __future__ import annotations

import ctypes
from collections.abc import Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityviews.sinks.workdir import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read again.

    This cuts the lineage: a lost executor costs no more than the step it was working on.
    """
    path = work_folder(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Jobs begun inside send rows to Python in batches of ``size``, whatever the session has set.

    Rows hold whole texts or sets, so Spark's 64 MB for each of an executor's tasks adds up.
    """
    old = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, size)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(BATCH)
        else:
            spark.conf.set(BATCH, old)


def lean(task):
    """``task`` over batches, as one that gives memory back at its end: workers outlive their tasks."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return run


def before(
    df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[Column], value: Column,
    name: str, carry: Sequence[str] = (),
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows that come earlier in their group.

    Rows are ordered by ``bucket``, then by ``order``. A task sorts one bucket at a time; the
    sums of whole buckets are added up in a table with one row per bucket. So a group may hold
    any share of the rows, if its buckets are small.
    """
    keys = [*groups, bucket]
    rows = df.withColumn("_v", value.cast("bigint"))
    totals = rows.groupBy(*keys).agg(F.sum("_v").alias("_t"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    kept = [*df.columns, *carry]
    return rows.join(starts, on, "left").select(
        *kept, (F.col("_start") + F.col("_in")).alias(name))


def buckets_for(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


#: A level of cuts makes at most 2**CUTS ranges of each range before it.
CUTS = 10


def text_order(text: Column) -> Column:
    """A number that spreads texts evenly; rows of one id are ordered by it."""
    return F.xxhash64(text)


def id_ranges(df: DataFrame, key: str, order: str, each: int) -> DataFrame:
    """``df`` with ``_r bigint``: numbered ranges, in order of ``key``, ``order``, of about ``each`` rows.

    ``key`` and ``order`` are bigint without nulls; ``order`` is spread evenly over its type. Cut
    points are quantiles of ``key`` over all rows, on two levels: ranges of the whole, then of each
    range. A key that takes up several cut points is split evenly by ``order`` over the ranges
    between them, so one key may hold any share of the rows. There are up to 2**(2 * CUTS) ranges,
    so they keep their size up to two billion rows of ``each`` = 2,000 and grow slowly from there;
    the cuts are at most 8 MB.
    """
    steps = (df.count() // each).bit_length()
    first, second = min(CUTS, steps), min(CUTS, max(0, steps - CUTS))
    if not steps:
        return df.withColumn("_r", F.lit(0).cast("bigint"))

    def quantiles(levels: int) -> Column:
        return F.percentile_approx(key, [i / 2 ** levels for i in range(1, 2 ** levels)], 100_000)

    def below(cuts: Column, levels: int, passed) -> Column:
        """How many of the sorted cuts are passed."""
        halves = F.lit([2 ** i for i in reversed(range(levels))])
        return F.aggregate(halves, F.lit(0), lambda low, half: F.when(
            passed(F.get(cuts, low + half - 1)), low + half).otherwise(low))

    def split(rows: DataFrame, cuts: Column, levels: int) -> DataFrame:
        """Adds ``_at``, the range, and makes ``_u`` the share within what the range has of the key."""
        rows = rows.withColumn("_lo", below(cuts, levels, lambda cut: cut < F.col(key)))
        rows = rows.withColumn("_hi", below(cuts, levels, lambda cut: cut <= F.col(key)))
        rows = rows.withColumn("_u", F.col("_u") * (F.col("_hi") - F.col("_lo") + 1))
        part = F.floor("_u")
        return rows.withColumn("_at", F.col("_lo") + part).withColumn(
            "_u", F.col("_u") - part).drop("_lo", "_hi")

    found = df.agg(quantiles(first)).first()[0]
    cuts = F.lit(list(found or [0] * (2 ** first - 1)))
    share = (F.shiftright(order, 11) + 2 ** 52) / F.lit(2.0 ** 53)  # exact, and below 1
    rows = split(df.withColumn("_u", share), cuts, first).withColumnRenamed("_at", "_r")
    if second:
        # which rows of a split key a cut is taken from does not matter, so texts are not read
        drawn = split(df.select(key).withColumn("_u", F.rand(0)), cuts, first)
        finer = drawn.groupBy(F.col("_at").alias("_of")).agg(quantiles(second).alias("_cuts"))
        finer = F.broadcast(saved(finer, "cuts"))  # at most 2**CUTS rows of 2**CUTS numbers
        rows = split(rows.join(finer, F.col("_r") == F.col("_of"), "left").withColumn(
            "_cuts", F.coalesce("_cuts", F.array_repeat(F.lit(0).cast("bigint"), 2 ** second - 1))),
            F.col("_cuts"), second)
        rows = rows.withColumn("_r", F.col("_r") * 2 ** second + F.col("_at")).drop("_of", "_cuts", "_at")
    return rows.drop("_u")


def slices(batches, rows: int = 1024):
    """The rows of record batches, fewer at a time, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


TEXT_BYTES = 2 << 20  # of texts that a task works on together


def by_bytes(batches, column: str, most: int = TEXT_BYTES):
    """The rows of record batches, so many at a time that their texts have ``most`` bytes together.

    A longer text comes alone, so memory is bounded by ``most`` or by the longest text.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder's address, in a task as on the driver."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder[len("file:"):]
    return fs.FileSystem.from_uri(folder)


def gathered(blocks: DataFrame, width: int, dtype: str) -> np.ndarray:
    """The sum, as one array of ``width`` numbers, of ``blocks(block int, data binary)``.

    Blocks are added up by Spark; the driver gets ``width`` numbers, however many rows there are.
    """
    wide = np.dtype(dtype)

    def total(key, frame):
        import pandas as pd

        out = np.zeros(len(frame["data"].iloc[0]) // wide.itemsize, dtype=np.uint64)
        for x in frame["data"]:
            out += np.frombuffer(x, dtype=wide)
        out = np.minimum(out, np.iinfo(wide).max).astype(wide)
        return pd.DataFrame({"block": [key[0]], "data": [out.tobytes()]})

    each = width // BLOCKS
    out = np.zeros(width, dtype=wide)
    for row in blocks.groupBy("block").applyInPandas(total, "block int, data binary").collect():
        out[row.block * each:(row.block + 1) * each] = np.frombuffer(row.data, dtype=wide)
    return out


#: Tallies are cut into so many blocks to be added up.
BLOCKS = 64


def as_blocks(counts: np.ndarray):
    """The non-empty blocks of one task's tally, as a record batch."""
    parts = counts.reshape(BLOCKS, -1)
    full = np.flatnonzero(parts.any(axis=1))
    return pa.RecordBatch.from_pydict({
        "block": pa.array(full.astype(np.int32)),
        "data": pa.array([parts[i].tobytes() for i in full], type=pa.binary()),
    })
