"""Incremental refresh: files are taken up as they arrive."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cityviews.functions.stamps import hour_stamp
from cityviews.plans.refresh import files_of, named, store_files
from cityviews.plans.registry import VIEWS, View, stored_spec
from cityviews.sinks.store import compact_view, create_view, source_batch, upsert_once


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name kept with the checkpoint: the same after a restart, new with a new one."""
    folder = f"{checkpoint}/stream_name"
    name = F.lit(uuid.uuid4().hex).alias("name")
    spark.range(1).coalesce(1).select(name).write.mode("ignore").parquet(folder)
    return spark.read.schema("name string").parquet(folder).first()["name"]


def _whole_hours(
    batch: DataFrame, polls: Callable[[SparkSession, str, str], DataFrame]
) -> DataFrame:
    """All payloads of the hours that a batch touches; the range of hours prunes the scan."""
    hour = hour_stamp(F.col("stamp_ts"))
    touched = batch.select(hour.alias("_hour"))
    ends = touched.agg(F.min("_hour").alias("first"), F.max("_hour").alias("last")).first()
    if ends["first"] is None:
        return batch
    whole = polls(batch.sparkSession, ends["first"], ends["last"]).withColumn("_hour", hour)
    return whole.join(touched.distinct(), "_hour", "left_semi").drop("_hour")


def refresh_stream(
    payloads: DataFrame,
    view: View,
    path: str,
    checkpoint: str,
    compact_every: int | None = None,
    polls: Callable[[SparkSession, str, str], DataFrame] | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch of a payload stream into a stored view, then stop.

    The checkpoint remembers which files are done. A micro-batch is stored under the name
    of the stream and its number there, so one that is replayed after a failure replaces
    itself and nothing else. Each micro-batch reads only its own files; the stored view is
    merged when it is read. ``compact_every`` compacts before every so many batches.

    A view of means cannot be merged, so it needs ``polls``, which reads all payloads of an
    hour range: the hours that a micro-batch touches are then computed from all their files.
    """
    if view.whole_hours and polls is None:
        raise ValueError(f"{view.spec.name} is computed from whole hours, so it needs polls")
    spark = payloads.sparkSession
    create_view(spark, view.spec, path)
    stream = _stream_name(spark, checkpoint)

    def publish(batch: DataFrame, number: int) -> None:
        source = f"{stream}-{number}"
        session = batch.sparkSession
        if compact_every and number and number % compact_every == 0:
            # All batches in the log are whole, unless this one is a replay.
            if source_batch(session, view.spec, path, source) is None:
                compact_view(session, view.spec, path)
        if view.whole_hours:
            batch = _whole_hours(batch, polls)
        upsert_once(view.build(batch), view.spec, path, source)

    return (
        payloads.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_files(
    files: DataFrame,
    name: str,
    folder: str,
    path: str,
    checkpoint: str,
    compact_every: int | None = None,
    cells: bool = False,
    rule: str | None = None,
) -> StreamingQuery:
    """Upsert a stream of file names (``stream_files``) into a stored view, then stop.

    Each micro-batch opens its own files, whatever types each of them has; for a view of means, all
    files of the hours that it touches and no other. A view whose rows add up skips files
    that it has counted, by whatever way they came.
    """
    view, spec = VIEWS[name], stored_spec(name, cells, rule)
    spark = files.sparkSession
    create_view(spark, spec, path)
    stream = _stream_name(spark, checkpoint)

    def publish(batch: DataFrame, number: int) -> None:
        source, session = f"{stream}-{number}", batch.sparkSession
        if compact_every and number and number % compact_every == 0:
            if source_batch(session, spec, path, source) is None:
                compact_view(session, spec, path)
        arrived = named(batch)
        if view.whole_hours:
            arrived = touched_files(session, folder, arrived)
        store_files(session, name, arrived, path, cells, rule, source=source)

    return (
        files.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def touched_files(spark: SparkSession, folder: str, arrived: DataFrame) -> DataFrame:
    """All files of a feed in the hours that ``arrived`` files lie in; found by name, none is opened."""
    hour = hour_stamp(F.col("stamp_ts"))
    touched = arrived.select(hour.alias("_hour")).distinct()
    return files_of(spark, folder).withColumn("_hour", hour).join(touched, "_hour", "left_semi").drop("_hour")
