"""Refresh a stored view from one file, or backfill it from a folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityviews import schemas as S
from cityviews.functions.stamps import (
    FILE_STAMP,
    FOLDER_PARTS,
    hour_range,
    hour_stamp,
    in_hours,
    previous_hour,
)
from cityviews.operators.aggregate import stack
from cityviews.operators.cells import to_cells
from cityviews.operators.shape import check_mapped
from cityviews.plans.registry import VIEWS, View, stored_spec
from cityviews.plans.views import keyed_status_hourly
from cityviews.sinks.store import create_view, read_view, uncounted, upsert_once, upsert_view
from cityviews.sources.drift import read_files, read_group, schema_groups
from cityviews.sources.files import list_files


def _file_stamp(path: str) -> None:
    """Fail on a path without a time, in its name or its folders."""
    if not re.search(FILE_STAMP, path) and not re.search(FOLDER_PARTS, path):
        raise ValueError(f"no time stamp in file name {path}")


def files_of(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``path``, ``stamp_ts`` and ``file`` (the name a ledger knows it by) of a file or a feed's files."""
    return named(list_files(spark, path, first, last))


def named(files: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", r"((?:day=[^/]+/hour=[^/]+/)?[^/]+)$", 1)
    return files.select("path", "stamp_ts", name.alias("file"))


def feed_rows(view: View, files: DataFrame) -> DataFrame:
    """Rows of a view from ``files(path)``, whatever types and fields each of them has."""
    return view.build(read_files(files, view.feed, open_fields=view.open_feed))


def feed_cells(name: str, files: DataFrame) -> DataFrame:
    """Text cells of a view from ``files(path)``.

    Files of one schema are one scan and keep their types, so whole numbers read as such; a
    field that they lack brings no cell, while a null in one that they have brings ``None``. Means
    are taken over files of all schemas.
    """
    view = VIEWS[name]
    if view.whole_hours or view.spec.rule == "add":
        return view_cells(feed_rows(view, files), name)
    cells = []
    for group in schema_groups(files, view.feed, whole=view.open_feed):
        payloads = read_group(files.sparkSession, group)
        if view.open_feed:
            fields = payloads.schema[view.feed.fields[0].name].dataType.fieldNames()
            absent = [c for c in view.families if c not in fields]
            cells.append(view_cells(view.build(payloads, as_read=True), name, absent))
        else:
            cells.append(view_cells(view.build(payloads), name))
    if not cells:
        return files.sparkSession.createDataFrame([], S.CELLS)
    return stack(cells)


def check_feed(view: View, files: DataFrame) -> None:
    """Fail before anything is stored if some of ``files`` have a field without a family."""
    if view.open_feed:
        for group in schema_groups(files, view.feed, whole=True):
            for field in group.schema.fields:
                check_mapped(field.dataType.fieldNames(), view.families)


def _covered(view: View, spark: SparkSession, file: str) -> DataFrame:
    """The files that the arrival of ``file`` asks for.

    ``status_hourly`` covers the hour before the file's, from all files of that hour in
    the same feed; the other views cover the file itself.
    """
    if not view.whole_hours:
        return files_of(spark, file)
    at = previous_hour(files_of(spark, file).select(hour_stamp(F.col("stamp_ts"))).first()[0])
    folder = file.partition("/day=")[0] if "/day=" in file else file.rpartition("/")[0] or "."
    return files_of(spark, folder, at, at)


def view_rows(spark: SparkSession, name: str, file: str) -> DataFrame:
    """Rows that the arrival of ``file`` brings."""
    view = VIEWS[name]
    _file_stamp(file)
    return feed_rows(view, _covered(view, spark, file))


def store_files(
    spark: SparkSession, name: str, files: DataFrame, path: str, cells: bool = False,
    rule: str | None = None, batch: int | None = None, source: str | None = None,
) -> None:
    """Upsert what ``files`` bring, as one batch.

    A view whose rows add up takes only files that it hasn't counted yet. ``source`` names the
    batch, so that it counts once if it is sent again.
    """
    view, spec = VIEWS[name], stored_spec(name, cells, rule)
    create_view(spark, spec, path)
    check_feed(view, files)
    if spec.rule == "add":
        source = source or f"files-{uuid.uuid4().hex}"
        files = uncounted(files, spec, path, source)
        if batch is None:
            upsert_once(feed_rows(view, files), spec, path, source, files)
            return
    rows = feed_cells(name, files) if cells else feed_rows(view, files)
    if source is None:
        upsert_view(rows, spec, path, batch)
    else:
        upsert_once(rows, spec, path, source)


def refresh_from_file(
    spark: SparkSession, name: str, file: str, path: str, batch: int | None = None
) -> None:
    """Upsert what ``file`` brings, as a new batch unless a number is given."""
    _file_stamp(file)
    store_files(spark, name, _covered(VIEWS[name], spark, file), path, batch=batch)


def refresh_cells_from_file(
    spark: SparkSession,
    name: str,
    file: str,
    path: str,
    batch: int | None = None,
    rule: str = "version",
) -> None:
    """As ``refresh_from_file``, kept as text cells.

    Fields that the file lacks bring no cell, so older values of them stay.
    """
    _file_stamp(file)
    store_files(spark, name, _covered(VIEWS[name], spark, file), path, True, rule, batch)


def view_cells(rows: DataFrame, name: str, absent: list[str] = ()) -> DataFrame:
    """Cells of view rows; ``stamp`` is ours and no cell."""
    if name == "status_hourly":
        rows = keyed_status_hourly(rows)
    return to_cells(rows, VIEWS[name].families, drop=("stamp", *absent))


def stale_hours(spark: SparkSession, name: str, path: str, files: DataFrame) -> DataFrame:
    """Those of ``files`` that lie in hours with a file newer than what the view has of that hour."""
    spec = VIEWS[name].spec
    hour = hour_stamp(F.col("version")).alias("_hour")
    have = read_view(spark, spec, path).groupBy(hour).agg(F.max("version").alias("_have"))
    files = files.withColumn("_hour", hour_stamp(F.col("stamp_ts")))
    newest = files.groupBy("_hour").agg(F.max("stamp_ts").alias("_newest"))
    stale = newest.join(have, "_hour", "left").where("_have IS NULL OR _newest > _have").select("_hour")
    return files.join(stale, "_hour", "left_semi").drop("_hour")


def backfill(
    spark: SparkSession,
    name: str,
    folder: str,
    path: str,
    first: str,
    last: str,
    batch: int | None = None,
    cells: bool = False,
    rule: str | None = None,
    only_stale: bool = False,
) -> None:
    """Upsert the files of the hours ``first`` to ``last`` in one job, as one batch.

    With ``only_stale``, of those hours alone that have a file newer than the stored rows: for views
    whose version is the time of their file. Without such hours nothing is written.
    """
    files = files_of(spark, folder, first, last)
    if only_stale:
        create_view(spark, VIEWS[name].spec, path)
        files = stale_hours(spark, name, path, files)
        if files.isEmpty():
            return
    store_files(spark, name, files, path, cells, rule, batch)


def hour_coverage(
    spark: SparkSession, stamped: DataFrame, first: str, last: str
) -> DataFrame:
    """Number of stamped rows per hour of the range, zero for an hour without any."""
    counts = (
        stamped.where(in_hours(F.col("stamp_ts"), first, last))
        .groupBy(hour_stamp(F.col("stamp_ts")).alias("stamp"))
        .agg(F.count("*").alias("n"))
    )
    return (
        hour_range(spark, first, last).select("stamp")
        .join(counts, "stamp", "left")
        .select("stamp", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
    )


def file_coverage(spark: SparkSession, folder: str, first: str, last: str) -> DataFrame:
    """Number of files per hour of the range."""
    return hour_coverage(spark, list_files(spark, folder), first, last)
