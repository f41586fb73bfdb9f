"""Feed folders: listing, newest file, and payload scans (batch and streaming).

A feed lies in one folder of files with the time in their names, or in folders
``day=yyyy-MM-dd/hour=HH``, or both at once. Where a name carries no time, the folders do.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cityviews.functions.stamps import file_stamp, folder_stamp, in_hours
from cityviews.operators.aggregate import stack

PARQUET = "*.parquet"


DAY, HOUR = "day", "hour"  # folders of a feed laid out by time


def path_stamp(path: Column) -> Column:
    """Time of a file: that of its name, else the hour of its folders, else null."""
    return F.coalesce(file_stamp(path), folder_stamp(path))


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", PARQUET).load(folder)


def by_hour(listing: DataFrame) -> bool:
    """Whether the files lie in folders by day and hour."""
    return {DAY, HOUR} <= set(listing.columns)


def _folders_in(first: str, last: str) -> Column:
    """Predicate on the folders alone, so that others are neither listed in a scan nor opened."""
    day, hour = F.col(DAY).cast("string"), F.lpad(F.col(HOUR).cast("string"), 2, "0")
    return day.between(first[:10], last[:10]) & F.concat_ws("_", day, hour).between(first, last)


def list_files(
    spark: SparkSession, folder: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """``path`` and ``stamp_ts`` of the parquet files of a folder; no file is opened.

    With ``first`` and ``last``, those of a range of hours.
    """
    files = _listing(spark, folder)
    if first is not None and by_hour(files):
        files = files.where(_folders_in(first, last or first))
    files = files.select("path", path_stamp(F.col("path")).alias("stamp_ts"))
    return files if first is None else files.where(in_hours(F.col("stamp_ts"), first, last))


def newest(paths: DataFrame) -> DataFrame:
    """One row with the path of the greatest stamp; no row without a stamped path."""
    # A path without a stamp is lowest, so it only wins where no path has one.
    best = paths.agg(F.max(F.struct("stamp_ts", "path")).alias("best"))
    return best.where("best.stamp_ts IS NOT NULL").select("best.path", "best.stamp_ts")


def latest_file(spark: SparkSession, folder: str) -> str | None:
    """Path of the newest file of a folder, by the time in its name or folders."""
    row = newest(list_files(spark, folder)).first()
    return row["path"] if row else None


def stamped(df: DataFrame) -> DataFrame:
    """A scan with ``stamp_ts``, and without the columns of its folders."""
    meta = F.col("_metadata")
    if not {DAY, HOUR} <= set(df.columns):
        return df.select("*", file_stamp(meta["file_name"]).alias("stamp_ts"))
    kept = [c for c in df.columns if c not in (DAY, HOUR)]
    return df.select(*kept, path_stamp(meta["file_path"]).alias("stamp_ts"))


def read_payloads(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    hour: str | None = None,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Payload rows of a file or folder in one scan, with ``stamp_ts`` from the file name.

    ``schema`` limits the scan to the fields a view needs; without it the footers decide,
    and a field that only some files have is null in the others.
    ``hour`` (``yyyy-MM-dd_HH``) keeps the files of one hour already while listing;
    ``first`` and ``last`` keep those of an hour range before any is opened. Where the feed
    lies in folders by day and hour, the range is a filter on these.
    """
    reader = spark.read.option("pathGlobFilter", PARQUET)
    folders = f"/{HOUR}=" in path or by_hour(_listing(spark, path))
    if schema is None:
        reader = reader.option("mergeSchema", True)
    elif folders:
        reader = reader.schema(StructType([
            *schema.fields, StructField(DAY, StringType()), StructField(HOUR, StringType())]))
    else:
        reader = reader.schema(schema)
    if hour is not None:
        first, last = hour, hour
        if not folders:
            reader = reader.option("pathGlobFilter", f"*_{hour}-*.parquet")
    if f"/{DAY}=" in path:
        reader = reader.option("basePath", path[:path.index(f"/{DAY}=")])
    payloads = reader.parquet(path)
    if folders and first is not None:
        payloads = payloads.where(_folders_in(first, last or first))
    payloads = stamped(payloads)
    if first is not None:
        payloads = payloads.where(in_hours(F.col("stamp_ts"), first, last or first))
    return payloads


def read_drifting(
    spark: SparkSession,
    groups: Mapping[str, StructType],
    schema: StructType,
) -> DataFrame:
    """Payloads of file groups whose types differ, cast to one schema.

    ``groups`` maps a path or glob to the schema its files were written with. Each group
    is one scan, however many files it has.
    """
    frames = [read_payloads(spark, path, kind) for path, kind in groups.items()]
    return stack(frames, StructType(schema.fields).add("stamp_ts", "timestamp_ntz"))


def stream_payloads(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Payload rows of files as they arrive, with ``stamp_ts`` from the file name."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", PARQUET)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stamped(reader.parquet(folder))


def newest_payloads(payloads: DataFrame, stamp: Column | str = "stamp_ts") -> DataFrame:
    """Payload rows of the greatest stamp.

    The greatest stamp is found first, as one value, and is then an ordinary filter.
    """
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    return payloads.where(stamp == payloads.select(F.max(stamp)).scalar())


def stream_files(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """``path`` and ``stamp_ts`` of files as they arrive, none of them opened.

    ``folder`` is flat or laid out by day and hour.
    """
    kinds = _listing(spark, folder).schema
    reader = spark.readStream.format("binaryFile").schema(kinds).option("pathGlobFilter", PARQUET)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", path_stamp(F.col("path")).alias("stamp_ts"))
