"""Time stamps in file names, hour and day stamps, row keys.

All times are ``timestamp_ntz``, so nothing depends on the session time zone. Stamps
are cut from the text form of the time for the same reason: ``date_format`` would go
through the session zone and shift hours that a clock change skips.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: files are named <feed>_<yyyy-MM-dd>_<HH-mm-ss-SSS>.parquet
FILE_STAMP = r"_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}-\d{3})\.[^/]*$"
FILE_STAMP_PARTS = r"^.*_(\d{4}-\d{2}-\d{2})_(\d{2})-(\d{2})-(\d{2})-(\d{3})\.[^/]*$"
# Folders of a feed laid out by time
FOLDER_PARTS = r"^.*/day=(\d{4}-\d{2}-\d{2})/hour=(\d{1,2})/[^/]*$"
# Fixed value: an hour stamp is yyyy-MM-dd_HH
HOUR_STAMP = "%Y-%m-%d_%H"


def file_stamp(path: Column) -> Column:
    """Time in the last part of ``path``; null if the name carries none."""
    # One pass over the path; a path without a stamp stays as it is and is no time.
    text = F.regexp_replace(path, FILE_STAMP_PARTS, "$1 $2:$3:$4.$5")
    return text.try_cast("timestamp_ntz")


def folder_stamp(path: Column) -> Column:
    """Hour of the folders ``day=../hour=..`` that ``path`` lies in; null if there are none."""
    text = F.regexp_replace(path, FOLDER_PARTS, "$1 $2:00:00")
    return text.try_cast("timestamp_ntz")


def day_stamp(ts: Column) -> Column:
    """``yyyy-MM-dd`` of a time."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 10)


def hour_index(ts: Column) -> Column:
    """Hour of the day, 0 to 23."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 12, 2).cast("int")


def hour_stamp(ts: Column) -> Column:
    """``yyyy-MM-dd_HH`` of a time."""
    return F.translate(
        F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 13), " ", "_")


def prev_hour_stamp(ts: Column) -> Column:
    """Hour stamp of the hour before ``ts``."""
    return hour_stamp(ts.cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR"))


def previous_hour(stamp: str) -> str:
    """Hour stamp before the hour stamp ``stamp``."""
    return (datetime.strptime(stamp, HOUR_STAMP) - timedelta(hours=1)).strftime(HOUR_STAMP)


def ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_hours(ts: Column, first: str, last: str | None = None) -> Column:
    """Predicate: ``ts`` lies in the hours ``first`` to ``last`` (both included).

    Written as a range on the time itself, so it reaches a parquet scan as a pushed
    filter, or drops whole files when the time comes from the file name.
    """
    start = datetime.strptime(first, HOUR_STAMP)
    stop = datetime.strptime(last or first, HOUR_STAMP) + timedelta(hours=1)
    return (ts >= ntz(start)) & (ts < ntz(stop))


def hour_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per hour from ``first`` to ``last``, both included: ``hour_ts``, ``stamp``."""
    start = datetime.strptime(first, HOUR_STAMP)
    hours = (datetime.strptime(last, HOUR_STAMP) - start) // timedelta(hours=1) + 1
    moments = spark.range(max(hours, 0)).select(
        F.timestamp_add("HOUR", F.col("id"), ntz(start)).alias("hour_ts"))
    return moments.select("hour_ts", hour_stamp(F.col("hour_ts")).alias("stamp"))


def row_key(*parts: Column) -> Column:
    """Parts joined by ``_``; a null part reads ``None``, as in the stored text keys."""
    return F.concat_ws(
        "_", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
