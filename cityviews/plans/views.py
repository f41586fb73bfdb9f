"""The five views, each a function from payload rows to typed, keyed rows.

Payload rows carry ``stamp_ts``, the time of the file they came from. Every view covers
any number of files in one job; a backfill is the same call on more files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cityviews import schemas as S
from cityviews.functions.stamps import (
    day_stamp,
    hour_index,
    hour_stamp,
    in_hours,
    previous_hour,
    row_key,
)
from cityviews.operators.aggregate import finish_means, mean_by, mean_parts
from cityviews.operators.latest import latest_rows
from cityviews.operators.shape import (
    check_mapped,
    expand_struct,
    explode_entities,
    pick_at,
    union_member,
)

STAMP = "stamp_ts"


def _forecast_rows(
    payloads: DataFrame,
    struct: str,
    families: Mapping[str, str],
    index: Column,
    strict: bool,
    as_read: bool,
) -> DataFrame:
    wide = expand_struct(payloads, struct, keep=[STAMP])
    fields = [c for c in wide.columns if c != STAMP]
    check_mapped(fields, families)
    if "time" not in fields:
        raise ValueError(f"{struct} has no field time, which is the row key")
    single = [f.name for f in wide.schema.fields
              if f.name in fields and not isinstance(f.dataType, ArrayType)]
    if single:
        raise ValueError(f"{struct} has fields that are no arrays: {', '.join(single)}")
    picked = pick_at(wide, index, keep=[STAMP], strict=strict)
    key = F.col("time")
    if strict:
        key = F.coalesce(key, F.raise_error(F.lit(f"{struct}.time is null")))
    metrics = [
        (F.col(c) if as_read else F.col(c).cast("double")).alias(c) if c in picked.columns
        else F.lit(None).cast("double").alias(c)
        for c in families if c != "time"
    ]
    rows = picked.select(
        key.alias("row_key"), "time", *metrics, F.col(STAMP).alias("version"))
    return rows if strict else rows.where("row_key IS NOT NULL")


def weather_daily(payloads: DataFrame, strict: bool = True, as_read: bool = False) -> DataFrame:
    """First day of each forecast, newest file per day; ``as_read`` keeps whole numbers whole."""
    rows = _forecast_rows(
        payloads, "daily", S.WEATHER_DAILY_FAMILIES, F.lit(0), strict, as_read)
    return latest_rows(rows, ["row_key"], ["version"])


def weather_hourly(payloads: DataFrame, strict: bool = True, as_read: bool = False) -> DataFrame:
    """Slot of the file's hour in each forecast, newest file per hour; ``as_read`` as above."""
    rows = _forecast_rows(
        payloads, "hourly", S.WEATHER_HOURLY_FAMILIES, hour_index(F.col(STAMP)), strict, as_read)
    return latest_rows(rows, ["row_key"], ["version"])


def off_slot(hourly_rows: DataFrame) -> DataFrame:
    """Rows of ``weather_hourly`` whose time is not the hour of their file."""
    expected = F.replace(hour_stamp(F.col("version")), F.lit("_"), F.lit("T"))
    return hourly_rows.where(~F.startswith(F.col("time"), expected))


def information_daily(payloads: DataFrame, repair: bool = False) -> DataFrame:
    """Station details per day, newest file of the day."""
    entities = explode_entities(
        payloads, "data.stations", list(S.INFORMATION_FAMILIES), keep=[STAMP])
    columns = [
        union_member(entities, c, repair).alias(c) if c in S.UNION_FIELDS else F.col(c)
        for c in S.INFORMATION_FAMILIES
    ]
    rows = entities.select(
        row_key(day_stamp(F.col(STAMP)), F.col("station_id")).alias("row_key"),
        *columns,
        F.col(STAMP).alias("version"),
    )
    return latest_rows(rows, ["row_key"], ["version"])


def _hourly_entities(payloads: DataFrame, trigger_stamp: str | None) -> DataFrame:
    if trigger_stamp is not None:
        payloads = payloads.where(in_hours(F.col(STAMP), previous_hour(trigger_stamp)))
    entities = explode_entities(
        payloads, "data.stations", list(S.STATUS_HOURLY_COLUMNS), keep=[STAMP])
    return entities.withColumn("stamp", hour_stamp(F.col(STAMP)))


_HOURLY_KEYS = ["stamp", "legacy_id", "station_id"]


def _with_hourly_key(df: DataFrame) -> DataFrame:
    key = row_key(F.col("stamp"), F.col("station_id")).alias("row_key")
    return df.select(key, *df.columns)


def status_hourly(payloads: DataFrame, trigger_stamp: str | None = None) -> DataFrame:
    """Mean station metrics per hour, legacy id and station.

    With ``trigger_stamp`` only the hour before that hour stamp is computed.
    """
    means = mean_by(
        _hourly_entities(payloads, trigger_stamp), _HOURLY_KEYS, S.STATUS_METRICS,
        F.max(STAMP).alias("version"))
    return _with_hourly_key(means)


def keyed_status_hourly(hourly_rows: DataFrame) -> DataFrame:
    """One row per row key, which holds no legacy id: the greatest legacy id wins."""
    return latest_rows(hourly_rows, ["row_key"], ["legacy_id", "version"])


def status_hourly_parts(payloads: DataFrame) -> DataFrame:
    """Sums and counts behind ``status_hourly``, which can be added over batches."""
    parts = mean_parts(
        _hourly_entities(payloads, None), _HOURLY_KEYS, S.STATUS_METRICS,
        F.max(STAMP).alias("version"))
    return _with_hourly_key(parts)


def status_hourly_from_parts(parts: DataFrame) -> DataFrame:
    """``status_hourly`` rows from added-up parts."""
    kept = ["row_key", *_HOURLY_KEYS]
    rows = finish_means(parts, [*kept, "version"], S.STATUS_METRICS)
    return rows.select(*kept, *S.STATUS_METRICS, "version")


def status_live(payloads: DataFrame) -> DataFrame:
    """Latest status per station, by file stamp."""
    entities = explode_entities(
        payloads, "data.stations", list(S.STATUS_FAMILIES), keep=[STAMP])
    rows = entities.select(
        row_key(F.col("station_id")).alias("row_key"),
        *S.STATUS_FAMILIES,
        F.col(STAMP).alias("version"),
    )
    return latest_rows(rows, ["row_key"], ["version"])
