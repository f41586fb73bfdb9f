"""Feed schemas, view schemas and column families.

The lists in this module are fixed values: they must equal what the feeds and the
keyed views use, so they are written out in full and in feed order.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# ---------------------------------------------------------------- fixed values
# Weather: field name -> column family.
WEATHER_DAILY_FAMILIES = {
    "time": "time",
    "temperature_2m_max": "temperature",
    "temperature_2m_min": "temperature",
    "apparent_temperature_max": "temperature",
    "apparent_temperature_min": "temperature",
    "precipitation_sum": "precipitation",
    "rain_sum": "precipitation",
    "showers_sum": "precipitation",
    "snowfall_sum": "precipitation",
    "windspeed_10m_max": "wind",
    "windgusts_10m_max": "wind",
}

WEATHER_HOURLY_FAMILIES = {
    "time": "time",
    "temperature_2m": "temperature",
    "apparent_temperature": "temperature",
    "precipitation": "precipitation",
    "rain": "precipitation",
    "showers": "precipitation",
    "snowfall": "precipitation",
    "windspeed_10m": "wind",
    "windgusts_10m": "wind",
}

# Stations: field name -> column family.
INFORMATION_FAMILIES = {
    "lon": "geo",
    "external_id": "id",
    "legacy_id": "id",
    "station_id": "id",
    "has_kiosk": "detail",
    "capacity": "detail",
    "lat": "geo",
    "region_id": "id",
    "station_type": "detail",
    "short_name": "detail",
    "electric_bike_surcharge_waiver": "detail",
    "name": "detail",
}

STATUS_FAMILIES = {
    "legacy_id": "id",
    "num_bikes_disabled": "metric",
    "last_reported": "id",
    "station_id": "id",
    "is_renting": "status",
    "num_ebikes_available": "metric",
    "num_docks_disabled": "metric",
    "is_installed": "status",
    "num_bikes_available": "metric",
    "is_returning": "status",
    "station_status": "status",
    "num_docks_available": "metric",
}

# The five averaged station metrics.
STATUS_METRICS = (
    "num_bikes_disabled",
    "num_ebikes_available",
    "num_docks_disabled",
    "num_bikes_available",
    "num_docks_available",
)
# ------------------------------------------------------------ end fixed values

WEATHER_DAILY_METRICS = tuple(c for c in WEATHER_DAILY_FAMILIES if c != "time")
WEATHER_HOURLY_METRICS = tuple(c for c in WEATHER_HOURLY_FAMILIES if c != "time")
STATUS_HOURLY_COLUMNS = ("legacy_id", "station_id", *STATUS_METRICS)

_TEXT_FIELDS = {
    "external_id", "legacy_id", "station_id", "region_id", "station_type",
    "short_name", "name", "station_status",
}
_FLAG_FIELDS = {"has_kiosk", "electric_bike_surcharge_waiver"}
UNION_FIELDS = ("lon", "lat")

_UNION = StructType([
    StructField("member0", FloatType()),
    StructField("member1", DoubleType()),
])


def _scalar(name: str):
    if name in _TEXT_FIELDS:
        return StringType()
    return BooleanType() if name in _FLAG_FIELDS else LongType()


def _parallel_arrays(struct: str, families: dict[str, str]) -> StructType:
    return StructType([StructField(struct, StructType([
        StructField(c, ArrayType(StringType() if c == "time" else DoubleType()))
        for c in families
    ]))])


def station_feed(columns) -> StructType:
    """Schema of ``data.stations`` holding just ``columns``.

    Spark does not prune fields of an exploded array when several are used, so a view
    asks for the fields it needs here and the scan reads no others.
    """
    entity = StructType([
        StructField(c, _UNION if c in UNION_FIELDS else _scalar(c)) for c in columns
    ])
    return StructType([StructField("data", StructType([
        StructField("stations", ArrayType(entity)),
    ]))])


WEATHER_DAILY_FEED = _parallel_arrays("daily", WEATHER_DAILY_FAMILIES)
WEATHER_HOURLY_FEED = _parallel_arrays("hourly", WEATHER_HOURLY_FAMILIES)
INFORMATION_FEED = station_feed(INFORMATION_FAMILIES)
STATUS_FEED = station_feed(STATUS_FAMILIES)
STATUS_HOURLY_FEED = station_feed(STATUS_HOURLY_COLUMNS)


def _view(*fields: tuple) -> StructType:
    return StructType(
        [StructField("row_key", StringType())]
        + [StructField(name, kind) for name, kind in fields]
        + [StructField("version", TimestampNTZType())]
    )


WEATHER_DAILY_VIEW = _view(
    ("time", StringType()), *((c, DoubleType()) for c in WEATHER_DAILY_METRICS))
WEATHER_HOURLY_VIEW = _view(
    ("time", StringType()), *((c, DoubleType()) for c in WEATHER_HOURLY_METRICS))
INFORMATION_DAILY_VIEW = _view(
    *((c, DoubleType() if c in UNION_FIELDS else _scalar(c)) for c in INFORMATION_FAMILIES))
STATUS_HOURLY_VIEW = _view(
    ("stamp", StringType()), ("legacy_id", StringType()), ("station_id", StringType()),
    *((c, DoubleType()) for c in STATUS_METRICS))
STATUS_LIVE_VIEW = _view(*((c, _scalar(c)) for c in STATUS_FAMILIES))

# Additive form of the hourly averages: a sum and a count per metric.
STATUS_HOURLY_PARTS = _view(
    ("stamp", StringType()), ("legacy_id", StringType()), ("station_id", StringType()),
    *((f"{c}_{part}", kind) for c in STATUS_METRICS
      for part, kind in (("sum", DoubleType()), ("count", LongType()))))

CELLS = StructType([
    StructField("row_key", StringType()),
    StructField("col", StringType()),
    StructField("val", StringType()),
    StructField("version", TimestampNTZType()),
])
