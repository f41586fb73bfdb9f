"""Small nested payload files with stamped names."""

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.pandas.types import to_arrow_schema

from cityviews import schemas as S


def write_file(folder, name, rows, schema):
    """One parquet file; fields that a row lacks are null."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = Path(folder) / f"{name}.parquet"
    pq.write_table(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)), path)
    return str(path)


def station(station_id, legacy_id="l1", **values):
    return {"station_id": station_id, "legacy_id": legacy_id, **values}


def stations(*entities):
    return {"data": {"stations": list(entities)}}


def status_file(folder, stamp, *payloads, prefix="station_status"):
    return write_file(folder, f"{prefix}_{stamp}", payloads, S.STATUS_FEED)


def information_file(folder, stamp, *payloads):
    return write_file(folder, f"station_information_{stamp}", payloads, S.INFORMATION_FEED)


def hourly_forecast(day, slots=24, **values):
    metrics = {
        c: [float(10 * j + h) for h in range(slots)]
        for j, c in enumerate(S.WEATHER_HOURLY_METRICS)
    }
    times = [f"{day}T{h % 24:02d}:00" for h in range(slots)]
    return {"hourly": {"time": times, **metrics, **values}}


def hourly_file(folder, stamp, *payloads, schema=S.WEATHER_HOURLY_FEED):
    return write_file(folder, f"hourly_weather_{stamp}", payloads, schema)


def daily_forecast(day, **values):
    metrics = {
        c: [float(j) + d / 2 for d in range(7)]
        for j, c in enumerate(S.WEATHER_DAILY_METRICS)
    }
    return {"daily": {"time": [day] + ["later"] * 6, **metrics, **values}}


def daily_file(folder, stamp, *payloads, schema=S.WEATHER_DAILY_FEED):
    return write_file(folder, f"daily_weather_{stamp}", payloads, schema)


def rows(df, *columns):
    """Rows as a set of tuples."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    assert len(found) == len(set(found)), "duplicate rows"
    return set(found)
