from datetime import datetime

import pytest
from fixtures import (
    daily_file,
    daily_forecast,
    hourly_file,
    hourly_forecast,
    information_file,
    rows,
    station,
    stations,
    status_file,
)
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cityviews import schemas as S
from cityviews.plans import refresh, views
from cityviews.plans.registry import VIEWS, cells_spec
from cityviews.sinks.store import read_view
from cityviews.sources.files import read_payloads

H17, H18 = "2023-01-05_17-08-04-891", "2023-01-05_18-01-00-317"


def with_field(feed, name):
    """The feed with one more array of doubles."""
    struct = feed.fields[0]
    return StructType([StructField(struct.name, StructType(
        [*struct.dataType.fields, StructField(name, ArrayType(DoubleType()))]))])


def without_field(feed, name):
    struct = feed.fields[0]
    return StructType([StructField(struct.name, StructType(
        [f for f in struct.dataType.fields if f.name != name]))])


@pytest.mark.parametrize("name", list(VIEWS))
def test_view_columns_are_those_of_its_schema(spark, tmp_path, name):
    empty = read_payloads(spark, str(tmp_path), VIEWS[name].feed)
    view = VIEWS[name].build(empty)
    assert view.dtypes == [(f.name, f.dataType.simpleString()) for f in VIEWS[name].spec.schema]
    assert view.count() == 0


# ---------------------------------------------------------------------- weather
def test_weather_daily_takes_the_first_day(spark, tmp_path):
    daily_file(tmp_path, H17, daily_forecast("2023-01-05"))
    daily_file(tmp_path, H18, daily_forecast("2023-01-05", rain_sum=[9.5, 0.0]))
    daily_file(tmp_path, "2023-01-06_00-00-00-000", daily_forecast("2023-01-06"))
    view = views.weather_daily(read_payloads(spark, str(tmp_path), S.WEATHER_DAILY_FEED))
    assert rows(view, "row_key", "time", "temperature_2m_min", "rain_sum") == {
        ("2023-01-05", "2023-01-05", 1.0, 9.5), ("2023-01-06", "2023-01-06", 1.0, 5.0)}


def test_weather_hourly_takes_the_slot_of_the_hour(spark, tmp_path):
    hourly_file(tmp_path, H17, hourly_forecast("2023-01-05", slots=168))
    hourly_file(tmp_path, H18, hourly_forecast("2023-01-05"))
    view = views.weather_hourly(read_payloads(spark, str(tmp_path), S.WEATHER_HOURLY_FEED))
    assert rows(view, "row_key", "temperature_2m", "apparent_temperature", "version") == {
        ("2023-01-05T17:00", 17.0, 27.0, datetime(2023, 1, 5, 17, 8, 4, 891000)),
        ("2023-01-05T18:00", 18.0, 28.0, datetime(2023, 1, 5, 18, 1, 0, 317000))}
    assert views.off_slot(view).count() == 0


def test_short_array(spark, tmp_path):
    hourly_file(tmp_path, H17, hourly_forecast("2023-01-05", rain=[1.0] * 10))
    payloads = read_payloads(spark, str(tmp_path), S.WEATHER_HOURLY_FEED)
    with pytest.raises(Exception, match="array rain has no slot 17"):
        views.weather_hourly(payloads).collect()
    assert rows(views.weather_hourly(payloads, strict=False), "row_key", "rain") == {
        ("2023-01-05T17:00", None)}
    hourly_file(tmp_path / "all", H17, hourly_forecast("2023-01-05", slots=10))
    keyless = read_payloads(spark, str(tmp_path / "all"), S.WEATHER_HOURLY_FEED)
    assert views.weather_hourly(keyless, strict=False).count() == 0


def test_slot_of_another_hour_is_kept_and_found(spark, tmp_path):
    hourly_file(tmp_path, H17, hourly_forecast("2023-01-06"))
    view = views.weather_hourly(read_payloads(spark, str(tmp_path), S.WEATHER_HOURLY_FEED))
    assert rows(view, "row_key") == {("2023-01-06T17:00",)}
    assert rows(views.off_slot(view), "row_key") == {("2023-01-06T17:00",)}


def test_unmapped_weather_field_fails_before_a_write(spark, tmp_path):
    feed = with_field(S.WEATHER_DAILY_FEED, "uv_index_max")
    file = daily_file(tmp_path / "in", H17,
                      daily_forecast("2023-01-05", uv_index_max=[1.0]), schema=feed)
    target = tmp_path / "view"
    with pytest.raises(ValueError, match="uv_index_max"):
        refresh.refresh_from_file(spark, "weather_daily", file, str(target))
    assert read_view(spark, VIEWS["weather_daily"].spec, str(target)).count() == 0


def test_missing_weather_field(spark, tmp_path):
    """Null in the typed view; in the cells the older value stays."""
    path = str(tmp_path / "cells")
    older = daily_file(tmp_path, H17, daily_forecast("2023-01-05", rain_sum=[3.5]))
    newer = daily_file(tmp_path, H18, daily_forecast("2023-01-05", showers_sum=[None]),
                       schema=without_field(S.WEATHER_DAILY_FEED, "rain_sum"))
    typed = refresh.view_rows(spark, "weather_daily", newer)
    assert rows(typed, "rain_sum", "showers_sum") == {(None, None)}
    for file in (older, newer):
        refresh.refresh_cells_from_file(spark, "weather_daily", file, path)
    cells = read_view(spark, cells_spec("weather_daily"), path)
    found = {r["col"]: r["val"] for r in cells.collect()}
    assert len(found) == len(S.WEATHER_DAILY_FAMILIES)
    assert found["precipitation:rain_sum"] == "3.5"
    assert found["precipitation:showers_sum"] == "None"
    assert found["time:time"] == "2023-01-05"


# --------------------------------------------------------------------- stations
def test_information_daily(spark, tmp_path):
    lon, no_lon = {"member0": None, "member1": 2.25}, {"member0": 2.5, "member1": None}
    information_file(tmp_path, H17, stations(
        station("s1", lon=lon, lat=None, name="old", capacity=10),
        station("s2", lon=no_lon, has_kiosk=True)))
    information_file(tmp_path, H18, stations(station("s1", lon=lon, name="new", capacity=None)))
    information_file(tmp_path, "2023-01-06_09-00-00-000", stations(station("s1", name="next")))
    payloads = read_payloads(spark, str(tmp_path), S.INFORMATION_FEED)
    columns = ["row_key", "name", "capacity", "lon", "lat", "has_kiosk"]
    assert rows(views.information_daily(payloads), *columns) == {
        ("2023-01-05_s1", "new", None, 2.25, None, None),
        ("2023-01-05_s2", None, None, None, None, True),
        ("2023-01-06_s1", "next", None, None, None, None)}
    repaired = views.information_daily(payloads, repair=True).where("station_id = 's2'")
    assert rows(repaired, "lon") == {(2.5,)}


def test_status_hourly(spark, tmp_path):
    status_file(tmp_path, H17, stations(
        station("s1", num_bikes_available=4, num_docks_available=None),
        station("s2", num_bikes_available=1),
        station(None, num_bikes_available=8)))
    status_file(tmp_path, "2023-01-05_17-40-00-000",
                stations(station("s1", num_bikes_available=None)),
                stations(station("s1", num_bikes_available=7)))
    status_file(tmp_path, H18, stations(station("s1", num_bikes_available=100)))
    payloads = read_payloads(spark, str(tmp_path), S.STATUS_HOURLY_FEED)
    columns = ["row_key", "num_bikes_available", "num_docks_available"]
    expected = {
        ("2023-01-05_17_s1", 5.5, None), ("2023-01-05_17_s2", 1.0, None),
        ("2023-01-05_17_None", 8.0, None), ("2023-01-05_18_s1", 100.0, None)}
    assert rows(views.status_hourly(payloads), *columns) == expected
    from_parts = views.status_hourly_from_parts(views.status_hourly_parts(payloads))
    assert rows(from_parts, *columns) == expected
    assert from_parts.columns == views.status_hourly(payloads).columns
    triggered = views.status_hourly(payloads, trigger_stamp="2023-01-05_19")
    assert rows(triggered, *columns) == {("2023-01-05_18_s1", 100.0, None)}


def test_trigger_at_midnight_covers_the_day_before(spark, tmp_path):
    status_file(tmp_path, "2022-12-31_23-59-00-000", stations(station("s1")))
    trigger = status_file(tmp_path, "2023-01-01_00-01-00-000", stations(station("s1")))
    view = refresh.view_rows(spark, "status_hourly", trigger)
    assert rows(view, "row_key") == {("2022-12-31_23_s1",)}


def test_hour_without_files_gives_no_rows(spark, tmp_path):
    trigger = status_file(tmp_path, H17, stations(station("s1")))
    view = refresh.view_rows(spark, "status_hourly", trigger)
    assert view.count() == 0
    assert view.columns == VIEWS["status_hourly"].spec.schema.fieldNames()


def test_two_legacy_ids_of_one_station(spark, tmp_path):
    status_file(tmp_path, H17, stations(
        station("s1", "l1", num_bikes_available=9), station("s1", "l2", num_bikes_available=2),
        station("s1", None, num_bikes_available=5)))
    view = views.status_hourly(read_payloads(spark, str(tmp_path), S.STATUS_HOURLY_FEED))
    assert view.count() == 3
    keyed = views.keyed_status_hourly(view)
    assert rows(keyed, "row_key", "legacy_id", "num_bikes_available") == {
        ("2023-01-05_17_s1", "l2", 2.0)}
    cells = refresh.view_cells(view, "status_hourly")
    assert rows(cells.where("col = 'id:legacy_id'"), "val") == {("l2",)}


def test_status_live(spark, tmp_path):
    status_file(tmp_path, H17, stations(
        station("s1", num_bikes_available=1, last_reported=99), station("gone")))
    status_file(tmp_path, H18, stations(
        station("s1", num_bikes_available=None, last_reported=5)))
    view = views.status_live(read_payloads(spark, str(tmp_path), S.STATUS_FEED))
    assert rows(view, "row_key", "num_bikes_available", "last_reported") == {
        ("s1", None, 5), ("gone", None, None)}


def test_payloads_without_stations(spark, tmp_path):
    status_file(tmp_path, H17, stations(), {"data": {"stations": None}}, {"data": None})
    payloads = read_payloads(spark, str(tmp_path), S.STATUS_FEED)
    assert views.status_live(payloads).count() == 0
    assert views.status_hourly(payloads).count() == 0


def test_two_payloads_with_one_key_in_one_file(spark, tmp_path):
    status_file(tmp_path, H17,
                stations(station("s1", "l1", num_bikes_disabled=5)),
                stations(station("s1", "l2", num_bikes_disabled=1)))
    view = views.status_live(read_payloads(spark, str(tmp_path), S.STATUS_FEED))
    assert rows(view, "legacy_id", "num_bikes_disabled") == {("l2", 1)}


def test_a_mapped_field_that_is_no_array(spark):
    payloads = spark.sql("""SELECT TIMESTAMP_NTZ '2023-01-05 06:00:00' AS stamp_ts,
        named_struct('time', array('2023-01-05'), 'rain_sum', 1.0D) AS daily""")
    with pytest.raises(ValueError, match="rain_sum"):
        views.weather_daily(payloads)
