import shutil

import pytest
from fixtures import hourly_file, hourly_forecast, rows, station, stations, status_file

from cityviews.__main__ import arguments, run
from cityviews.plans.registry import VIEWS, cells_spec
from cityviews.sinks.store import read_view


def call(spark, *words):
    run(spark, arguments([str(w) for w in words]))


def keys(spark, name, path):
    return rows(read_view(spark, VIEWS[name].spec, str(path)), "row_key")


def test_refresh_show_compact_reset(spark, tmp_path, capsys):
    view = tmp_path / "view"
    for hour in (17, 18):
        file = status_file(
            tmp_path / "feed", f"2023-01-05_{hour}-00-00-000", stations(station(f"s{hour}")))
        call(spark, "refresh", "status_live", file, view)
        call(spark, "refresh", "status_live", file, tmp_path / "cells", "--cells")
    assert keys(spark, "status_live", view) == {("s17",), ("s18",)}
    call(spark, "compact", "status_live", view)
    call(spark, "show", "status_live", view)
    call(spark, "show", "status_live", tmp_path / "cells", "--cells")
    shown = capsys.readouterr().out
    assert "s18" in shown and "metric:num_bikes_available" in shown
    call(spark, "reset", "status_live", view)
    assert keys(spark, "status_live", view) == set()


def test_backfill_follow_gaps(spark, tmp_path, capsys):
    feed = tmp_path / "feed"
    for hour in (16, 17, 19):
        hourly_file(feed, f"2023-01-05_{hour}-00-00-000", hourly_forecast("2023-01-05"))
    call(spark, "backfill", "weather_hourly", feed, tmp_path / "a",
         "2023-01-05_17", "2023-01-05_19")
    assert keys(spark, "weather_hourly", tmp_path / "a") == {
        ("2023-01-05T17:00",), ("2023-01-05T19:00",)}
    call(spark, "follow", "weather_hourly", feed, tmp_path / "b", tmp_path / "checkpoint",
         "--files-per-batch", 2)
    assert len(keys(spark, "weather_hourly", tmp_path / "b")) == 3
    call(spark, "gaps", feed, "2023-01-05_16", "2023-01-05_19")
    shown = capsys.readouterr().out
    assert "2023-01-05_18" in shown and "2023-01-05_17" not in shown


def test_gaps_prints_every_hour(spark, tmp_path, capsys):
    hourly_file(tmp_path / "feed", "2023-01-05_16-00-00-000", hourly_forecast("2023-01-05"))
    call(spark, "gaps", tmp_path / "feed", "2023-01-01_00", "2023-03-31_23")
    shown = capsys.readouterr().out.split()
    assert len([w for w in shown if w.startswith("2023-")]) == 90 * 24 - 1
    assert "2023-03-31_23" in shown


def test_means_of_an_hour_that_comes_in_two_batches(spark, tmp_path):
    feed, view = tmp_path / "feed", tmp_path / "view"
    for minute, bikes in ((5, 0), (35, 10)):
        status_file(feed, f"2023-01-05_17-{minute:02d}-00-000",
                    stations(station("s1", num_bikes_available=bikes)))
        call(spark, "follow", "status_hourly", feed, view, tmp_path / "checkpoint")
    spec = VIEWS["status_hourly"].spec
    assert rows(read_view(spark, spec, str(view)), "num_bikes_available") == {(5.0,)}
    call(spark, "follow", "status_hourly", feed, tmp_path / "one", tmp_path / "other",
         "--files-per-batch", 1)
    call(spark, "backfill", "status_hourly", feed, tmp_path / "one",
         "2023-01-05_17", "2023-01-05_17")
    one = read_view(spark, spec, str(tmp_path / "one"))
    assert rows(one, "num_bikes_available") == {(5.0,)}


def test_newest_file_of_a_folder(spark, tmp_path):
    for hour in (16, 18, 17):
        status_file(tmp_path / "feed", f"2023-01-05_{hour}-00-00-000",
                    stations(station(f"s{hour}")))
    call(spark, "refresh", "status_live", tmp_path / "feed", tmp_path / "view", "--latest")
    assert keys(spark, "status_live", tmp_path / "view") == {("s18",)}


def test_another_form_of_a_view_is_refused(spark, tmp_path):
    file = status_file(
        tmp_path / "feed", "2023-01-05_17-00-00-000", stations(station("s1")))
    path, spec = str(tmp_path / "cells"), cells_spec("status_live")
    call(spark, "refresh", "status_live", file, path, "--cells")
    before = rows(read_view(spark, spec, path))
    for command in ("compact", "show", "reset"):
        with pytest.raises(ValueError, match="holds status_live_cells"):
            call(spark, command, "status_live", path)
    with pytest.raises(ValueError, match="holds status_live_cells"):
        call(spark, "refresh", "status_live", file, path)
    call(spark, "compact", "status_live", path, "--cells")
    assert rows(read_view(spark, spec, path)) == before and before


def test_fields_that_some_weather_files_lack(spark, tmp_path):
    """A backfill and a stream store what a refresh file by file does."""
    feed = tmp_path / "feed"
    schema = "daily struct<time array<string>, %s array<double>>"
    for day, field, value in (("05", "temperature_2m_max", 3.0), ("06", "rain_sum", 7.0)):
        days = [f"2023-01-{day}"]
        spark.createDataFrame([((days, [value]),)], schema % field).coalesce(1).write.parquet(
            str(tmp_path / day))
        feed.mkdir(exist_ok=True)
        part = next((tmp_path / day).glob("*.parquet"))
        shutil.copy(part, feed / f"weather_2023-01-{day}_06-00-00-000.parquet")
    call(spark, "backfill", "weather_daily", feed, tmp_path / "a", "2023-01-05_00", "2023-01-06_23")
    call(spark, "follow", "weather_daily", feed, tmp_path / "b", tmp_path / "checkpoint")
    for file in sorted(feed.iterdir()):
        call(spark, "refresh", "weather_daily", file, tmp_path / "c")
    spec = VIEWS["weather_daily"].spec
    a, b, c = (rows(read_view(spark, spec, str(tmp_path / p)),
                    "row_key", "temperature_2m_max", "rain_sum") for p in "abc")
    assert a == b == c == {("2023-01-05", 3.0, None), ("2023-01-06", None, 7.0)}


def test_follow_refuses_a_field_without_a_family(spark, tmp_path):
    feed = tmp_path / "feed"
    spark.createDataFrame(
        [((["2023-01-05"], [1.0]),)], "daily struct<time array<string>, odd array<double>>"
    ).coalesce(1).write.parquet(str(feed))
    with pytest.raises(ValueError, match="odd"):
        call(spark, "follow", "weather_daily", feed, tmp_path / "v", tmp_path / "checkpoint")
    assert not (tmp_path / "v").exists()


def test_unknown_view(capsys):
    with pytest.raises(SystemExit):
        arguments(["show", "no_such_view", "x"])
