"""Feeds as folders of files: differing types, folders by day and hour, ledgers, touched hours."""

import pytest
from fixtures import daily_file, daily_forecast, hourly_file, hourly_forecast, rows, station, stations, status_file, write_file
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from cityviews import schemas as S
from cityviews.__main__ import arguments, run
from cityviews.operators.shape import explode_entities
from cityviews.plans import refresh, views
from cityviews.plans.registry import VIEWS, cells_spec
from cityviews.plans.table_feeds import write_feed
from cityviews.sinks import store
from cityviews.sinks.store import read_view
from cityviews.sources import drift, files
from cityviews.streaming.refresh import follow_files, touched_files

DOUBLES = StructType([StructField("data", StructType([StructField("stations", ArrayType(StructType([
    StructField(f.name, DoubleType() if f.name in S.STATUS_METRICS else f.dataType)
    for f in S.STATUS_FEED["data"].dataType["stations"].dataType.elementType.fields])))]))])


def daily_schema(**metrics):
    return StructType([StructField("daily", StructType([
        StructField("time", ArrayType(StringType())),
        *[StructField(k, ArrayType(v)) for k, v in metrics.items()]]))])


def call(spark, *argv):
    run(spark, arguments([str(a) for a in argv]))


def mixed_status(folder, minutes=(5, 25, 45), hour="2023-01-05_17"):
    for i, minute in enumerate(minutes):
        status_file(folder, f"{hour}-{minute:02d}-00-000", stations(station("s1", num_bikes_available=i)))
        write_file(folder, f"station_status_{hour}-{minute + 5:02d}-00-000",
                   [stations(station("s1", num_bikes_available=i + 0.5))], DOUBLES)
    return str(folder)


def laid_out(spark, folder, stamps):
    payloads = spark.createDataFrame(
        [(s, (([{"station_id": s}],))) for s in stamps],
        "t string, data struct<stations:array<struct<station_id:string>>>")
    write_feed(payloads.select(F.col("t").cast("timestamp_ntz").alias("stamp_ts"), "data"), folder)


def test_files_of_differing_types_are_one_read(spark, tmp_path):
    folder = mixed_status(tmp_path / "feed")
    listed = files.list_files(spark, folder)
    groups = drift.schema_groups(listed, VIEWS["status_hourly"].feed)
    assert sorted(len(g.paths) for g in groups) == [3, 3]
    whole = drift.read_files(listed, VIEWS["status_hourly"].feed, open_fields=True)
    entities = explode_entities(whole, "data.stations", ["num_bikes_available"], keep=["stamp_ts"])
    assert rows(entities, "num_bikes_available") == {(x / 2,) for x in range(6)}
    assert drift.read_files(listed.limit(0), VIEWS["status_hourly"].feed).count() == 0


def test_types_without_a_common_one_are_refused(spark, tmp_path):
    write_file(tmp_path, "w_2023-01-05_17-00-00-000", [{"daily": {"time": ["x"], "rain_sum": ["wet"]}}],
               daily_schema(rain_sum=StringType()))
    write_file(tmp_path, "w_2023-01-05_18-00-00-000", [{"daily": {"time": ["x"], "rain_sum": [1.0]}}],
               daily_schema(rain_sum=DoubleType()))
    with pytest.raises(ValueError, match="no type holds"):
        drift.read_files(files.list_files(spark, str(tmp_path)), S.WEATHER_DAILY_FEED, open_fields=True)


def test_backfill_and_follow_take_mixed_types(spark, tmp_path):
    feed = mixed_status(tmp_path / "feed")
    call(spark, "backfill", "status_hourly", feed, tmp_path / "a", "2023-01-05_17", "2023-01-05_17")
    call(spark, "follow", "status_hourly", feed, tmp_path / "b", tmp_path / "checkpoint", "--files-per-batch", 4)
    spec = VIEWS["status_hourly"].spec
    found = rows(read_view(spark, spec, str(tmp_path / "a")), "row_key", "num_bikes_available")
    assert found == {("2023-01-05_17_s1", 1.25)}
    assert rows(read_view(spark, spec, str(tmp_path / "b")), "row_key", "num_bikes_available") == found


def test_folders_by_day_and_hour(spark, tmp_path, capsys):
    folder = str(tmp_path / "feed")
    laid_out(spark, folder, ["2023-01-05 17:30:00", "2023-01-05 18:00:00", "2023-01-06 00:10:00", "2024-01-05 17:00:00"])
    assert "/day=2024-01-05/hour=17/" in files.latest_file(spark, folder)
    assert files.list_files(spark, folder, "2023-01-05_17", "2023-01-05_18").count() == 2
    feed = VIEWS["status_live"].feed
    hour = files.read_payloads(spark, folder, feed, hour="2023-01-05_18")
    assert hour.columns == ["data", "stamp_ts"]
    assert [str(r["stamp_ts"]) for r in hour.collect()] == ["2023-01-05 18:00:00"]
    hour.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: ")[1].split("\n")[0]
    some = files.read_payloads(spark, folder, feed, first="2023-01-05_18", last="2023-01-06_00")
    assert some.count() == 2
    one = files.latest_file(spark, folder)
    assert [str(r["stamp_ts"]) for r in files.read_payloads(spark, one, feed).collect()] == ["2024-01-05 17:00:00"]


def test_a_late_file_opens_its_hours_only(spark, tmp_path):
    feed = tmp_path / "feed"
    for stamp in ("2022-01-05_17-00-00-000", "2022-06-01_00-00-00-000", "2022-09-01_00-00-00-000",
                  "2023-01-05_17-00-00-000", "2023-01-05_17-30-00-000"):
        status_file(feed, stamp, stations(station(stamp)))
    arrived = files.list_files(spark, str(feed)).where(
        "stamp_ts < timestamp_ntz '2022-02-01' or stamp_ts >= timestamp_ntz '2023-01-05 17:30:00'")
    touched = touched_files(spark, str(feed), arrived)
    assert touched.count() == 3  # of two hours
    payloads = drift.read_files(touched, VIEWS["status_hourly"].feed)
    payloads.collect()
    scan = payloads._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 3


def test_cells_of_a_backfill_equal_those_of_single_files(spark, tmp_path):
    feed = tmp_path / "feed"
    kinds = [dict(rain_sum=LongType()), dict(rain_sum=DoubleType(), snowfall_sum=DoubleType()),
             dict(snowfall_sum=LongType())]
    found = [write_file(feed, f"daily_weather_2023-01-0{1 + i // 3}_0{i}-00-00-000",
                        [{"daily": {"time": [f"2023-01-0{1 + i // 3}"],
                                    **{k: [None if (i + j) % 4 == 1 else i] for j, k in enumerate(kinds[i % 3])}}}],
                        daily_schema(**kinds[i % 3])) for i in range(9)]
    for file in reversed(found):
        refresh.refresh_cells_from_file(spark, "weather_daily", file, str(tmp_path / "one"))
    call(spark, "backfill", "weather_daily", feed, tmp_path / "all", "2023-01-01_00", "2023-01-03_23", "--cells")
    call(spark, "follow", "weather_daily", feed, tmp_path / "new", tmp_path / "checkpoint", "--cells", "--files-per-batch", 4)
    state = [rows(read_view(spark, cells_spec("weather_daily"), str(tmp_path / k)), "row_key", "col", "val")
             for k in ("one", "all", "new")]
    assert state[0] == state[1] == state[2]
    values = {v for _, c, v in state[0] if c != "time:time"}
    assert "None" in values and "8" in values and "7.0" in values  # whole numbers stay whole


def test_sums_count_a_file_once_whichever_way_it_comes(spark, tmp_path):
    feed, view = str(tmp_path / "feed"), str(tmp_path / "v")
    spec = VIEWS["status_hourly_parts"].spec
    for minute in (5, 10, 15):
        status_file(feed, f"2023-01-05_17-{minute:02d}-00-000", stations(station("s1", num_bikes_available=minute)))
    call(spark, "follow", "status_hourly_parts", feed, view, tmp_path / "checkpoint", "--files-per-batch", 2)
    last = status_file(feed, "2023-01-05_17-20-00-000", stations(station("s1", num_bikes_available=20)))

    def state():
        return rows(views.status_hourly_from_parts(read_view(spark, spec, view)), "row_key", "num_bikes_available")

    assert state() == {("2023-01-05_17_s1", 10.0)}
    for _ in range(2):
        call(spark, "backfill", "status_hourly_parts", feed, view, "2023-01-05_17", "2023-01-05_17")
        assert state() == {("2023-01-05_17_s1", 12.5)}
        store.compact_view(spark, spec, view)
    call(spark, "refresh", "status_hourly_parts", last, view)
    call(spark, "follow", "status_hourly_parts", feed, view, tmp_path / "checkpoint")
    store.compact_view(spark, spec, view)
    assert state() == {("2023-01-05_17_s1", 12.5)}


def test_a_ledger_without_its_batch_does_not_count(spark, tmp_path):
    feed, view, spec = str(tmp_path / "feed"), str(tmp_path / "v"), VIEWS["status_hourly_parts"].spec
    file = status_file(feed, "2023-01-05_17-05-00-000", stations(station("s1", num_bikes_available=3)))
    store.create_view(spark, spec, view)
    listed = refresh.files_of(spark, file)
    listed.select("file").write.parquet(f"{view}/ledger/era=0/batch=0/source=lost")
    assert store.uncounted(listed, spec, view).count() == 1
    call(spark, "refresh", "status_hourly_parts", file, view)
    assert store.uncounted(listed, spec, view).count() == 0


def test_stale_hours_alone_are_written_again(spark, tmp_path):
    feed, view, spec = tmp_path / "feed", str(tmp_path / "v"), VIEWS["status_hourly"].spec
    for hour in (16, 17, 18):
        status_file(feed, f"2023-01-05_{hour}-05-00-000", stations(station("s1", num_bikes_available=hour)))
    span = ("2023-01-05_16", "2023-01-05_18")
    call(spark, "backfill", "status_hourly", feed, view, *span)
    call(spark, "backfill", "status_hourly", feed, view, *span, "--stale")
    assert store.next_batch(spark, spec, view) == 1  # nothing was written
    status_file(feed, "2023-01-05_17-30-00-000", stations(station("s1", num_bikes_available=27)))
    stale = refresh.stale_hours(spark, "status_hourly", view, refresh.files_of(spark, str(feed), *span))
    assert stale.count() == 2  # both files of the hour
    call(spark, "backfill", "status_hourly", feed, view, *span, "--stale")
    assert rows(read_view(spark, spec, view), "row_key", "num_bikes_available") == {
        ("2023-01-05_16_s1", 16.0), ("2023-01-05_17_s1", 22.0), ("2023-01-05_18_s1", 18.0)}


def test_rule_slots_and_means_at_the_command_line(spark, tmp_path, capsys):
    feed = tmp_path / "feed"
    new = status_file(feed, "2023-01-05_18-00-00-000", stations(station("s1", is_renting=2)))
    old = status_file(feed, "2023-01-05_17-00-00-000", stations(station("s1", is_renting=1)))
    for file in (new, old):
        call(spark, "refresh", "status_live", file, tmp_path / "v", "--rule", "ingest")
    call(spark, "show", "status_live", tmp_path / "v", "--rule", "ingest")
    ingest = capsys.readouterr().out
    call(spark, "show", "status_live", tmp_path / "v")
    assert "17:00:00" in ingest and "18:00:00" in capsys.readouterr().out
    with pytest.raises(ValueError, match="rule add only"):
        call(spark, "show", "status_hourly_parts", tmp_path / "v", "--rule", "ingest")
    call(spark, "backfill", "status_hourly_parts", feed, tmp_path / "p", "2023-01-05_17", "2023-01-05_18")
    call(spark, "show", "status_hourly_parts", tmp_path / "p")
    shown = capsys.readouterr().out
    assert "num_bikes_available" in shown and "_count" not in shown
    weather = tmp_path / "weather"
    hourly_file(weather, "2023-01-05_17-00-00-000", hourly_forecast("2023-01-05"))
    hourly_file(weather, "2023-01-06_18-00-00-000", hourly_forecast("2023-01-05"))
    call(spark, "slots", weather, "2023-01-05_00", "2023-01-06_23")
    assert "1 hours off their slot" in capsys.readouterr().out
