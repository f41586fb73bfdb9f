from datetime import datetime
from pathlib import Path

import pytest
from fixtures import hourly_file, hourly_forecast, rows, station, stations, status_file
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from cityviews.plans import refresh
from cityviews.plans.registry import VIEWS, cells_spec
from cityviews.plans.views import status_hourly_from_parts
from cityviews.sinks import store
from cityviews.sinks.store import ViewSpec
from cityviews.sinks.workdir import work_folder
from cityviews.sources.files import read_payloads

SCHEMA = StructType([
    StructField("row_key", StringType()), StructField("n", LongType()),
    StructField("version", TimestampNTZType())])
SPEC = ViewSpec("sample", SCHEMA, period=7)


def frame(spark, *data):
    return spark.createDataFrame(
        [(key, n, datetime(2023, 1, 1, hour)) for key, n, hour in data], SCHEMA)


def state(spark, path, spec=SPEC):
    return rows(store.read_view(spark, spec, path), "row_key", "n")


def test_create_only_if_absent(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    assert state(spark, path) == set()
    store.upsert_view(frame(spark, ("2023-01-01_a", 1, 1)), SPEC, path, 0)
    store.create_view(spark, SPEC, path)
    assert state(spark, path) == {("2023-01-01_a", 1)}


def test_newest_version_wins_and_other_keys_stay(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(
        frame(spark, ("2023-01-01_a", 1, 5), ("2023-02-01_b", 2, 5)), SPEC, path, 0)
    store.upsert_view(frame(spark, ("2023-01-01_a", None, 6)), SPEC, path, 1)
    store.upsert_view(frame(spark, ("2023-01-01_a", 9, 4)), SPEC, path, 2)
    assert state(spark, path) == {("2023-01-01_a", None), ("2023-02-01_b", 2)}
    ingest = ViewSpec("sample", SCHEMA, period=7, rule="ingest")
    assert state(spark, path, ingest) == {("2023-01-01_a", 9), ("2023-02-01_b", 2)}


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(
        frame(spark, ("2023-01-01_a", 1, 5), ("2023-02-01_b", 2, 5)), SPEC, path, 0)
    store.upsert_view(frame(spark, ("2023-01-01_a", 3, 5)), SPEC, path, 0)
    assert state(spark, path) == {("2023-01-01_a", 3)}


def test_a_batch_without_a_number_is_a_new_one(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    for n in (1, 2, 3):
        store.upsert_view(frame(spark, (f"2023-01-01_{n}", n, 1)), SPEC, path)
        if n == 2:
            store.compact_view(spark, SPEC, path)
    assert len(state(spark, path)) == 3 and store.next_batch(spark, SPEC, path) == 3
    with pytest.raises(ValueError, match="needs a number"):
        store.upsert_view(frame(spark), ViewSpec("x", SCHEMA, rule="add"), path)


def test_a_named_source_counts_once(spark, tmp_path):
    path, spec = str(tmp_path / "v"), VIEWS["status_hourly_parts"].spec
    file = status_file(tmp_path / "feed", "2023-01-05_17-00-00-000",
                       stations(station("s1", num_bikes_available=3)))
    parts = VIEWS["status_hourly_parts"].build(
        read_payloads(spark, file, VIEWS["status_hourly_parts"].feed))
    count = lambda: rows(
        store.read_view(spark, spec, path), "num_bikes_available_count")
    store.create_view(spark, spec, path)
    for source in ("a-0", "b-0", "a-0", "b-0"):
        store.upsert_once(parts, spec, path, source)
    assert count() == {(2,)}
    store.compact_view(spark, spec, path)
    store.upsert_once(parts, spec, path, "a-0")
    assert count() == {(2,)}
    # The next number of one source does not replace a batch of the other.
    for source in ("a-1", "b-1", "a-1"):
        store.upsert_once(parts, spec, path, source)
    assert count() == {(4,)}


@pytest.mark.parametrize("rule", ["version", "ingest"])
def test_compaction_keeps_the_state(spark, tmp_path, rule):
    spec, path = ViewSpec("sample", SCHEMA, period=7, rule=rule), str(tmp_path / "v")
    store.create_view(spark, spec, path)
    store.compact_view(spark, spec, path)
    for batch, (n, hour) in enumerate([(1, 5), (2, 6), (3, 4)]):
        store.upsert_view(
            frame(spark, ("2023-01-01_a", n, hour), (f"2023-01-0{batch + 1}_b", n, hour)),
            spec, path, batch)
    before = state(spark, path, spec)
    store.compact_view(spark, spec, path, upto=1)
    assert state(spark, path, spec) == before
    store.compact_view(spark, spec, path)
    assert state(spark, path, spec) == before
    store.upsert_view(frame(spark, ("2023-01-01_a", 7, 7)), spec, path, 3)
    assert ("2023-01-01_a", 7) in state(spark, path, spec)
    with pytest.raises(ValueError, match="compacted"):
        store.upsert_view(frame(spark), spec, path, 2)


def test_compaction_rewrites_only_periods_with_new_rows(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(
        frame(spark, ("2023-01-01_a", 1, 1), ("2023-02-01_b", 1, 1)), SPEC, path, 0)
    store.compact_view(spark, SPEC, path)
    store.upsert_view(
        frame(spark, ("2023-02-01_b", 2, 2), ("2023-03-01_c", 1, 1)), SPEC, path, 1)
    store.compact_view(spark, SPEC, path)
    expected = {("2023-01-01_a", 1), ("2023-02-01_b", 2), ("2023-03-01_c", 1)}
    assert state(spark, path) == expected
    bases = sorted(str(p.relative_to(path)) for p in Path(path).glob("base/*/*/period=*"))
    assert bases == [
        "base/era=0/upto=0/period=2023-01", "base/era=0/upto=0/period=2023-02",
        "base/era=0/upto=1/period=2023-02", "base/era=0/upto=1/period=2023-03"]
    assert rows(store.read_view(spark, SPEC, path, "2023-02-01"), "n") == {(2,)}
    # A key that is only in the replaced base is gone with it: nothing else reads it.
    store.upsert_view(frame(spark, ("2023-01-01_a", 5, 5)), SPEC, path, 2)
    assert ("2023-01-01_a", 5) in state(spark, path)


def test_a_compaction_of_empty_batches(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(frame(spark, ("2023-01-01_a", 1, 1)), SPEC, path, 0)
    store.upsert_view(frame(spark), SPEC, path, 1)
    store.compact_view(spark, SPEC, path, upto=0)
    store.compact_view(spark, SPEC, path, upto=1)
    assert state(spark, path) == {("2023-01-01_a", 1)}


def test_unpublished_compaction_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(frame(spark, ("2023-01-01_a", 1, 5)), SPEC, path, 0)
    stray = frame(spark, ("2023-01-01_x", 1, 9)).selectExpr("*", "0L AS batch")
    stray.write.parquet(f"{path}/base/era=0/upto=0/period=2023-01")
    assert state(spark, path) == {("2023-01-01_a", 1)}
    store.compact_view(spark, SPEC, path)
    assert state(spark, path) == {("2023-01-01_a", 1)}


def test_reset(spark, tmp_path):
    path = str(tmp_path / "v")
    store.reset_view(spark, SPEC, path)
    store.upsert_view(frame(spark, ("2023-01-01_a", 1, 5)), SPEC, path, 4)
    store.compact_view(spark, SPEC, path)
    store.reset_view(spark, SPEC, path)
    assert state(spark, path) == set()
    store.upsert_view(frame(spark, ("2023-01-01_b", 1, 5)), SPEC, path, 4)
    assert state(spark, path) == {("2023-01-01_b", 1)}
    assert not list(Path(path).glob("log/era=1/**/period=*/*.parquet"))


def test_a_range_of_days_reads_its_folders_only(spark, tmp_path, capsys):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(frame(spark, *[
        (f"2023-{m:02d}-{d:02d}_s", m * 100 + d, 1) for m in (1, 2, 3) for d in (1, 31)
        if (m, d) != (2, 31)]), SPEC, path, 0)
    view = store.read_view(spark, SPEC, path, "2023-01-31", "2023-02-28")
    assert rows(view, "row_key") == {("2023-01-31_s",), ("2023-02-01_s",)}
    assert rows(store.read_view(spark, SPEC, path, "2023-03-31"), "n") == {(331,)}
    view.explain("formatted")
    plan = capsys.readouterr().out
    assert "(period" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert "GreaterThanOrEqual(row_key,2023-01-31)" in plan
    with pytest.raises(ValueError):
        store.read_view(
            spark, ViewSpec("x", SCHEMA, period=None), path, "2023-01-01").collect()


def test_open_view_by_name(spark, tmp_path):
    path = str(tmp_path / "v")
    store.create_view(spark, SPEC, path)
    store.upsert_view(frame(spark, ("2023-01-01_a", 1, 5)), SPEC, path, 0)
    store.open_view(spark, SPEC, path)
    assert rows(spark.sql("SELECT row_key, n FROM sample")) == {("2023-01-01_a", 1)}


def test_parts_add_up_over_batches(spark, tmp_path):
    view, path = VIEWS["status_hourly_parts"], str(tmp_path / "view")
    store.create_view(spark, view.spec, path)
    for batch, bikes in enumerate((1, 4, None)):
        file = status_file(tmp_path, f"2023-01-05_17-0{batch}-00-000",
                           stations(station("s1", num_bikes_available=bikes)))
        parts = view.build(read_payloads(spark, file, view.feed))
        for _ in range(2):  # a replay counts once
            store.upsert_view(parts, view.spec, path, batch)
        if batch == 1:
            store.compact_view(spark, view.spec, path)
    final = status_hourly_from_parts(store.read_view(spark, view.spec, path))
    assert rows(final, "row_key", "num_bikes_available", "num_docks_available") == {
        ("2023-01-05_17_s1", 2.5, None)}


def test_refresh_from_files_in_any_order(spark, tmp_path):
    path, spec = str(tmp_path / "view"), VIEWS["status_live"].spec
    newer = status_file(tmp_path, "2023-01-05_18-00-00-000", stations(station("s1", "new")))
    older = status_file(tmp_path, "2023-01-05_17-00-00-000",
                        stations(station("s1", "old"), station("gone")))
    for file in (newer, older, older):
        refresh.refresh_from_file(spark, "status_live", file, path)
    assert rows(store.read_view(spark, spec, path), "row_key", "legacy_id") == {
        ("s1", "new"), ("gone", "l1")}


def test_ingest_rule_lets_a_replayed_file_win(spark, tmp_path):
    path = str(tmp_path / "view")
    newer = status_file(tmp_path, "2023-01-05_18-00-00-000", stations(station("s1", "new")))
    older = status_file(tmp_path, "2023-01-05_17-00-00-000", stations(station("s1", "old")))
    for file in (newer, older):
        refresh.refresh_cells_from_file(spark, "status_live", file, path, rule="ingest")
    cells = store.read_view(spark, cells_spec("status_live", "ingest"), path)
    assert rows(cells.where("col = 'id:legacy_id'"), "val") == {("old",)}


def test_recomputed_hour_replaces_the_older_result(spark, tmp_path):
    feed, path, spec = tmp_path / "feed", str(tmp_path / "view"), VIEWS["status_hourly"].spec
    status_file(feed, "2023-01-05_17-30-00-000", stations(station("s1", num_bikes_available=8)))
    trigger = status_file(feed, "2023-01-05_18-00-00-000", stations(station("s1")))
    refresh.refresh_from_file(spark, "status_hourly", trigger, path)
    status_file(feed, "2023-01-05_17-10-00-000", stations(station("s1", num_bikes_available=4)))
    again = status_file(feed, "2023-01-05_18-30-00-000", stations(station("s1")))
    refresh.refresh_from_file(spark, "status_hourly", again, path)
    assert rows(store.read_view(spark, spec, path), "row_key", "num_bikes_available") == {
        ("2023-01-05_17_s1", 6.0)}


def test_backfill(spark, tmp_path):
    folder, path = tmp_path / "hourly_weather", str(tmp_path / "view")
    for hour in (16, 17, 18, 19):
        hourly_file(folder, f"2023-01-05_{hour}-01-00-000", hourly_forecast("2023-01-05"))
    for hour in (17, 18):
        refresh.backfill(spark, "weather_hourly", str(folder), path,
                         f"2023-01-05_{hour}", f"2023-01-05_{hour}")
    assert rows(store.read_view(spark, VIEWS["weather_hourly"].spec, path), "row_key", "rain") == {
        ("2023-01-05T17:00", 47.0), ("2023-01-05T18:00", 48.0)}


def test_work_folder_is_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(shared)
    assert work_folder(spark, "x") != work_folder(spark, "x")


def half(spark, spec, path, batch, source, *data):
    """A batch whose job was lost while it wrote: some rows, no mark."""
    store.upsert_view(frame(spark, *data), spec, path, batch, source)
    for mark in Path(path, "log", "era=0", f"batch={batch}", f"source={source}").glob("*_SUCCESS*"):
        mark.unlink()


def test_a_half_written_batch_counts_only_once_it_is_whole(spark, tmp_path):
    path = str(tmp_path / "v")
    whole = [(f"2023-01-01_{i:03d}", i, 5) for i in range(100)]
    store.create_view(spark, SPEC, path)
    store.upsert_once(frame(spark, ("2023-01-01_x", 1, 1)), SPEC, path, "s-0")
    half(spark, SPEC, path, 1, "s-1", *whole[:50])
    assert state(spark, path) == {("2023-01-01_x", 1)} and store.next_batch(spark, SPEC, path) == 1
    store.upsert_once(frame(spark, ("2023-01-01_y", 2, 2)), SPEC, path, "t-0")
    store.compact_view(spark, SPEC, path)
    assert store.source_batch(spark, SPEC, path, "s-1") is None
    store.upsert_once(frame(spark, *whole), SPEC, path, "s-1")
    assert len(state(spark, path)) == 102
    store.compact_view(spark, SPEC, path)
    assert len(state(spark, path)) == 102


@pytest.mark.parametrize("period", [7, None])
def test_compactions_leave_two_generations(spark, tmp_path, period):
    spec, path = ViewSpec("sample", SCHEMA, period=period), str(tmp_path / "v")
    store.create_view(spark, spec, path)
    for i in range(12):
        store.upsert_view(frame(spark, (f"2023-0{1 + i % 2}-01_{i}", i, 5)), spec, path, i, "s")
        if i % 2:
            store.compact_view(spark, spec, path)
    log = list(Path(path, "log", "era=0").glob("batch=*"))
    assert {p.name for p in log} == {"batch=10", "batch=11"}
    bases = [p for p in Path(path, "base", "era=0").glob("upto=*" + ("/period=*" if period else ""))]
    assert len(bases) <= 4 if period else len(bases) == 2
    assert len(state(spark, path, spec)) == 12
