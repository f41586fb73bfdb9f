import pytest
from fixtures import rows, station, stations, status_file
from pyspark.errors import StreamingQueryException

from cityviews.plans import views
from cityviews.plans.registry import VIEWS
from cityviews.sinks.store import compact_view, read_view, upsert_once, view_head
from cityviews.sources.files import read_payloads, stream_payloads
from cityviews.streaming.refresh import refresh_stream


def run(spark, name, feed, path, checkpoint, files_per_batch=1, compact_every=None):
    view = VIEWS[name]
    payloads = stream_payloads(spark, feed, view.feed, files_per_batch)
    refresh_stream(payloads, view, path, checkpoint, compact_every).awaitTermination()


def poll(folder, hour, minute, **values):
    status_file(folder, f"2023-01-05_{hour}-{minute:02d}-00-000", stations(
        station("s1", num_bikes_available=minute, **values), station(f"only{minute}")))


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "view")
    for minute in (5, 10, 15):
        poll(feed, 17, minute)
    view = VIEWS["status_live"]
    run(spark, "status_live", feed, path, str(tmp_path / "checkpoint"))
    whole = views.status_live(read_payloads(spark, feed, view.feed))
    assert rows(read_view(spark, view.spec, path)) == rows(whole)

    poll(feed, 17, 20)
    run(spark, "status_live", feed, path, str(tmp_path / "checkpoint"))
    whole = views.status_live(read_payloads(spark, feed, view.feed))
    assert rows(read_view(spark, view.spec, path)) == rows(whole)
    # A new checkpoint sees all files again, in other batches.
    run(spark, "status_live", feed, path, str(tmp_path / "other"), files_per_batch=4)
    assert rows(read_view(spark, view.spec, path)) == rows(whole)


def test_hourly_means_over_batches(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "view")
    checkpoint, view = str(tmp_path / "checkpoint"), VIEWS["status_hourly_parts"]
    for hour, minute in ((17, 5), (17, 10), (18, 0)):
        poll(feed, hour, minute)
    run(spark, "status_hourly_parts", feed, path, checkpoint)
    compact_view(spark, view.spec, path)
    assert view_head(spark, path).upto == 2
    poll(feed, 17, 55)  # late, after the hour was compacted
    run(spark, "status_hourly_parts", feed, path, checkpoint)
    streamed = views.status_hourly_from_parts(read_view(spark, view.spec, path))
    whole = views.status_hourly(read_payloads(spark, feed, view.feed))
    assert rows(streamed) == rows(whole)
    assert ("2023-01-05_17_s1", 70 / 3) in rows(streamed, "row_key", "num_bikes_available")


def test_a_run_without_new_files_changes_nothing(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "view")
    poll(feed, 17, 5)
    run(spark, "status_live", feed, path, str(tmp_path / "checkpoint"))
    before = rows(read_view(spark, VIEWS["status_live"].spec, path))
    run(spark, "status_live", feed, path, str(tmp_path / "checkpoint"))
    assert rows(read_view(spark, VIEWS["status_live"].spec, path)) == before


def test_two_feeds_into_one_view(spark, tmp_path):
    """Both streams count their batches from 0; neither replaces those of the other."""
    path, view = str(tmp_path / "view"), VIEWS["status_hourly_parts"]
    for feed, hours in (("a", (16, 17)), ("b", (18, 19))):
        for hour in hours:
            poll(str(tmp_path / feed), hour, 30)
    for feed in ("a", "b", "a", "b"):
        run(spark, "status_hourly_parts", str(tmp_path / feed), path, str(tmp_path / f"c{feed}"))
        poll(str(tmp_path / feed), 20, 40 if feed == "a" else 50)
    streamed = views.status_hourly_from_parts(read_view(spark, view.spec, path))
    whole = views.status_hourly(read_payloads(spark, f"{tmp_path}/[ab]", view.feed))
    assert rows(streamed) == rows(whole) and whole.count() == 11


def test_compaction_while_streaming(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "view")
    for minute in (5, 10, 15, 20, 25):
        poll(feed, 17, minute)
    view = VIEWS["status_hourly_parts"]
    run(spark, "status_hourly_parts", feed, path, str(tmp_path / "checkpoint"), compact_every=2)
    assert view_head(spark, path).upto == 3
    streamed = views.status_hourly_from_parts(read_view(spark, view.spec, path))
    assert rows(streamed) == rows(views.status_hourly(read_payloads(spark, feed, view.feed)))


def test_a_batch_that_failed_after_its_write_counts_once(spark, tmp_path, monkeypatch):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "view")
    view, failures = VIEWS["status_hourly_parts"], []
    for minute in (5, 10, 15):
        poll(feed, 17, minute)

    def fail_once(df, spec, path, source):
        upsert_once(df, spec, path, source)
        if source.endswith("-1") and not failures:
            failures.append(source)
            raise RuntimeError("lost after the write")

    monkeypatch.setattr("cityviews.streaming.refresh.upsert_once", fail_once)
    with pytest.raises(StreamingQueryException):
        run(spark, "status_hourly_parts", feed, path, str(tmp_path / "checkpoint"))
    run(spark, "status_hourly_parts", feed, path, str(tmp_path / "checkpoint"))
    assert len(failures) == 1
    streamed = views.status_hourly_from_parts(read_view(spark, view.spec, path))
    assert rows(streamed) == rows(views.status_hourly(read_payloads(spark, feed, view.feed)))
