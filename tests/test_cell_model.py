"""The stored cells against a dict of dicts filled cell by cell with ``str(value)``."""

import random

from fixtures import (
    daily_file,
    daily_forecast,
    hourly_file,
    hourly_forecast,
    information_file,
    station,
    stations,
    status_file,
)

from cityviews import schemas as S
from cityviews.plans import refresh
from cityviews.plans.registry import cells_spec
from cityviews.sinks.store import read_view


def put(model, key, families, values):
    for name, value in values.items():
        model.setdefault(key, {})[f"{families[name]}:{name}"] = str(value)


def stored(spark, name, files, path):
    for file in files:
        refresh.refresh_cells_from_file(spark, name, file, path)
    state = {}
    for r in read_view(spark, cells_spec(name), path).collect():
        state.setdefault(r["row_key"], {})[r["col"]] = r["val"]
    return state


def number(rng):
    return rng.choice([None, 0.0, -0.0, round(rng.uniform(-30, 30), 1), 1e-5 * rng.random(),
                       rng.randint(1, 9) * 1e17, float("nan"), rng.uniform(1, 1e9)])


def test_daily_weather_cells(spark, tmp_path):
    rng, model, files = random.Random(1), {}, []
    for hour in (1, 2, 3):
        for day in ("2023-01-05", "2023-01-06"):
            values = {c: [number(rng), 1.0] for c in S.WEATHER_DAILY_METRICS}
            files.append(daily_file(
                tmp_path, f"{day}_0{hour}-00-00-000", daily_forecast(day, **values)))
            put(model, day, S.WEATHER_DAILY_FAMILIES,
                {"time": day, **{c: v[0] for c, v in values.items()}})
    assert stored(spark, "weather_daily", files, str(tmp_path / "view")) == model


def test_hourly_weather_cells(spark, tmp_path):
    rng, model, files = random.Random(2), {}, []
    for hour, minute in ((0, 1), (0, 30), (17, 5), (23, 59)):
        values = {c: [number(rng) for _ in range(24)] for c in S.WEATHER_HOURLY_METRICS}
        files.append(hourly_file(
            tmp_path, f"2023-01-05_{hour:02d}-{minute:02d}-00-000",
            hourly_forecast("2023-01-05", **values)))
        key = f"2023-01-05T{hour:02d}:00"
        put(model, key, S.WEATHER_HOURLY_FAMILIES,
            {"time": key, **{c: v[hour] for c, v in values.items()}})
    assert stored(spark, "weather_hourly", files, str(tmp_path / "view")) == model


def test_information_cells(spark, tmp_path):
    rng, model, files = random.Random(3), {}, []
    for minute in (1, 2, 3):
        entities = []
        for i in rng.sample(range(5), 3):
            values = {c: None for c in S.INFORMATION_FAMILIES}
            values |= {"station_id": f"s{i}", "legacy_id": rng.choice(["a", None]),
                       "has_kiosk": rng.choice([True, False, None]),
                       "capacity": rng.randint(0, 99), "name": f"n{rng.random()}"}
            lon = rng.uniform(-180, 180)
            entities.append({**values, "lon": {"member0": None, "member1": lon},
                             "lat": {"member0": 1.0, "member1": None}})
            put(model, f"2023-01-05_s{i}", S.INFORMATION_FAMILIES, {**values, "lon": lon})
        files.append(information_file(
            tmp_path, f"2023-01-05_10-0{minute}-00-000", stations(*entities)))
    assert stored(spark, "information_daily", files, str(tmp_path / "view")) == model


def test_status_live_cells(spark, tmp_path):
    rng, model, files = random.Random(4), {}, []
    for minute in (1, 2, 3):
        entities = []
        for i in rng.sample(range(5), 3):
            values = {c: rng.choice([None, rng.randint(0, 20)]) for c in S.STATUS_FAMILIES}
            values |= {"station_id": f"s{i}", "legacy_id": "l", "station_status": "active"}
            entities.append(values)
            put(model, f"s{i}", S.STATUS_FAMILIES, values)
        files.append(status_file(
            tmp_path, f"2023-01-05_10-0{minute}-00-000", stations(*entities)))
    assert stored(spark, "status_live", files, str(tmp_path / "view")) == model


def test_status_hourly_cells(spark, tmp_path):
    rng, seen = random.Random(5), {}
    for minute in range(3):
        entities = []
        for i in range(4):
            values = {m: rng.choice([None, rng.randint(0, 20)]) for m in S.STATUS_METRICS}
            entities.append(station(f"s{i}", **values))
            for m, v in values.items():
                seen.setdefault(i, {}).setdefault(m, []).extend([] if v is None else [v])
        status_file(
            tmp_path / "feed", f"2023-01-05_10-0{minute}-00-000", stations(*entities))
    trigger = status_file(tmp_path / "feed", "2023-01-05_11-00-00-000", stations())
    model = {}
    for i, metrics in seen.items():
        means = {m: sum(v) / len(v) if v else None for m, v in metrics.items()}
        put(model, f"2023-01-05_10_s{i}", S.STATUS_FAMILIES,
            {"legacy_id": "l1", "station_id": f"s{i}", **means})
    assert stored(spark, "status_hourly", [trigger], str(tmp_path / "view")) == model
