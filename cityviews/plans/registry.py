"""The views by name: stored form, builder, feed schema and column families."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from cityviews import schemas as S
from cityviews.plans import views as V
from cityviews.sinks.store import ViewSpec


@dataclass(frozen=True)
class View:
    """``open_feed`` reads whatever fields a feed has, so unmapped ones are noticed.

    ``whole_hours`` marks rows that are right only if computed from all files of an hour.
    """

    spec: ViewSpec
    build: Callable[[DataFrame], DataFrame]
    feed: StructType
    families: Mapping[str, str]
    open_feed: bool = False
    whole_hours: bool = False


VIEWS = {
    view.spec.name: view
    for view in (
        View(ViewSpec("weather_daily", S.WEATHER_DAILY_VIEW, period=4), V.weather_daily,
             S.WEATHER_DAILY_FEED, S.WEATHER_DAILY_FAMILIES, open_feed=True),
        View(ViewSpec("weather_hourly", S.WEATHER_HOURLY_VIEW, period=7), V.weather_hourly,
             S.WEATHER_HOURLY_FEED, S.WEATHER_HOURLY_FAMILIES, open_feed=True),
        View(ViewSpec("information_daily", S.INFORMATION_DAILY_VIEW, period=7),
             V.information_daily, S.INFORMATION_FEED, S.INFORMATION_FAMILIES),
        View(ViewSpec("status_hourly", S.STATUS_HOURLY_VIEW, keys=("row_key", "legacy_id")),
             V.status_hourly, S.STATUS_HOURLY_FEED, S.STATUS_FAMILIES, whole_hours=True),
        View(ViewSpec("status_hourly_parts", S.STATUS_HOURLY_PARTS,
                      keys=("row_key", "stamp", "legacy_id", "station_id"), rule="add"),
             V.status_hourly_parts, S.STATUS_HOURLY_FEED, S.STATUS_FAMILIES),
        View(ViewSpec("status_live", S.STATUS_LIVE_VIEW, period=None),
             V.status_live, S.STATUS_FEED, S.STATUS_FAMILIES),
    )
}


def cells_spec(name: str, rule: str = "version") -> ViewSpec:
    """Stored form of a view kept as text cells instead of typed rows."""
    return ViewSpec(
        f"{name}_cells", S.CELLS, keys=("row_key", "col"),
        period=VIEWS[name].spec.period, rule=rule)


def stored_spec(name: str, cells: bool = False, rule: str | None = None) -> ViewSpec:
    """Stored form of a view, typed or as cells, under its own rule or another."""
    spec = cells_spec(name) if cells else VIEWS[name].spec
    if rule is None or rule == spec.rule:
        return spec
    if "add" in (rule, spec.rule):
        raise ValueError(f"{spec.name} is kept by rule {spec.rule} only")
    return replace(spec, rule=rule)
