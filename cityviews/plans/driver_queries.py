"""The operators and views bound to the test tables, each with its SQL counterpart."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from cityviews import schemas as S
from cityviews.functions import stamps
from cityviews.functions.text import py_text
from cityviews.operators import cells, shape
from cityviews.plans import refresh, views
from cityviews.plans import table_feeds as feeds
from cityviews.plans.registry import VIEWS, cells_spec
from cityviews.sinks.store import (
    compact_view,
    create_view,
    open_view,
    read_view,
    reset_view,
    upsert_view,
)
from cityviews.sinks.workdir import work_folder
from cityviews.sources.drift import read_files
from cityviews.sources.files import latest_file, list_files, read_payloads, stream_files
from cityviews.streaming.refresh import follow_files, refresh_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HOUR = "2024-01-05_17"
FIRST, LAST = "2024-01-05_17", "2024-01-08_05"
TRIGGER = "2024-01-06_00"

#: The status feed with the id of the event behind each payload, and as files that store doubles.
KEYED_FEED = StructType([StructField("event_id", LongType()), *S.STATUS_FEED.fields])
DOUBLE_FEED = StructType([StructField("data", StructType([StructField("stations", ArrayType(StructType([
    StructField(f.name, DoubleType() if f.name in S.STATUS_METRICS else f.dataType)
    for f in S.STATUS_FEED["data"].dataType["stations"].dataType.elementType.fields])))]))])


def query(sql: str):
    def bind(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn
    return bind


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.status_feed(feeds.events(spark, sf_dir))


# The readings of the status feed as flat rows.
READINGS = """
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
shared AS (
  SELECT event_id, event_type, user_id, ts, k,
         k % 4 AS num_bikes_disabled, event_id AS last_reported, k % 2 AS is_renting,
         CASE WHEN k % 10 <> 0 THEN k // 2 END AS num_ebikes_available,
         k % 3 AS num_docks_disabled, CAST(1 AS BIGINT) AS is_installed,
         1 - k % 2 AS is_returning, 100 - k AS num_docks_available
  FROM e
),
readings AS (
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d_%H') AS stamp,
         event_type AS legacy_id, num_bikes_disabled, last_reported,
         'u' || user_id AS station_id, is_renting, num_ebikes_available,
         num_docks_disabled, is_installed, k AS num_bikes_available, is_returning,
         event_type AS station_status, num_docks_available
  FROM shared
  UNION ALL
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d_%H') AS stamp,
         'g' || (k % 3) AS legacy_id, num_bikes_disabled, last_reported,
         't' || event_type AS station_id, is_renting, num_ebikes_available,
         num_docks_disabled, is_installed, k + 1 AS num_bikes_available, is_returning,
         'type' AS station_status, num_docks_available
  FROM shared
)"""

STATUS_COLUMNS = ", ".join(S.STATUS_FAMILIES)
MEANS = ", ".join(f"avg({m}) AS {m}" for m in S.STATUS_METRICS)


def hourly_sql(where: str = "true") -> str:
    return f"""
WITH {READINGS}
SELECT stamp || '_' || station_id AS row_key, stamp, legacy_id, station_id, {MEANS}
FROM readings WHERE {where} GROUP BY stamp, legacy_id, station_id"""


def live_sql(where: str = "true") -> str:
    return f"""
WITH {READINGS}
SELECT station_id AS row_key, {STATUS_COLUMNS} FROM readings WHERE {where}
QUALIFY row_number() OVER (PARTITION BY station_id
  ORDER BY ts DESC, legacy_id DESC, num_bikes_disabled DESC, last_reported DESC) = 1"""


# ------------------------------------------------------------ sources and shape
@query("SELECT o_orderkey AS row_id, o_orderstatus AS status, o_totalprice AS total"
       " FROM orders")
def q_struct_expand(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders").select(F.struct(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
    ).alias("payload"))
    return shape.expand_struct(orders, "payload")


@query(f"WITH {READINGS} SELECT event_id, stamp, {STATUS_COLUMNS} FROM readings")
def q_explode_entities(spark, sf_dir):
    events = feeds.events(spark, sf_dir)
    polls = feeds.status_feed(events).unionByName(feeds.bare_polls(events))
    rows = shape.explode_entities(
        polls, "data.stations", list(S.STATUS_FAMILIES), keep=["event_id", "stamp_ts"])
    return rows.select(
        "event_id", stamps.hour_stamp(F.col("stamp_ts")).alias("stamp"), *S.STATUS_FAMILIES)


@query(f"""WITH {READINGS}
SELECT event_id, legacy_id, station_id, num_bikes_available FROM readings
WHERE stamp = (SELECT max(strftime(ts, '%Y-%m-%d_%H')) FROM events)""")
def q_latest_snapshot(spark, sf_dir):
    """The feed as files by day and hour; the newest file tells the hour, its folder is read."""
    folder = work_folder(spark, "latest_snapshot")
    feeds.write_feed(_status(spark, sf_dir), folder)
    found = re.match(stamps.FOLDER_PARTS, latest_file(spark, folder) or "")
    hour = "_".join(found.groups()) if found else "1970-01-01_00"
    payloads = read_payloads(spark, folder, KEYED_FEED, hour=hour)
    return shape.explode_entities(
        payloads, "data.stations", ["legacy_id", "station_id", "num_bikes_available"],
        keep=["event_id"])


@query(f"""WITH {READINGS}
SELECT event_id, station_id, CAST(num_bikes_available AS DOUBLE) AS num_bikes_available
FROM readings WHERE stamp = '{HOUR}'""")
def q_hour_snapshot_union(spark, sf_dir):
    """Files that store the metric as whole numbers and files that store doubles, in one folder."""
    folder, payloads = work_folder(spark, "hour_snapshot"), _status(spark, sf_dir)
    feeds.write_feed(payloads.where("event_id % 2 = 0"), folder)
    feeds.write_feed(payloads.where("event_id % 2 <> 0").withColumn(
        "data", F.col("data").cast(DOUBLE_FEED["data"].dataType)), folder)
    # KEYED_FEED says whole numbers; the files decide
    whole = read_files(list_files(spark, folder, HOUR, HOUR), KEYED_FEED, open_fields=True)
    return shape.explode_entities(
        whole, "data.stations", ["station_id", "num_bikes_available"], keep=["event_id"])


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
CAST(extract(hour FROM ts) AS INT) AS h_index, strftime(ts, '%Y-%m-%d_%H') AS hour_stamp
FROM events""")
def q_stamp_parts(spark, sf_dir):
    paths = feeds.events(spark, sf_dir).select(
        "event_id", feeds.file_path(F.col("stamp_ts")).alias("path"))
    ts = stamps.file_stamp(F.col("path"))
    return paths.select("event_id", ts.alias("ts")).select(
        "event_id",
        stamps.day_stamp(F.col("ts")).alias("day"),
        stamps.hour_index(F.col("ts")).alias("h_index"),
        stamps.hour_stamp(F.col("ts")).alias("hour_stamp"))


@query("""SELECT event_id,
strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, '%Y-%m-%d_%H') AS prev_stamp
FROM events""")
def q_prev_hour_stamp(spark, sf_dir):
    return feeds.events(spark, sf_dir).select(
        "event_id", stamps.prev_hour_stamp(F.col("stamp_ts")).alias("prev_stamp"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS "time", value AS temperature_2m_max,
value + 9 AS windgusts_10m_max FROM events""")
def q_pick_first(spark, sf_dir):
    wide = shape.expand_struct(
        feeds.daily_feed(feeds.events(spark, sf_dir)), "daily", keep=["event_id"])
    picked = shape.pick_at(wide, F.lit(0), keep=["event_id"])
    return picked.select("event_id", "time", "temperature_2m_max", "windgusts_10m_max")


# The hourly weather feed as flat rows: the slot of the file's hour.
FORECASTS = """
f AS (
  SELECT vec_id, embedding,
         TIMESTAMP '2024-01-01' + to_minutes(vec_id % 240 * 60 + vec_id // 240 % 60) AS ts
  FROM embeddings
),
forecasts AS (
  SELECT vec_id, ts, strftime(ts, '%Y-%m-%dT%H:00') AS "time", """ + ", ".join(
    f"CAST(embedding[{feeds.metric_start(j)} + CAST(extract(hour FROM ts) AS INT)] AS DOUBLE) AS {c}"
    for j, c in enumerate(S.WEATHER_HOURLY_METRICS)) + " FROM f)"
HOURLY_METRICS = ", ".join(S.WEATHER_HOURLY_METRICS)


def weather_hourly_sql(where: str = "true") -> str:
    return f"""WITH {FORECASTS}
SELECT "time" AS row_key, "time", {HOURLY_METRICS} FROM forecasts WHERE {where}
QUALIFY row_number() OVER (PARTITION BY "time"
  ORDER BY ts DESC, temperature_2m DESC, apparent_temperature DESC) = 1"""


def _hourly_feed(spark, sf_dir):
    return feeds.hourly_feed(feeds.table(spark, sf_dir, "embeddings"))


@query(f'WITH {FORECASTS} SELECT vec_id, "time", {HOURLY_METRICS} FROM forecasts')
def q_pick_hour(spark, sf_dir):
    wide = shape.expand_struct(
        _hourly_feed(spark, sf_dir), "hourly", keep=["vec_id", "stamp_ts"])
    return shape.pick_at(
        wide, stamps.hour_index(F.col("stamp_ts")), keep=["vec_id"])


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal END AS lon,
CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal
     ELSE CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) END AS repaired FROM customer""")
def q_member_extract(spark, sf_dir):
    customers = feeds.table(spark, sf_dir, "customer").select("c_custkey", F.struct(
        F.col("c_acctbal").cast("float").alias("member0"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_acctbal")).alias("member1"),
    ).alias("lon"))
    return customers.select(
        "c_custkey",
        shape.union_member(customers, "lon").alias("lon"),
        shape.union_member(customers, "lon", repair=True).alias("repaired"))


@query('SELECT c_custkey AS "id:c_custkey", c_name AS "detail:c_name",'
       ' c_acctbal AS "metric:c_acctbal" FROM customer')
def q_family_columns(spark, sf_dir):
    families = {"c_custkey": "id", "c_name": "detail", "c_acctbal": "metric"}
    customers = feeds.table(spark, sf_dir, "customer").select(*families)
    return shape.qualify(customers, families)


# ------------------------------------------------------------------------- cells
@query("""
WITH o AS (
  SELECT *, o_totalprice * 1e9 AS large, o_totalprice * 1e11 AS larger,
         o_totalprice / 1e9 AS small, o_totalprice / 1e11 AS smaller,
         CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS total
  FROM orders
)
SELECT CAST(o_orderkey AS VARCHAR) AS row_key, c.col, coalesce(c.val, 'None') AS val
FROM o, LATERAL (VALUES
  ('id:o_custkey', CAST(o_custkey AS VARCHAR)),
  ('metric:total', CAST(total AS VARCHAR)),
  ('metric:large', CAST(large AS VARCHAR)),
  ('metric:larger', CAST(larger AS VARCHAR)),
  ('metric:small', CAST(small AS VARCHAR)),
  ('metric:smaller', CAST(smaller AS VARCHAR)),
  ('status:urgent', CASE WHEN o_orderpriority LIKE '1%' THEN 'True' ELSE 'False' END)
) AS c(col, val)""")
def q_cells(spark, sf_dir):
    price = F.col("o_totalprice")
    orders = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderkey") % 7 > 0, price).alias("total"),
        (price * 1e9).alias("large"),
        (price * 1e11).alias("larger"),
        (price / 1e9).alias("small"),
        (price / 1e11).alias("smaller"),
        F.startswith("o_orderpriority", F.lit("1")).alias("urgent"))
    families = {
        "o_custkey": "id", "total": "metric", "large": "metric", "larger": "metric",
        "small": "metric", "smaller": "metric", "urgent": "status"}
    return cells.to_cells(orders, families, key="o_orderkey", version=None)


EVENT_CELLS = """
w AS (
  SELECT CAST(user_id AS VARCHAR) AS row_key,
         CASE WHEN event_id % 2 = 0 THEN 'metric:a' ELSE 'metric:b' END AS col,
         CASE WHEN event_id % 10 > 1 THEN CAST(value AS VARCHAR) ELSE 'None' END AS val,
         event_id FROM events
),
latest AS (
  SELECT row_key, col, val FROM w
  QUALIFY row_number() OVER (PARTITION BY row_key, col ORDER BY event_id DESC) = 1
)"""


def _event_cells(spark, sf_dir):
    value = F.when(F.col("event_id") % 10 > 1, F.col("value"))
    return feeds.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("row_key"),
        F.when(F.col("event_id") % 2 == 0, "metric:a").otherwise("metric:b").alias("col"),
        value.alias("value"),
        F.col("event_id").alias("version"),
    ).select("row_key", "col", py_text(F.col("value"), S.DoubleType()).alias("val"), "version")


@query(f"WITH {EVENT_CELLS} SELECT row_key, col, val FROM latest")
def q_cell_latest(spark, sf_dir):
    return cells.latest_cells(_event_cells(spark, sf_dir)).select("row_key", "col", "val")


@query(f"""WITH {EVENT_CELLS}
SELECT row_key, max(CASE WHEN col = 'metric:a' THEN val END) AS a,
       max(CASE WHEN col = 'metric:b' THEN val END) AS b FROM latest GROUP BY row_key""")
def q_view_scan(spark, sf_dir):
    return cells.cells_to_rows(
        _event_cells(spark, sf_dir), {"metric:a": "a", "metric:b": "b"})


# ------------------------------------------------------------------------- views
DAILY_METRICS = ", ".join(
    f"value + {j} AS {c}" for j, c in enumerate(S.WEATHER_DAILY_METRICS))


@query(f"""SELECT strftime(ts, '%Y-%m-%d') AS row_key, strftime(ts, '%Y-%m-%d') AS "time",
{DAILY_METRICS} FROM events QUALIFY row_number() OVER (
  PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, value DESC) = 1""")
def q_weather_daily(spark, sf_dir):
    rows = views.weather_daily(
        feeds.daily_feed(feeds.events(spark, sf_dir)).select("stamp_ts", "daily"))
    return rows.drop("version")


@query(weather_hourly_sql())
def q_weather_hourly(spark, sf_dir):
    return views.weather_hourly(_hourly_feed(spark, sf_dir)).drop("version")


@query(weather_hourly_sql(
    "strftime(ts, '%Y-%m-%d_%H') BETWEEN '" + FIRST + "' AND '" + LAST + "'"))
def q_backfill_weather(spark, sf_dir):
    payloads = _hourly_feed(spark, sf_dir).where(
        stamps.in_hours(F.col("stamp_ts"), FIRST, LAST))
    return views.weather_hourly(payloads).drop("version")


@query(weather_hourly_sql(
    "strftime(ts, '%Y-%m-%d_%H') BETWEEN '" + FIRST + "' AND '" + LAST + "'").replace("ORDER BY ts DESC, ", "ORDER BY "))
def q_backfill_files(spark, sf_dir):
    """A feed by day and hour whose files store doubles, or floats beside a field of their own."""
    folder, payloads = work_folder(spark, "backfill_files"), _hourly_feed(spark, sf_dir)
    floats = payloads.schema["hourly"].dataType.simpleString().replace("double", "float")
    feeds.write_feed(payloads.where("vec_id % 2 = 0").drop("vec_id"), folder)
    feeds.write_feed(payloads.where("vec_id % 2 <> 0").withColumn(
        "hourly", F.col("hourly").cast(floats)), folder)
    files = refresh.files_of(spark, folder, FIRST, LAST)
    return refresh.feed_rows(VIEWS["weather_hourly"], files).drop("version")


@query("""
WITH e AS (
  SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d_%H') AS h FROM events
), a AS (
  SELECT day, h, event_id AS t, value AS r FROM e WHERE event_id % 3 = 0
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY h DESC, event_id DESC) = 1
), b AS (
  SELECT day, h, CASE WHEN event_id % 5 <> 0 THEN value END AS t, value + 1 AS w FROM e WHERE event_id % 3 <> 0
  QUALIFY row_number() OVER (PARTITION BY day ORDER BY h DESC,
    CASE WHEN event_id % 5 <> 0 THEN value END DESC NULLS LAST, value DESC) = 1
), c AS (
  SELECT day AS row_key, h, v.col, v.val FROM a, LATERAL (VALUES ('time:time', day),
    ('temperature:temperature_2m_max', CAST(t AS VARCHAR)), ('precipitation:rain_sum', CAST(r AS VARCHAR))) AS v(col, val)
  UNION ALL
  SELECT day, h, v.col, v.val FROM b, LATERAL (VALUES ('time:time', day),
    ('temperature:temperature_2m_max', coalesce(CAST(t AS VARCHAR), 'None')),
    ('wind:windspeed_10m_max', CAST(w AS VARCHAR))) AS v(col, val)
)
SELECT row_key, col, val FROM c
QUALIFY row_number() OVER (PARTITION BY row_key, col ORDER BY h DESC, val DESC) = 1""")
def q_backfill_cells(spark, sf_dir):
    """Text cells of files with different fields and number types: absent is no cell, null is None."""
    folder, path = work_folder(spark, "backfill_cells"), work_folder(spark, "backfill_cells_view")
    events = feeds.events(spark, sf_dir)

    def files(part, **metrics):
        day = F.array(stamps.day_stamp(F.col("stamp_ts"))).alias("time")
        slots = [F.array(F.expr(x)).alias(c) for c, x in metrics.items()]
        feeds.write_feed(part.select("stamp_ts", F.struct(day, *slots).alias("daily")), folder)

    files(events.where("event_id % 3 = 0"), temperature_2m_max="event_id", rain_sum="value")
    files(events.where("event_id % 3 <> 0"),
          temperature_2m_max="if(event_id % 5 <> 0, value, null)", windspeed_10m_max="value + 1")
    refresh.backfill(spark, "weather_daily", folder, path, "0001-01-01_00", "9999-12-30_23", cells=True)
    return read_view(spark, cells_spec("weather_daily"), path).drop("version")


INFORMATION = """
i AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') || '_' || o_custkey AS row_key,
         strftime(o_orderdate, '%Y-%m-%d') AS day,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS lon,
         o_orderstatus AS external_id, 'o' || o_orderkey AS legacy_id,
         CAST(o_custkey AS VARCHAR) AS station_id, o_totalprice > 200000 AS has_kiosk,
         o_orderkey AS capacity, o_totalprice / 2 AS lat,
         CAST(o_custkey % 10 AS VARCHAR) AS region_id, o_orderpriority AS station_type,
         substring(o_orderpriority, 1, 1) AS short_name,
         o_custkey % 2 = 0 AS electric_bike_surcharge_waiver, o_orderpriority AS name,
         o_orderdate
  FROM orders
),
information AS (
  SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY o_orderdate DESC,
    lon DESC NULLS LAST, external_id DESC, legacy_id DESC) = 1
)"""


def _information(spark, sf_dir):
    return views.information_daily(
        feeds.information_feed(feeds.table(spark, sf_dir, "orders")))


@query(f"WITH {INFORMATION} SELECT * EXCLUDE (day, o_orderdate) FROM information")
def q_information_daily(spark, sf_dir):
    return _information(spark, sf_dir).drop("version")


@query(hourly_sql())
def q_status_hourly(spark, sf_dir):
    return views.status_hourly(_status(spark, sf_dir)).drop("version")


@query(hourly_sql(f"stamp = '{stamps.previous_hour(TRIGGER)}'"))
def q_status_hourly_trigger(spark, sf_dir):
    return views.status_hourly(
        _status(spark, sf_dir), trigger_stamp=TRIGGER).drop("version")


@query(hourly_sql() + """
QUALIFY row_number() OVER (
  PARTITION BY stamp || '_' || station_id ORDER BY legacy_id DESC) = 1""")
def q_status_hourly_keyed(spark, sf_dir):
    return views.keyed_status_hourly(
        views.status_hourly(_status(spark, sf_dir))).drop("version")


@query(hourly_sql(f"stamp BETWEEN '{FIRST}' AND '{LAST}'"))
def q_backfill_status(spark, sf_dir):
    payloads = _status(spark, sf_dir).where(
        stamps.in_hours(F.col("stamp_ts"), FIRST, LAST))
    return views.status_hourly(payloads).drop("version")


@query("""SELECT strftime(h, '%Y-%m-%d_%H') AS stamp, count(event_id) AS n
FROM generate_series(TIMESTAMP '2024-01-05 17:00', TIMESTAMP '2024-01-08 05:00',
                     INTERVAL 1 HOUR) g(h)
LEFT JOIN events ON date_trunc('hour', ts) = h GROUP BY 1""")
def q_backfill_hours(spark, sf_dir):
    return refresh.hour_coverage(spark, feeds.events(spark, sf_dir), FIRST, LAST)


@query(live_sql())
def q_status_live(spark, sf_dir):
    return views.status_live(_status(spark, sf_dir)).drop("version")


# ------------------------------------------------------------------ stored views
@query(live_sql())
def q_view_upsert(spark, sf_dir):
    """Two batches with a compaction in between; the older rows come last."""
    spec, path = VIEWS["status_live"].spec, work_folder(spark, "view_upsert")
    payloads = _status(spark, sf_dir)
    create_view(spark, spec, path)
    upsert_view(views.status_live(payloads.where("event_id % 2 = 1")), spec, path, 1)
    compact_view(spark, spec, path)
    upsert_view(views.status_live(payloads.where("event_id % 2 = 0")), spec, path, 2)
    return read_view(spark, spec, path).drop("version")


@query(live_sql("event_id % 2 = 0"))
def q_view_reset(spark, sf_dir):
    """Rows written before the reset are gone."""
    spec, path = VIEWS["status_live"].spec, work_folder(spark, "view_reset")
    payloads = _status(spark, sf_dir)
    create_view(spark, spec, path)
    upsert_view(views.status_live(payloads), spec, path, 1)
    reset_view(spark, spec, path)
    upsert_view(views.status_live(payloads.where("event_id % 2 = 0")), spec, path, 1)
    return open_view(spark, spec, path).drop("version")


@query(f"WITH {INFORMATION} SELECT * EXCLUDE (day, o_orderdate) FROM information"
       " WHERE day BETWEEN '1996-01-01' AND '1996-12-31'")
def q_view_days(spark, sf_dir):
    """A view stored by month, read for one year of days."""
    spec, path = VIEWS["information_daily"].spec, work_folder(spark, "view_days")
    create_view(spark, spec, path)
    upsert_view(_information(spark, sf_dir), spec, path, 1)
    return read_view(spark, spec, path, "1996-01-01", "1996-12-31").drop("version")


@query(live_sql().replace(f"SELECT station_id AS row_key, {STATUS_COLUMNS}",
                          """, live AS (SELECT station_id AS row_key, *""") + """)
SELECT row_key, c.col, c.val FROM live, LATERAL (VALUES """ + ", ".join(
    f"('{family}:{c}', coalesce(CAST({c} AS VARCHAR), 'None'))"
    for c, family in S.STATUS_FAMILIES.items()) + ") AS c(col, val)")
def q_view_cells(spark, sf_dir):
    """The live view kept as text cells."""
    spec, path = cells_spec("status_live"), work_folder(spark, "view_cells")
    create_view(spark, spec, path)
    live = views.status_live(_status(spark, sf_dir))
    upsert_view(refresh.view_cells(live, "status_live"), spec, path, 1)
    return read_view(spark, spec, path).drop("version")


# --------------------------------------------------------------------- streaming
def _streamed(spark, sf_dir, name):
    """State of a view refreshed from the events table, read as a stream of files."""
    view, path = VIEWS[name], work_folder(spark, name)
    schema = feeds.table(spark, sf_dir, "events").schema
    # The bracket makes this a pattern, so a file and a folder of files both work.
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    payloads = feeds.status_feed(feeds.numbered(raw))
    refresh_stream(payloads, view, path, f"{path}/checkpoint").awaitTermination()
    return read_view(spark, view.spec, path)


@query(live_sql())
def q_status_live_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "status_live").drop("version")


@query(hourly_sql())
def q_status_hourly_batches(spark, sf_dir):
    """Means stored by a stream whose batches split every hour, then by a backfill over a part."""
    view, path = VIEWS["status_hourly"], work_folder(spark, "status_hourly_batches")
    events = feeds.table(spark, sf_dir, "events")
    events.repartition(6, "event_id").write.parquet(f"{path}/events")
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2)
    raw = raw.parquet(f"{path}/events")

    def polls(session, first, last):
        payloads = feeds.status_feed(feeds.numbered(session.read.parquet(f"{path}/events")))
        return payloads.where(stamps.in_hours(F.col("stamp_ts"), first, last))

    refresh_stream(
        feeds.status_feed(feeds.numbered(raw)), view, f"{path}/view", f"{path}/checkpoint",
        polls=polls).awaitTermination()
    upsert_view(view.build(polls(spark, FIRST, LAST)), view.spec, f"{path}/view")
    return read_view(spark, view.spec, f"{path}/view").drop("version")


@query(hourly_sql())
def q_status_parts_mixed(spark, sf_dir):
    """Sums kept by a stream of files, then by a backfill of all hours: each file counts once."""
    folder, path = work_folder(spark, "parts_feed"), work_folder(spark, "parts_mixed")
    payloads = _status(spark, sf_dir)
    feeds.write_feed(payloads.where("event_id % 2 = 0"), folder)
    follow_files(
        stream_files(spark, folder), "status_hourly_parts", folder, f"{path}/view", f"{path}/checkpoint",
    ).awaitTermination()
    feeds.write_feed(payloads.where("event_id % 2 <> 0"), folder)
    refresh.backfill(
        spark, "status_hourly_parts", folder, f"{path}/view", "0001-01-01_00", "9999-12-30_23")
    parts = read_view(spark, VIEWS["status_hourly_parts"].spec, f"{path}/view")
    return views.status_hourly_from_parts(parts).drop("version")


@query(hourly_sql())
def q_status_hourly_stream(spark, sf_dir):
    return views.status_hourly_from_parts(
        _streamed(spark, sf_dir, "status_hourly_parts")).drop("version")
