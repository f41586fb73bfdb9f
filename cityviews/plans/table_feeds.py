"""Feeds made from the flat test tables, in the schemas of the real feeds.

Each table row becomes one payload row, so nothing is grouped or shuffled to build a
payload and no array grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityviews import schemas as S
from cityviews.functions.stamps import day_stamp, hour_index, hour_stamp

FEEDS = "/feeds/station_status/station_status_"
FORECAST_HOURS = 240


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(table(spark, sf_dir, "events"))


def numbered(raw: DataFrame) -> DataFrame:
    """Events with ``stamp_ts`` and ``k``, the number in ``props``."""
    return raw.select(
        "*",
        F.col("ts").cast("timestamp_ntz").alias("stamp_ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _entity(schema, values: dict[str, str]) -> Column:
    fields = schema["data"].dataType["stations"].dataType.elementType.fields
    return F.struct(*[F.expr(values[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def status_feed(numbered_events: DataFrame) -> DataFrame:
    """Station status: each event reports its user and its type as two stations.

    The five type stations hold half of all rows.
    """
    shared = {
        "num_bikes_disabled": "k % 4",
        "last_reported": "event_id",
        "is_renting": "k % 2",
        "num_ebikes_available": "nullif(k, k div 10 * 10) div 2",
        "num_docks_disabled": "k % 3",
        "is_installed": "1",
        "is_returning": "1 - k % 2",
        "num_docks_available": "100 - k",
    }
    user = {
        **shared,
        "legacy_id": "event_type",
        "station_id": "concat('u', user_id)",
        "num_bikes_available": "k",
        "station_status": "event_type",
    }
    kind = {
        **shared,
        "legacy_id": "concat('g', k % 3)",
        "station_id": "concat('t', event_type)",
        "num_bikes_available": "k + 1",
        "station_status": "'type'",
    }
    stations = F.array(_entity(S.STATUS_FEED, user), _entity(S.STATUS_FEED, kind))
    return numbered_events.select(
        "event_id", "stamp_ts", F.struct(stations.alias("stations")).alias("data"))


def bare_polls(numbered_events: DataFrame) -> DataFrame:
    """Polls without stations, one beside each event: an empty list or none at all."""
    none = F.array().cast(S.STATUS_FEED["data"].dataType["stations"].dataType)
    stations = F.when(F.col("event_id") % 2 == 0, none)
    return numbered_events.select(
        "event_id", "stamp_ts", F.struct(stations.alias("stations")).alias("data"))


def file_path(ts: Column) -> Column:
    """Path of the file that a poll at ``ts`` would be stored in."""
    text = ts.cast("string")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    stamp = F.translate(F.substring(text, 1, 19), " :", "_-")
    return F.concat(F.lit(FEEDS), stamp, F.lit("-"), millis, F.lit(".parquet"))


def hour_path(ts: Column) -> Column:
    """Path of the file that holds the whole hour of ``ts``."""
    return F.concat(F.lit(FEEDS), hour_stamp(ts), F.lit("-00-00-000.parquet"))


def write_feed(payloads: DataFrame, folder: str) -> None:
    """Add payload rows to a feed laid out by day and hour, as the files of their hours.

    Tasks take ranges of hours, so few write to one hour; one that holds many rows is split.
    """
    spark = payloads.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    day, hour = day_stamp(F.col("stamp_ts")), F.lpad(hour_index(F.col("stamp_ts")).cast("string"), 2, "0")
    rows = payloads.withColumns({"day": day, "hour": hour}).drop("stamp_ts")
    (rows.repartitionByRange(tasks, "day", "hour", F.xxhash64(*payloads.drop("stamp_ts").columns))
     .write.mode("append").partitionBy("day", "hour").parquet(folder))


def daily_feed(numbered_events: DataFrame) -> DataFrame:
    """Daily weather: each event is a forecast of seven days from its day on."""
    day = F.col("stamp_ts").cast("date")
    days = F.array(*[F.date_add(day, i).cast("string") for i in range(7)])
    metrics = [
        F.array(*[F.col("value") + float(j) + i * 0.5 for i in range(7)]).alias(c)
        for j, c in enumerate(S.WEATHER_DAILY_METRICS)
    ]
    return numbered_events.select(
        "event_id", "stamp_ts", F.struct(days.alias("time"), *metrics).alias("daily"))


def metric_start(j: int) -> int:
    """Place in a vector of the first of the 24 numbers of metric ``j``."""
    return 1 + j * (64 - 24) // (len(S.WEATHER_HOURLY_METRICS) - 1)


def hourly_feed(embeddings: DataFrame) -> DataFrame:
    """Hourly weather: each vector is a forecast of 24 hours.

    The vectors are dealt over the hours of ten days, however many there are. The slices that
    the metrics take cover a vector of 64 numbers from end to end.
    """
    minutes = F.expr(f"vec_id % {FORECAST_HOURS} * 60 + vec_id div {FORECAST_HOURS} % 60")
    stamp = F.timestamp_add(
        "MINUTE", minutes, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    stamped = embeddings.select("vec_id", "embedding", stamp.alias("stamp_ts"))
    day = day_stamp(F.col("stamp_ts"))
    times = F.lit(",".join(f"@T{h:02d}:00" for h in range(24)))
    hours = F.split(F.replace(times, F.lit("@"), day), ",")
    metrics = [
        F.slice("embedding", metric_start(j), 24).cast("array<double>").alias(c)
        for j, c in enumerate(S.WEATHER_HOURLY_METRICS)
    ]
    return stamped.select(
        "vec_id", "stamp_ts", F.struct(hours.alias("time"), *metrics).alias("hourly"))


def information_feed(orders: DataFrame) -> DataFrame:
    """Station information: each order describes its customer as a station."""
    values = {
        "lon": "named_struct('member0', cast(2.5 as float), 'member1',"
               " if(o_orderkey % 5 = 0, null, o_totalprice))",
        "external_id": "o_orderstatus",
        "legacy_id": "concat('o', o_orderkey)",
        "station_id": "o_custkey",
        "has_kiosk": "o_totalprice > 200000",
        "capacity": "o_orderkey",
        "lat": "named_struct('member0', cast(null as float), 'member1', o_totalprice / 2)",
        "region_id": "o_custkey % 10",
        "station_type": "o_orderpriority",
        "short_name": "substring(o_orderpriority, 1, 1)",
        "electric_bike_surcharge_waiver": "o_custkey % 2 = 0",
        "name": "o_orderpriority",
    }
    stations = F.array(_entity(S.INFORMATION_FEED, values))
    return orders.select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("stamp_ts"),
        F.struct(stations.alias("stations")).alias("data"))
