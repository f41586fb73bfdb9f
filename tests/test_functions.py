import math
import random
import struct
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
)

from cityviews.functions import stamps
from cityviews.functions.text import py_text


def texts(spark, values, kind, arrow):
    df = spark.createDataFrame(pa.table({"x": pa.array(values, arrow)}))
    return [r[0] for r in df.select(py_text(F.col("x"), kind)).collect()]


def test_double_text_special_values(spark):
    values = [1e7, 12345678.9, 1e-5, 1e16, math.nan, math.inf, -math.inf, -0.0, 0.0, None,
              1e-4, 1e-3, 0.00012345, -2.5, 9999999999999998.0, 1.5e300, 2e23, 1e22, 1e23,
              -1e-7, 123456.789, 1e15, 5.684341886080802e-14, 100.0]
    expected = [str(v) for v in values]
    assert texts(spark, values, DoubleType(), pa.float64()) == expected


def misprinted(spark, values):
    df = spark.createDataFrame(pa.table({"x": pa.array(values, pa.float64())})).repartition(8)
    rows = df.select("x", py_text(F.col("x"), DoubleType()).alias("text")).collect()
    assert len(rows) == len(values)
    return [r for r in rows if r.text != str(r.x)]


def test_double_text_random(spark):
    """100,000 doubles of any bits and 30,000 of usual size."""
    rng = random.Random(7)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(100_000)]
    values += [rng.uniform(-1e3, 1e3) * 10.0 ** rng.randint(-12, 15) for _ in range(25_000)]
    values += [round(rng.uniform(-1e6, 1e6), rng.randint(0, 4)) for _ in range(5_000)]
    assert not misprinted(spark, values)


def test_double_text_at_the_edges(spark):
    """Powers of two and ten with their neighbours, and doubles of few bits."""
    edges = [2.0 ** i for i in range(-1074, 1024)] + [float(f"{m}e{e}") for e in range(-323, 309) for m in (1, 5)]
    values = [x for v in edges for x in (v, -v, math.nextafter(v, 0.0), math.nextafter(v, math.inf))]
    values += [5e-324 * i for i in range(500)] + [2.2250738585072014e-308, 1.7976931348623157e308]
    assert not misprinted(spark, values)


def test_other_cell_texts(spark):
    assert texts(spark, [0.1, None], FloatType(), pa.float32()) == [
        "0.10000000149011612", "None"]
    assert texts(spark, [True, False, None], BooleanType(), pa.bool_()) == [
        "True", "False", "None"]
    assert texts(spark, [3, -1, None], LongType(), pa.int64()) == ["3", "-1", "None"]
    assert texts(spark, ["a", None], StringType(), pa.string()) == ["a", "None"]
    with pytest.raises(TypeError):
        py_text(F.col("x"), ArrayType(LongType()))


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("path", [
    "/user/feeds/station_status/station_status_2023-01-05_17-08-04-891.parquet",
    "file:/a/b/c/d/e/f/other_2023-01-05_17-08-04-891.parquet",
    "/archive_2022-02-02_02-02-02-222/x_2023-01-05_17-08-04-891.parquet",
])
def test_stamp_from_path(spark, path):
    ts = stamps.file_stamp(F.lit(path))
    assert one(spark, ts) == datetime(2023, 1, 5, 17, 8, 4, 891000)
    assert one(spark, stamps.hour_stamp(ts)) == "2023-01-05_17"
    assert one(spark, stamps.hour_index(ts)) == 17
    assert one(spark, stamps.day_stamp(ts)) == "2023-01-05"


def test_stamp_missing(spark):
    for path in ("/a_2023-01-05_17-08-04-891/x.parquet", "x_2023-13-05_17-08-04-891.parquet",
                 "2023-01-05.parquet", ""):
        assert one(spark, stamps.file_stamp(F.lit(path))) is None


def test_previous_hour(spark):
    assert stamps.previous_hour("2023-01-01_00") == "2022-12-31_23"
    ts = F.lit("2023-01-01 00:10:00").cast("timestamp_ntz")
    assert one(spark, stamps.prev_hour_stamp(ts)) == "2022-12-31_23"


def test_stamps_do_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist on this day in New York.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = stamps.file_stamp(F.lit("x_2023-03-12_02-30-00-000.parquet"))
        assert one(spark, stamps.hour_stamp(ts)) == "2023-03-12_02"
        assert one(spark, stamps.prev_hour_stamp(ts)) == "2023-03-12_01"
        hours = stamps.hour_range(spark, "2023-03-12_01", "2023-03-12_04").select("stamp")
        assert sorted(r[0][-2:] for r in hours.collect()) == ["01", "02", "03", "04"]
        assert one(spark, stamps.in_hours(ts, "2023-03-12_02")) is True
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hour_range(spark):
    def stamps_of(first, last):
        return sorted(r["stamp"] for r in stamps.hour_range(spark, first, last).collect())

    found = stamps_of("2023-01-05_17", "2023-01-08_05")
    assert len(found) == 61 and found[0] == "2023-01-05_17" and found[-1] == "2023-01-08_05"
    assert stamps_of("2023-01-05_17", "2023-01-05_17") == ["2023-01-05_17"]
    assert stamps_of("2023-01-05_17", "2023-01-05_16") == []


def test_row_key(spark):
    null = F.lit(None).cast("string")
    assert one(spark, stamps.row_key(F.lit("2023-01-05"), F.lit(7))) == "2023-01-05_7"
    assert one(spark, stamps.row_key(F.lit("2023-01-05_17"), null)) == "2023-01-05_17_None"
