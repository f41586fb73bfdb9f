import pytest
from fixtures import rows
from pyspark.sql import functions as F

from cityviews.operators import aggregate, cells, latest, shape


def test_expand_struct(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 2, 'b', 'x') AS s")
    assert shape.expand_struct(df, "s").columns == ["a", "b"]
    assert shape.expand_struct(df, "s", keep=["id"]).columns == ["id", "a", "b"]


def test_explode_drops_null_and_empty(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, named_struct('stations', array(named_struct('a', 1, 'b', 2),
                                             named_struct('a', 3, 'b', 4)))),
          (2, named_struct('stations', array())),
          (3, named_struct('stations', null)),
          (4, null) AS t(id, data)""")
    assert rows(shape.explode_entities(df, "data.stations", ["a"], keep=["id"])) == {
        (1, 1), (1, 3)}
    assert rows(shape.explode_entities(df, "data.stations")) == {(1, 2), (3, 4)}


def test_pick_at(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (0, array('a', 'b'), array(1.0, null)), (1, array('a', 'b'), null) AS t(h, time, m)""")
    assert rows(shape.pick_at(df, F.col("h"), keep=["h"]), "h", "time") == {
        (0, "a"), (1, "b")}
    assert rows(shape.pick_at(df, F.col("h")), "m") == {(1,), (None,)}
    assert rows(shape.pick_at(df, F.lit(5), strict=False).distinct()) == {(None, None)}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_pick_at_is_strict_in_any_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        short = spark.sql("SELECT array(1, 2) AS metric")
        with pytest.raises(Exception, match="array metric has no slot 17"):
            shape.pick_at(short, F.lit(17)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_union_member(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, named_struct('member0', null, 'member1', 1.5D)),
        (2, named_struct('member0', cast(2.5 AS float), 'member1', null)),
        (3, null) AS t(id, lon)""")
    strict = shape.union_member(df, "lon")
    repaired = shape.union_member(df, "lon", repair=True)
    assert rows(df.select("id", strict, repaired)) == {
        (1, 1.5, 1.5), (2, None, 2.5), (3, None, None)}
    assert rows(df.select(shape.union_member(df, "id").alias("id"))) == {
        (1.0,), (2.0,), (3.0,)}


def test_qualify(spark):
    df = spark.sql("SELECT 1 AS lon, 2 AS name")
    assert shape.qualify(df, {"lon": "geo", "name": "detail"}).columns == [
        "geo:lon", "detail:name"]
    with pytest.raises(ValueError, match="name, extra"):
        shape.qualify(df.withColumn("extra", F.lit(1)), {"lon": "geo"})


def test_means_ignore_nulls_and_keep_null_keys(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('a', 1, null), ('a', null, null), ('a', 4, null), (null, 5, 6) AS t(k, x, y)""")
    expected = {("a", 2.5, None), (None, 5.0, 6.0)}
    assert rows(aggregate.mean_by(df, ["k"], ["x", "y"])) == expected
    parts = aggregate.mean_parts(df, ["k"], ["x", "y"])
    assert rows(aggregate.finish_means(parts, ["k"], ["x", "y"])) == expected


def test_stack_keeps_duplicates_and_widens(spark):
    whole, double = spark.sql("SELECT 1 AS id, 2L AS m"), spark.sql("SELECT 2.5D AS m, 1 AS id")
    both = aggregate.stack([whole, whole, double])
    assert dict(both.dtypes)["m"] == "double"
    assert sorted(r["m"] for r in both.collect()) == [2.0, 2.0, 2.5]
    filled = aggregate.stack([whole.drop("m"), double], double.schema)
    assert rows(filled, "id", "m") == {(1, None), (1, 2.5)}


def test_latest_rows(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('a', 1, 'old'), ('a', 2, 'new'), ('b', 1, 'x'), ('b', 1, 'y'), ('b', 1, null),
        (null, 1, 'n'), ('c', null, 'u'), ('c', 0, 'v') AS t(k, version, val)""")
    assert rows(latest.latest_rows(df, ["k"], ["version"])) == {
        ("a", 2, "new"), ("b", 1, "y"), (None, 1, "n"), ("c", 0, "v")}


def test_cells(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('k1', 1L, 2.0D, true, 1), ('k2', null, 1e20D, null, 2)
        AS t(row_key, n, x, flag, version)""")
    families = {"n": "id", "x": "metric", "flag": "status"}
    assert rows(cells.to_cells(df, families)) == {
        ("k1", "id:n", "1", 1), ("k1", "metric:x", "2.0", 1), ("k1", "status:flag", "True", 1),
        ("k2", "id:n", "None", 2), ("k2", "metric:x", "1e+20", 2),
        ("k2", "status:flag", "None", 2)}
    assert cells.to_cells(df, families, version=None, drop=["version"]).columns == [
        "row_key", "col", "val"]
    with pytest.raises(ValueError, match="flag"):
        cells.to_cells(df, {"n": "id", "x": "metric"})


def test_null_cell_overwrites_and_absent_cell_does_not(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('k', 'metric:a', '1', 1), ('k', 'metric:a', 'None', 2),
        ('k', 'metric:b', '7', 1), ('j', 'metric:b', '8', 1), ('j', 'id:c', '9', 1)
        AS t(row_key, col, val, version)""")
    assert rows(cells.latest_cells(df), "row_key", "col", "val") == {
        ("k", "metric:a", "None"), ("k", "metric:b", "7"), ("j", "metric:b", "8"),
        ("j", "id:c", "9")}
    wide = cells.cells_to_rows(df, {"metric:a": "a", "metric:b": "b"})
    assert rows(wide, "row_key", "a", "b") == {("k", "None", "7"), ("j", None, "8")}
    assert cells.cells_to_rows(df, ["metric:a"]).columns == ["row_key", "metric:a"]
