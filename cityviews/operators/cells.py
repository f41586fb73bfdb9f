"""Cells: ``(row_key, col, val, version)`` rows, one per written cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField

from cityviews.functions.text import double_text, fewest_digits, py_text
from cityviews.operators.latest import latest_rows
from cityviews.operators.shape import check_mapped


def to_cells(
    df: DataFrame,
    families: Mapping[str, str],
    key: str = "row_key",
    version: str | None = "version",
    drop: Sequence[str] = (),
) -> DataFrame:
    """One row per column and row, with the value as text.

    A null value gives a cell ``None``; a column that ``df`` lacks gives no cell, so an
    older value of it survives.
    """
    kept = {key, version, *drop}
    fields = [f for f in df.schema.fields if f.name not in kept]
    check_mapped([f.name for f in fields], families)

    def cell(f: StructField) -> Column:
        value = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, (DoubleType, FloatType))
        return F.struct(
            F.lit(f"{families[f.name]}:{f.name}").alias("col"),
            (F.lit(None) if number else py_text(value, f.dataType))
            .cast("string").alias("text"),
            (value if number else F.lit(None)).cast("double").alias("number"),
        )

    columns = [F.col(key).cast("string").alias("row_key")]
    if version is not None:
        columns.append(F.col(version).alias("version"))
    cells = df.select(*columns, F.inline(F.array(*[cell(f) for f in fields])))
    val = F.col("text")
    if any(isinstance(f.dataType, (DoubleType, FloatType)) for f in fields):
        # Doubles are turned to text after the columns became rows, so the generated code
        # holds that long expression once and not once per column.
        cells = cells.withColumn("digits", fewest_digits(F.col("number")))
        number = F.when(
            F.col("number").isNotNull(), double_text(F.col("number"), F.col("digits")))
        val = F.coalesce(val, number, F.lit("None"))
    return cells.select(
        "row_key", "col", val.alias("val"), *(["version"] if version is not None else []))


def latest_cells(cells: DataFrame, order: Sequence[str] = ("version",)) -> DataFrame:
    """The cell written last per row and column."""
    return latest_rows(cells, ["row_key", "col"], order)


def cells_to_rows(
    cells: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    order: Sequence[str] = ("version",),
) -> DataFrame:
    """One row per ``row_key`` with the latest value of each column, as text.

    ``columns`` names the cells to show, as a list of ``family:column`` or a mapping of it
    to an output name. Picking the latest value and pivoting share one aggregation.
    """
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}

    def latest(col: str) -> Column:
        candidate = F.struct(*order, "val")
        return F.max(F.when(F.col("col") == col, candidate)).getField("val")

    return (
        cells.where(F.col("col").isin(*names))
        .groupBy("row_key")
        .agg(*[latest(c).alias(name) for c, name in names.items()])
    )
