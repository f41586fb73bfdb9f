"""Shape operators: struct expansion, array explode, array pick, union members, families."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def expand_struct(df: DataFrame, struct: str, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of a struct as columns, after the columns in ``keep``."""
    return df.select(*keep, f"{struct}.*")


def explode_entities(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per struct of the array at ``path``; no row for a null or empty array.

    The scan should already hold only the needed fields (``schemas.station_feed``), as
    fields of an exploded array are not pruned by the optimizer.
    """
    entities = df.select(*keep, F.explode(path).alias("_entity"))
    fields = [F.col(f"_entity.{c}") for c in columns] if columns else [F.col("_entity.*")]
    return entities.select(*keep, *fields)


def pick_at(
    df: DataFrame, index: Column, keep: Sequence[str] = (), strict: bool = True
) -> DataFrame:
    """Element ``index`` of every array column; the columns in ``keep`` stay as they are.

    ``strict`` fails on an array that is too short, in ANSI mode or not; otherwise the
    value is null. A null array gives null in both cases.
    """
    def element(name: str) -> Column:
        arr = F.col(name)
        value = F.get(arr, index)
        if strict:
            message = F.concat(
                F.lit(f"array {name} has no slot "), index.cast("string"))
            value = F.when(
                arr.isNotNull() & (F.size(arr) <= index), F.raise_error(message)
            ).otherwise(value)
        return value.alias(name)

    arrays = [f.name for f in df.schema.fields
              if isinstance(f.dataType, ArrayType) and f.name not in keep]
    return df.select(*keep, *[element(c) for c in arrays])


def union_member(df: DataFrame, column: str, repair: bool = False) -> Column:
    """Value of a numeric union struct: its ``member1``.

    With ``repair``, ``member0`` stands in where ``member1`` is null. A null struct gives
    null; a column that is a plain number already is passed through.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, StructType):
        return F.col(column).cast("double")
    value = F.col(f"{column}.member1").cast("double")
    if repair and "member0" in kind.fieldNames():
        value = F.coalesce(value, F.col(f"{column}.member0").cast("double"))
    return value


def check_mapped(columns: Iterable[str], families: Mapping[str, str]) -> None:
    """Fail, naming them all, if some columns have no family."""
    unmapped = [c for c in columns if c not in families]
    if unmapped:
        raise ValueError(f"columns without a family: {', '.join(unmapped)}")


def qualify(
    df: DataFrame, families: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Rename every column to ``family:column``, except those in ``keep``."""
    columns = [c for c in df.columns if c not in keep]
    check_mapped(columns, families)
    return df.withColumnsRenamed({c: f"{families[c]}:{c}" for c in columns})
