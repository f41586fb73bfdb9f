"""Feeds whose files differ: files grouped by what their footers say, one scan per group.

Footers are read by tasks; the driver gets the different schemas, cut down to the fields that are
wanted, and for each the paths of its files, which Spark lists there for any scan. Files of one
schema, the usual case, are one scan over a range of names. Numbers that are whole in
some files and double in others come out double; a field that a file lacks is null.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FractionalType,
    IntegralType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from cityviews.operators.aggregate import stack
from cityviews.sources.files import DAY, HOUR, stamped

STAMP = StructField("stamp_ts", TimestampNTZType())


@dataclass(frozen=True)
class Group:
    """Files of one schema, as far as it is wanted."""

    schema: StructType
    paths: list[str]


def _footers(batches):
    """``path`` and schema, as JSON, of each file."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    for batch in batches:
        kinds = []
        for path in batch.column("path").to_pylist():
            if path.startswith("file:"):
                system, place = fs.LocalFileSystem(), "/" + unquote(path[5:]).lstrip("/")
            else:
                system, place = fs.FileSystem.from_uri(path)
            found = pq.read_schema(place, filesystem=system).remove_metadata()
            kinds.append(from_arrow_schema(found, prefer_timestamp_ntz=True).json())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(kinds, pa.string())], ["path", "kind"])


def wanted_part(have: DataType, want: DataType) -> DataType:
    """``have``, with only those struct fields that ``want`` has."""
    if isinstance(have, StructType) and isinstance(want, StructType):
        return StructType([
            StructField(f.name, wanted_part(f.dataType, want[f.name].dataType))
            for f in have.fields if f.name in want.names])
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return ArrayType(wanted_part(have.elementType, want.elementType))
    return have


def nullable(kind: DataType) -> DataType:
    """``kind`` with everything nullable, so that schemas differ by fields and types alone."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(nullable(kind.elementType))
    return kind


def schema_groups(files: DataFrame, want: StructType, whole: bool = False) -> list[Group]:
    """The files of ``files(path)`` by schema, cut to ``want``; ``whole`` keeps all inner fields of it."""
    found = files.select("path").mapInArrow(_footers, "path string, kind string").groupBy("kind").agg(
        F.sort_array(F.collect_list("path")).alias("paths"))
    groups: dict[str, Group] = {}
    for row in found.collect():  # a row per different footer
        have = nullable(StructType.fromJson(json.loads(row["kind"])))
        cut = StructType([f for f in have.fields if f.name in want.names]) if whole else wanted_part(have, want)
        known = groups.setdefault(cut.json(), Group(cut, []))
        known.paths.extend(row["paths"])
    return [groups[k] for k in sorted(groups)]


def widest(kinds: list[DataType]) -> DataType:
    """The type that holds values of all ``kinds``: numbers widen, structs take the fields of all."""
    kinds = [k for k in kinds if not isinstance(k, NullType)] or kinds[:1]
    if all(isinstance(k, StructType) for k in kinds):
        names = list(dict.fromkeys(n for k in kinds for n in k.names))
        return StructType([
            StructField(n, widest([k[n].dataType for k in kinds if n in k.names])) for n in names])
    if all(isinstance(k, ArrayType) for k in kinds):
        return ArrayType(widest([k.elementType for k in kinds]))
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, IntegralType) for k in kinds):
        return LongType()
    if all(isinstance(k, (IntegralType, FractionalType)) for k in kinds):
        return DoubleType()
    raise ValueError(f"no type holds all of {', '.join(sorted({k.simpleString() for k in kinds}))}")


def widened(want: DataType, have: DataType) -> DataType:
    """``want``, with numbers as wide as those of ``have``; other types are as wanted."""
    if isinstance(want, StructType) and isinstance(have, StructType):
        return StructType([
            StructField(f.name, widened(f.dataType, have[f.name].dataType) if f.name in have.names else f.dataType)
            for f in want.fields])
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return ArrayType(widened(want.elementType, have.elementType))
    numbers = (IntegralType, FractionalType)
    return widest([want, have]) if isinstance(want, numbers) and isinstance(have, numbers) else want


def conformed(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` as ``want``, its struct fields matched by name."""
    if have == want:
        return value
    if isinstance(have, StructType) and isinstance(want, StructType):
        fields = [
            (conformed(value[f.name], have[f.name].dataType, f.dataType) if f.name in have.names
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda x: conformed(x, have.elementType, want.elementType))
    return value.cast(want)


def read_group(spark: SparkSession, group: Group) -> DataFrame:
    """Payload rows of a group, in the types of its files, with ``stamp_ts``."""
    reader, first = spark.read.schema(group.schema), group.paths[0]
    if f"/{DAY}=" in first:
        base = first[:first.index(f"/{DAY}=")]
        kind = StructType([*group.schema.fields, StructField(DAY, StringType()), StructField(HOUR, StringType())])
        reader = spark.read.schema(kind).option("basePath", base)
    return stamped(reader.parquet(*group.paths))


def read_files(files: DataFrame, want: StructType, open_fields: bool = False) -> DataFrame:
    """Payload rows of ``files(path)``, whatever number types they store, with ``stamp_ts``.

    The result has the types of ``want``, with numbers as wide as any file has them; with
    ``open_fields``, all inner fields that any file has.
    """
    spark = files.sparkSession
    groups = schema_groups(files, want, whole=open_fields)
    if open_fields and groups:
        want = StructType([
            StructField(f.name, widest([g.schema[f.name].dataType for g in groups if f.name in g.schema.names]))
            for f in want.fields if any(f.name in g.schema.names for g in groups)])
    want = nullable(want)
    for g in groups:
        want = widened(want, g.schema)
    frames = [
        read_group(spark, g).select(
            *[conformed(F.col(f.name), g.schema[f.name].dataType, f.dataType).alias(f.name)
              for f in want.fields if f.name in g.schema.names], "stamp_ts")
        for g in groups]
    if not frames:
        return spark.createDataFrame([], StructType([*want.fields, STAMP]))
    return stack(frames, StructType([*want.fields, STAMP]))
