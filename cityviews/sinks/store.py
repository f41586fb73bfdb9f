"""Keyed views on parquet: append batches, merge on read, compact now and then.

Layout of a view folder::

    heads/                                     what is valid: era, upto, period; what is stored
    log/era=E/batch=B/source=S/[period=P/]     the rows of one batch
    base/era=E/upto=B/[period=P/]              merged rows of all batches up to B
    ledger/era=E/batch=B/source=S/             names of the files that a batch counted

A batch counts once it is whole: readers, numbering and compaction take only folders with the mark
that Spark leaves when a write job commits. A batch is written into its own folder,
so writing it again (a replay) replaces it and changes nothing else. A compaction or reset becomes visible
only when its one file lands in ``heads``; readers never see half of one. One writer per view at a time.

The state is the newest base plus the batches after it, merged per key. Views whose keys
start with a day are partitioned by its year, month or day, whichever gives files of a
fair size, and sorted by key, so reading a range of days opens only what it needs. A
compaction rewrites only periods with new rows; the base of the others stays valid. It also removes
what the compaction before it replaced, so that readers which began in between still find theirs.

Views whose rows add up keep a ledger of file names: a file that some batch has counted is not
counted again, whichever way it comes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cityviews.operators.latest import latest_rows


@dataclass(frozen=True)
class ViewSpec:
    """How a view is stored and merged.

    ``rule`` is ``"version"`` (greatest version wins, replays of old files are harmless),
    ``"ingest"`` (the batch written last wins) or ``"add"`` (``*_sum`` and ``*_count``
    columns are added up per key). ``period`` is the number of leading characters of the
    row key to partition by: 4 a year, 7 a month, 10 a day, None for keys without a date.
    """

    name: str
    schema: StructType
    keys: tuple[str, ...] = ("row_key",)
    period: int | None = 10
    rule: str = "version"

    def __post_init__(self):
        if self.rule not in ("version", "ingest", "add"):
            raise ValueError(f"unknown rule {self.rule}")

    @property
    def identity(self) -> str:
        """What must agree between those who write and read a view; the rule is the reader's."""
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(self.keys)
        return f"{self.name} ({fields}) by {keys}, period {self.period}"

    @property
    def stored(self) -> StructType:
        fields = [*self.schema.fields, StructField("batch", LongType())]
        if self.period:
            fields.append(StructField("period", StringType()))
        return StructType(fields)


HEADS = "era long, upto long, period string, spec string"


@dataclass(frozen=True)
class Head:
    era: int
    upto: int


def _log(path: str, era: int) -> str:
    return f"{path}/log/era={era}"


def _base(path: str, era: int) -> str:
    return f"{path}/base/era={era}"


def _ledger(path: str, era: int) -> str:
    return f"{path}/ledger/era={era}"


#: What Spark's file committers leave in a folder once all of it is written.
DONE = "_SUCCESS"


@dataclass(frozen=True)
class Landed:
    """A batch folder that is whole."""

    batch: int
    source: str
    folder: str


def _hadoop(spark: SparkSession, path: str):
    """Spark's own file system for ``path``, and the path."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    system, place = _hadoop(spark, pattern)
    return [x.getPath().toString() for x in system.globStatus(place) or []]


def _remove(spark: SparkSession, folder: str) -> None:
    system, place = _hadoop(spark, folder)
    system.delete(place, True)


def _whole(spark: SparkSession, root: str) -> list[Landed]:
    """Batch folders below ``root`` whose write has committed: a name per batch since the last compactions."""
    found = []
    for mark in _glob(spark, f"{root}/batch=*/source=*/{DONE}"):
        folder = mark[:-len(DONE) - 1]
        batch, source = re.search(r"/batch=(-?\d+)/source=([^/]+)$", folder).groups()
        found.append(Landed(int(batch), source, folder))
    return found


def _empty(spark: SparkSession, spec: ViewSpec) -> DataFrame:
    return spark.createDataFrame([], spec.stored)


def _publish(
    spark: SparkSession, spec: ViewSpec, path: str, head: Head, mode: str,
    periods: DataFrame | None = None,
) -> None:
    """One file: a row for the head itself and one per period with a new base."""
    rows = spark.range(1).select(F.lit(None).cast("string").alias("period"))
    if periods is not None:
        rows = rows.unionByName(periods)
    rows = rows.select(
        F.lit(head.era).cast("long").alias("era"), F.lit(head.upto).cast("long").alias("upto"),
        "period", F.lit(spec.identity).alias("spec"))
    rows.coalesce(1).write.mode(mode).parquet(f"{path}/heads")


def _writer(rows: DataFrame, spec: ViewSpec) -> DataFrameWriter:
    # Rebalancing gathers a period into few files and splits one too large for a task.
    if spec.period is None:
        rows = rows.hint("rebalance").sortWithinPartitions("row_key")
    else:
        rows = (
            rows.withColumn("period", F.substring("row_key", 1, spec.period))
            .hint("rebalance", "period").sortWithinPartitions("period", "row_key"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    return writer if spec.period is None else writer.partitionBy("period")


def create_view(spark: SparkSession, spec: ViewSpec, path: str) -> None:
    """Make the view folder if it is not there; an existing view is left as it is."""
    _empty(spark, spec).write.mode("ignore").parquet(_log(path, 0))
    _publish(spark, spec, path, Head(0, -1), "ignore")


def _heads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEADS).parquet(f"{path}/heads")


def view_head(spark: SparkSession, path: str, spec: ViewSpec | None = None) -> Head:
    """The newest head; fails if the folder holds another view than ``spec``."""
    row = _heads(spark, path).agg(
        F.max(F.struct("era", "upto")).alias("head"), F.max("spec").alias("spec")).first()
    if spec is not None and row["spec"] not in (None, spec.identity):
        raise ValueError(f"{path} holds {row['spec']}, not {spec.identity}")
    return Head(row["head"]["era"], row["head"]["upto"])


def _log_rows(
    spark: SparkSession, spec: ViewSpec, path: str, head: Head, last: int | None = None
) -> DataFrame:
    """Rows of the whole batches that no base holds yet, up to batch ``last``."""
    log = _log(path, head.era)
    folders = [x.folder for x in _whole(spark, log)
               if x.batch > head.upto and (last is None or x.batch <= last)]
    if not folders:
        return _empty(spark, spec)
    rows = spark.read.schema(spec.stored).option("basePath", log).parquet(*sorted(folders))
    return rows.select(*spec.stored.fieldNames())


def _last_batch(spark: SparkSession, path: str, head: Head) -> int | None:
    """The greatest number of a whole batch that no base holds."""
    fresh = [x.batch for x in _whole(spark, _log(path, head.era)) if x.batch > head.upto]
    return max(fresh, default=None)


def next_batch(spark: SparkSession, spec: ViewSpec, path: str) -> int:
    """The number after all batches so far."""
    head = view_head(spark, path, spec)
    last = _last_batch(spark, path, head)
    return (head.upto if last is None else last) + 1


def source_batch(spark: SparkSession, spec: ViewSpec, path: str, source: str) -> int | None:
    """Number of the whole batch that ``source`` wrote; None if it wrote none."""
    head = view_head(spark, path, spec)
    return max((x.batch for x in _whole(spark, _log(path, head.era)) if x.source == source), default=None)


def upsert_view(
    df: DataFrame,
    spec: ViewSpec,
    path: str,
    batch: int | None = None,
    source: str = "direct",
) -> None:
    """Write the rows of ``df`` as one batch.

    Without a number it is a new batch, the last one. With the number of an earlier batch
    of the same source it replaces that one, which is how a retry stays without effect;
    under the rule ``"add"``, where a second copy would count twice, a number is required.
    """
    if batch is None and spec.rule == "add":
        raise ValueError(f"{spec.name} adds batches up, so a batch needs a number")
    spark = df.sparkSession
    head = view_head(spark, path, spec)
    if batch is None:
        batch = next_batch(spark, spec, path)
    if batch < 0 or batch <= head.upto:
        raise ValueError(
            f"batch {batch} of {spec.name} is negative or compacted (up to {head.upto})")
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields])
    _writer(rows, spec).parquet(f"{_log(path, head.era)}/batch={batch}/source={source}")


def upsert_once(
    df: DataFrame, spec: ViewSpec, path: str, source: str, files: DataFrame | None = None
) -> None:
    """Write the rows of ``df``, which ``source`` names, so that they count once.

    The name is stored with the rows. If it is there already, from a run that failed after
    writing, its batch is replaced; if that batch is compacted, nothing is left
    to do. ``files(file)`` are the files that the rows come from, for the ledger. It is written first and
    counts only if the batch does.
    """
    spark = df.sparkSession
    batch = source_batch(spark, spec, path, source)
    head = view_head(spark, path, spec)
    if batch is None:
        batch = next_batch(spark, spec, path)
    elif batch <= head.upto:
        return
    if files is not None:
        files.select("file").distinct().write.mode("overwrite").parquet(
            f"{_ledger(path, head.era)}/batch={batch}/source={source}")
    upsert_view(df, spec, path, batch, source)


def uncounted(files: DataFrame, spec: ViewSpec, path: str, source: str | None = None) -> DataFrame:
    """Those of ``files(file, ..)`` that no whole batch has counted, but for one of ``source``."""
    spark = files.sparkSession
    head = view_head(spark, path, spec)
    log = {(x.batch, x.source) for x in _whole(spark, _log(path, head.era))}
    folders = [x.folder for x in _whole(spark, _ledger(path, head.era))
               if x.source != source and (x.batch <= head.upto or (x.batch, x.source) in log)]
    if not folders:
        return files
    known = spark.read.schema("file string").parquet(*sorted(folders))
    return files.join(known.distinct(), "file", "left_anti")


def _base_rows(
    spark: SparkSession, spec: ViewSpec, path: str, head: Head
) -> DataFrame | None:
    """Rows of the newest base of every period; None before the first compaction."""
    if head.upto < 0:
        return None
    base = spark.read.schema(StructType([*spec.stored.fields, StructField("upto", LongType())]))
    rows = base.option("basePath", _base(path, head.era)).parquet(_base(path, head.era))
    if spec.period is None:
        rows = rows.where(F.col("upto") == head.upto)
    else:
        # One row per period, so this is a small side and it prunes the folders read.
        valid = (
            _heads(spark, path).where((F.col("era") == head.era) & F.col("period").isNotNull())
            .groupBy("period").agg(F.max("upto").alias("upto"))
        )
        rows = rows.join(valid, ["period", "upto"], "left_semi")
    return rows.select(*spec.stored.fieldNames())


def _merged(rows: DataFrame, spec: ViewSpec) -> DataFrame:
    rows = rows.select(*spec.schema.fieldNames(), "batch")
    if spec.rule == "add":
        sums = [
            F.sum(c).alias(c) for c in spec.schema.fieldNames()
            if c.endswith(("_sum", "_count"))
        ]
        return rows.groupBy(*spec.keys).agg(
            *sums, F.max("version").alias("version"), F.max("batch").alias("batch"))
    order = ["version", "batch"] if spec.rule == "version" else ["batch", "version"]
    return latest_rows(rows, spec.keys, order)


def _in_days(spec: ViewSpec, first: str, last: str):
    """Predicate on folders and on sorted keys: the row key's day is in the range."""
    if spec.period is None:
        raise ValueError(f"keys of {spec.name} have no date")
    after = (date.fromisoformat(last) + timedelta(days=1)).isoformat()
    return (
        F.col("period").between(first[:spec.period], last[:spec.period])
        & (F.col("row_key") >= first) & (F.col("row_key") < after)
    )


def read_view(
    spark: SparkSession,
    spec: ViewSpec,
    path: str,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """The state of the view, one row per key; of a range of days if one is given."""
    head = view_head(spark, path, spec)
    rows, base = _log_rows(spark, spec, path, head), _base_rows(spark, spec, path, head)
    if base is not None:
        rows = rows.unionByName(base)
    if first_day is not None:
        rows = rows.where(_in_days(spec, first_day, last_day or first_day))
    return _merged(rows, spec).select(*spec.schema.fieldNames())


def open_view(spark: SparkSession, spec: ViewSpec, path: str) -> DataFrame:
    """Read the view and name it, so that SQL can query it by the view's name."""
    df = read_view(spark, spec, path)
    df.createOrReplaceTempView(spec.name)
    return df


def compact_view(
    spark: SparkSession, spec: ViewSpec, path: str, upto: int | None = None
) -> None:
    """Merge the whole batches up to number ``upto`` (the last one) into a new base.

    A batch that is half written then, as its job failed, is left out and comes back under a new
    number when it is replayed. What the compaction before this one replaced is removed, but for the
    last batch of each stream, by which a replay of it is known.
    """
    head = view_head(spark, path, spec)
    last = _last_batch(spark, path, head)
    upto = last if upto is None else upto
    if last is None or upto is None or upto <= head.upto:
        return
    rows = fresh = _log_rows(spark, spec, path, head, upto)
    touched = None if spec.period is None else fresh.select("period").distinct()
    base = _base_rows(spark, spec, path, head)
    if base is not None:
        if touched is not None:
            base = base.join(touched, "period", "left_semi")
        rows = rows.unionByName(base)
    merged = _merged(rows, spec).select(*spec.schema.fieldNames(), "batch")
    _writer(merged, spec).parquet(f"{_base(path, head.era)}/upto={upto}")
    _merge_ledger(spark, path, head, upto)
    _publish(spark, spec, path, Head(head.era, upto), "append", touched)
    _retire(spark, spec, path, head)


def _merge_ledger(spark: SparkSession, path: str, head: Head, upto: int) -> None:
    """One ledger folder for all whole batches up to ``upto``; those of half-written ones go."""
    ledger = _ledger(path, head.era)
    log = {(x.batch, x.source) for x in _whole(spark, _log(path, head.era))}
    old = [x for x in _whole(spark, ledger) if x.batch <= upto]
    valid = [x.folder for x in old if x.batch <= head.upto or (x.batch, x.source) in log]
    if valid:
        spark.read.schema("file string").parquet(*sorted(valid)).distinct().write.mode("overwrite").parquet(
            f"{ledger}/batch={upto}/source=merged")
    for x in old:
        if (x.batch, x.source) != (upto, "merged"):
            _remove(spark, x.folder)


def _retire(spark: SparkSession, spec: ViewSpec, path: str, before: Head) -> None:
    """Remove batches and bases that were not read any more when the head was ``before``."""
    if before.upto < 0:
        return
    log = _log(path, before.era)
    newest: dict[str, int] = {}
    for x in _whole(spark, log):
        stream = x.source.rpartition("-")[0] or x.source
        newest[stream] = max(newest.get(stream, -1), x.batch)
    for folder in _glob(spark, f"{log}/batch=*/source=*"):
        batch, source = re.search(r"/batch=(-?\d+)/source=([^/]+)$", folder).groups()
        if int(batch) <= before.upto and int(batch) != newest.get(source.rpartition("-")[0] or source):
            _remove(spark, folder)
    for folder in _glob(spark, f"{log}/batch=*"):
        system, place = _hadoop(spark, folder)
        if int(folder.rpartition("=")[2]) <= before.upto and not system.listStatus(place):
            _remove(spark, folder)
    root = _base(path, before.era)
    if spec.period is None:
        stale = [x for x in _glob(spark, f"{root}/upto=*") if int(x.rpartition("=")[2]) < before.upto]
    else:
        # a row per period
        valid = {r["period"]: r["upto"] for r in _heads(spark, path).where(
            (F.col("era") == before.era) & F.col("period").isNotNull() & (F.col("upto") <= before.upto)
        ).groupBy("period").agg(F.max("upto").alias("upto")).collect()}
        stale = []
        for folder in _glob(spark, f"{root}/upto=*/period=*"):
            upto, period = re.search(r"/upto=(-?\d+)/period=([^/]+)$", folder).groups()
            if int(upto) < valid.get(period, -1):
                stale.append(folder)
    for folder in stale:
        _remove(spark, folder)


def reset_view(spark: SparkSession, spec: ViewSpec, path: str) -> None:
    """Leave the view empty, whether it was there or not."""
    create_view(spark, spec, path)
    old = view_head(spark, path, spec)
    _empty(spark, spec).write.mode("overwrite").parquet(_log(path, old.era + 1))
    _publish(spark, spec, path, Head(old.era + 1, -1), "append")
    for folder in (_log(path, old.era), _base(path, old.era)):
        _empty(spark, spec).write.mode("overwrite").parquet(folder)
