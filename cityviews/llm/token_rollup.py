"""Token counts by source, language and tokenizer version, kept up to date by deltas.

A batch of changes says which documents came (with their count), went (with the count they had)
or were counted anew (both). Each change is a signed row, so a batch is a small table of sums,
and totals are the sums of all committed batches: nothing is counted twice or read again. A
batch is written under a new name and counts once its name is in the commit table; a batch that
is committed already is left alone, so batches can be replayed. A compaction adds all
batches up into one base and keeps their names.

Null source or language are groups of their own. A null count is 0. One writer at a time.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityviews.llm.bpe import tokenizer
from cityviews.llm.common import by_bytes, saved

KEYS = ["source", "lang", "version"]
COMMITS = "number bigint, batch string, path string"
BASES = "upto bigint, path string"
SUMS = "source string, lang string, version string, docs bigint, tokens bigint"


def signed(changes: DataFrame) -> DataFrame:
    """Sums per key of ``changes(source, lang, version, old_tokens, new_tokens, op)``.

    ``op`` is insert, delete or revise; a hot key is one row per task before the shuffle.
    """
    old, new = F.coalesce("old_tokens", F.lit(0)), F.coalesce("new_tokens", F.lit(0))
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    count = F.when(F.col("op") == "insert", new).when(F.col("op") == "delete", -old).otherwise(new - old)
    return changes.groupBy(*KEYS).agg(
        F.sum(docs).cast("bigint").alias("docs"), F.sum(count).cast("bigint").alias("tokens"))


class Rollup:
    """Totals in ``folder``, which driver and executors share.

    ``commits`` has a row per batch since the last compaction, ``bases`` one per compaction.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.spark.createDataFrame([], COMMITS).write.mode("append").parquet(f"{self.folder}/commits")
        self.spark.createDataFrame([], BASES).write.mode("append").parquet(f"{self.folder}/bases")

    def _base(self) -> tuple[int, str | None]:
        """(last batch in it, folder) of the newest base."""
        found = self.spark.read.schema(BASES).parquet(f"{self.folder}/bases").agg(
            F.max(F.struct("upto", "path")).alias("b")).first()["b"]
        return (found["upto"], found["path"]) if found else (-1, None)

    def _since(self, upto: int) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(f"{self.folder}/commits").where(F.col("number") > upto)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False if it was there already, compacted or not."""
        upto, base = self._base()
        names = self._since(upto).select("batch")
        if base:
            names = names.unionByName(self.spark.read.schema("batch string").parquet(f"{base}/names"))
        if not names.where(F.col("batch") == batch).isEmpty():
            return False
        path = f"{self.folder}/batches/{uuid.uuid4().hex}"
        signed(changes).write.parquet(path)
        last = self._since(upto).agg(F.max("number")).first()[0]
        self._append("commits", COMMITS, ((upto if last is None else last) + 1, batch, path))
        return True

    def _append(self, table: str, schema: str, row: tuple) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{table}")

    def _sums(self) -> DataFrame:
        upto, base = self._base()
        paths = [r["path"] for r in self._since(upto).collect()]  # a row per batch since compaction
        paths += [f"{base}/sums"] if base else []
        if not paths:
            return self.spark.createDataFrame([], SUMS)
        return self.spark.read.schema(SUMS).parquet(*paths).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """``docs`` and ``tokens`` of each key that has documents or tokens."""
        return self._sums().where("docs != 0 or tokens != 0")

    def compact(self) -> None:
        """Replace all batches by one base, in one commit; their names stay known.

        A run that fails leaves folders that nothing names.
        """
        upto, base = self._base()
        new = self._since(upto)
        last = new.agg(F.max("number")).first()[0]
        if last is None:
            return
        names, path = new.select("batch"), f"{self.folder}/base/{uuid.uuid4().hex}"
        if base:
            names = names.unionByName(self.spark.read.schema("batch string").parquet(f"{base}/names"))
        names.coalesce(1).write.parquet(f"{path}/names")
        self._sums().coalesce(1).write.parquet(f"{path}/sums")
        self._append("bases", BASES, (last, path))


def counted(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, source, lang, digest, words, pieces`` for each row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"), text.alias("text"))

    def count(batches):
        encoder = tokenizer(tokenizer_path)
        for batch in by_bytes(batches, "text"):
            sizes = [len(x) for x in encoder.encode(batch.column("text"))]
            kept = batch.select(["doc_id", "source", "lang", "digest", "words"])
            yield kept.append_column("pieces", pa.array(sizes, pa.int64()))

    return rows.mapInArrow(
        count, "doc_id bigint, source string, lang string, digest string, words bigint, pieces bigint")


def rollup_documents(docs: DataFrame, tokenizer_path: str, folder: str) -> DataFrame:
    """Totals after three batches over all of ``docs``, each sent twice.

    ``load`` inserts every document, in both versions; ``copies`` deletes those whose text a
    smaller ``doc_id`` has; ``ends`` counts the others anew, with an end id in version ``bpe``. A
    compaction lies between the two rounds. A row without an id, or with the id of the first, is no copy;
    an empty table has no totals.
    """
    rows = saved(counted(docs, tokenizer_path), "counts")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("_first")).withColumnRenamed("digest", "_digest")
    # joined by text and id, so that no text, however often it comes, is one task's
    rows = saved(rows.join(
        first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left").select(
        "source", "lang", (F.col("doc_id").isNotNull() & F.col("_first").isNull()).alias("copy"), F.explode(F.array(
            F.struct(F.lit("words").alias("version"), F.col("words").alias("tokens"), F.lit(0).alias("end")),
            F.struct(F.lit("bpe").alias("version"), F.col("pieces").alias("tokens"), F.lit(1).alias("end")),
        )).alias("v")).select("source", "lang", F.coalesce("copy", F.lit(False)).alias("copy"), "v.*"), "changes")
    none = F.lit(None).cast("bigint")

    def batch(part: DataFrame, op: str, old, new) -> DataFrame:
        return part.select(*KEYS, F.lit(op).alias("op"), old.alias("old_tokens"), new.alias("new_tokens"))

    rollup = Rollup(docs.sparkSession, folder)
    count = F.col("tokens")
    for _ in range(2):
        rollup.commit("load", batch(rows, "insert", none, count))
        rollup.commit("copies", batch(rows.where("copy"), "delete", count, none))
        rollup.commit("ends", batch(rows.where("not copy"), "revise", count, count + F.col("end")))
        rollup.compact()
    return rollup.totals()
