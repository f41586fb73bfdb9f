"""Sharding by jump consistent hashing.

A key walks from bucket to larger bucket: from ``b`` it jumps to ``floor((b + 1) / r)``, where
``r`` in (0, 1] is drawn from the key and ``b``; the last bucket below the number of shards is
its shard. There is no ring table, and with one more shard a key either stays or moves to the
new shard. All of it is DataFrame code.

Law ``key``: ``doc_id`` and the number of shards alone decide. Null ids are one key. Rows with
equal ids, equal texts or both share no slot. Null text: size 8, checksum 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import before, buckets_for

DRAW = 1 << 32
EACH = 50_000  # rows of a shard that one task numbers


def _walk(key: Column, start: Column, shards: int, steps: int) -> Column:
    """Jumps until the next bucket is ``shards`` or more, ``steps`` times at most."""

    def jump(state: Column, _: Column) -> Column:
        name = F.concat_ws(":", key, state["next"].cast("string"))
        draw = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint")
        return F.when(state["next"] >= shards, state).otherwise(F.struct(
            state["next"].alias("at"),
            F.call_function("div", (state["next"] + 1) * F.lit(DRAW), draw + 1).alias("next")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, jump)


def jump(key: Column, shards: int) -> Column:
    """Struct of ``at``, the shard of ``key`` among ``shards``, and ``next``, where it would jump.

    About log(shards) jumps are made; the rare key that needs over 64 goes on to its end.
    """
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("at"), zero.alias("next"))
    done = _walk(key, start, shards, min(shards, 64))
    if shards <= 64:
        return done
    return F.when(done["next"] >= shards, done).otherwise(_walk(key, done, shards, shards))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard, gapless slot in it, and shard if there were one more, of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    # equal rows are numbered together, so that a hot id is one row here
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_m"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = rows.withColumn("_walk", jump(key, shards)).select(
        "doc_id", "size", "text_crc32", "_m",
        F.col("_walk.at").cast("int").alias("shard"),
        F.when(F.col("_walk.next") == shards, F.lit(shards)).otherwise(F.col("_walk.at"))
        .cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32"),
               F.lit(buckets_for(docs.count(), EACH))).alias("_part"))
    rows = before(rows, ["shard"], "_part",
                  [F.col("doc_id"), F.col("size"), F.col("text_crc32")], F.col("_m"), "_first")
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence("_first", F.col("_first") + F.col("_m") - 1)).alias("slot"),
        "grown_shard")
