import hashlib
import zlib
from collections import Counter

from helpers import awkward
from pyspark.sql import functions as F

from cityviews.llm.shards import jump, shard_documents


def brute(key, shards):
    at, following = 0, 0
    while following < shards:
        at = following
        draw = int(hashlib.md5(f"{key}:{at}".encode()).hexdigest()[:8], 16)
        following = (at + 1) * 2 ** 32 // (draw + 1)
    return at


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = shard_documents(docs, 7).collect()
    want = Counter()
    for r in docs.collect():
        data = (r.text or "").encode()
        key = "null" if r.doc_id is None else r.doc_id
        want[r.doc_id, len(data) + 8, zlib.crc32(data), "key", brute(key, 7), brute(key, 8)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    for shard in range(7):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 7) for r in got)


def test_slots_over_many_parts(spark, monkeypatch):
    from cityviews.llm import shards

    monkeypatch.setattr(shards, "EACH", 10)
    docs = spark.range(500).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("doc_id"),
                                   F.lit("x").alias("text"))
    got = shard_documents(docs, 5).collect()
    for shard in range(5):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len(got) == 500


def test_many_shards_and_even_spread(spark):
    n = 20_000
    for shards in (1, 24, 100):
        got = spark.range(n).select(jump(F.col("id").cast("string"), shards)["at"].alias("s")).groupBy("s").count().collect()
        assert len(got) == shards
        assert max(r["count"] for r in got) < 1.35 * n / shards
    got = [r.s for r in spark.range(50).select(jump(F.col("id").cast("string"), 300)["at"].alias("s")).collect()]
    assert got == [brute(i, 300) for i in range(50)]


def test_empty_table(spark):
    assert shard_documents(awkward(spark, empty=True)).count() == 0
