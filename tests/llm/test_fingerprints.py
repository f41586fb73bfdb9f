import hashlib
import re
from collections import Counter

import pytest
import xxhash
from helpers import awkward, words_of
from pyspark.sql import functions as F

from cityviews.llm import fingerprints as P
from cityviews.llm.common import id_ranges


def brute_sketch(text, k=P.K, words=P.WORDS):
    w = [x for x in re.split(r"[ \t-\r]+", text.lower()) if x]
    groups = [w[i:i + words] for i in range(max(1, len(w) - words + 1))] if w else []
    out = set()
    for g in groups:
        h = 42
        for x in g:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return sorted(out)[:k]


def brute_near(a, b, k=P.K):
    union = sorted(set(a) | set(b))[:k]
    return 1.0 if not union else len(set(union) & set(a) & set(b)) / len(union)


def spread(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def brute(docs, k=P.K):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, spread(d[1]), d[1]))
    out = []
    for i, (doc, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + following[:q]
        a, b, c = brute_sketch(text, k), brute_sketch(edited, k), brute_sketch(following, k)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    "".join(f"{h % (1 << 64):016x}" for h in a), "".join(f"{h % (1 << 64):016x}" for h in b),
                    brute_near(a, b, k), brute_near(a, c, k)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("each", [2_000, 2])
def test_awkward_rows(spark, monkeypatch, each):
    monkeypatch.setattr(P, "EACH", each)
    docs = awkward(spark).repartition(3)
    want = brute([(r.doc_id, r.text or "") for r in docs.collect()])
    assert sorted((tuple(r) for r in P.fingerprint_edits(docs).collect()), key=repr) == want


def test_one_row_and_empty_table(spark):
    one = spark.createDataFrame([(3, "a b c d e f g h")], "doc_id long, text string")
    assert [tuple(r) for r in P.fingerprint_edits(one).collect()] == brute([(3, "a b c d e f g h")])
    assert P.fingerprint_edits(awkward(spark, empty=True)).count() == 0


def test_more_ranges_than_one_level_has(spark, monkeypatch):
    """3,000 rows in some 2,000 ranges; one id holds half of the rows, nulls a tenth."""
    monkeypatch.setattr(P, "EACH", 1)
    docs = [(None if i % 10 == 0 else 77 if i % 2 else i * i % 5003, f"w{i % 2900} a b c d e f{i}")
            for i in range(3_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in P.fingerprint_edits(df).collect()), key=repr) == brute(docs)


def test_ranges_keep_order_and_split_one_id(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.xxhash64("id") % 9_973).cast("bigint").alias("k"),
        F.xxhash64(F.col("id"), F.lit("x")).alias("h"))
    for each in (2_000, 10):
        rows = sorted((tuple(r) for r in id_ranges(df, "k", "h", each).select("k", "h", "_r").collect()))
        assert len(rows) == 40_000
        assert [r[2] for r in rows] == sorted(r[2] for r in rows)
        sizes = Counter(r[2] for r in rows)
        assert max(sizes.values()) <= 4 * each + 40
        assert each > 10 or len(sizes) > 1_024
    one = id_ranges(spark.range(9).select(F.lit(1).cast("bigint").alias("k"), F.col("id").alias("h")), "k", "h", 99)
    assert {r._r for r in one.collect()} == {0}


def test_estimates_and_merging(spark):
    a, b = words_of(1, 4000), words_of(1, 3000) + words_of(2, 1000)
    df = spark.createDataFrame(
        [(1, " ".join(a)), (1, " ".join(b)), (2, "")], "key int, text string").select(
        "key", P.sketch(F.col("text")).alias("s"))
    x, y = brute_sketch(" ".join(a)), brute_sketch(" ".join(b))
    merged = {r.key: r.s for r in P.merge_by(df, ["key"], "s", salts=4).collect()}
    assert merged == {1: sorted({*x, *y})[:P.K]}
    pair = spark.createDataFrame([(x, y, [])], "x array<long>, y array<long>, z array<long>")
    got = pair.select(
        P.resemblance(F.col("x"), F.col("y")), P.containment(F.col("x"), F.col("y")),
        P.distinct_shingles(F.col("x")), P.resemblance(F.col("z"), F.col("z")),
        P.distinct_shingles(F.col("z"))).first()
    set_of = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    s, t = set_of(a), set_of(b)
    assert abs(got[0] - len(s & t) / len(s | t)) < 0.15
    assert abs(got[1] - len(s & t) / len(s)) < 0.2
    assert abs(got[2] / len(s) - 1) < 0.3
    assert got[3] == 1.0 and got[4] == 0.0


def test_main_path_stays_on_the_jvm(spark):
    plan = P.fingerprint_edits(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
