import hashlib
import random
import re
from collections import Counter

import numpy as np
from helpers import DOCS, LOWER, awkward, awkward_texts, rows

from cityviews.llm import queries
from cityviews.llm.line_dedup import Lines, Shard, build_shard, drop_lines, line_index

STRIP = " \t\n\x0b\f\r"


def brute(texts, least):
    split = [(i, (t or "").split("\n")) for i, t in texts]
    key = [[x.strip(STRIP).translate(LOWER) for x in lines] for _, lines in split]
    count = Counter(k for keys in key for k in set(keys))
    out = []
    for (i, lines), keys in zip(split, key):
        kept = [x for x, k in zip(lines, keys) if not k or count[k] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, *[None] * 3, *["x"] * (len(DOCS) - 5)) for i, t in texts], DOCS)


def lined(n=400):
    pick = random.Random(2)
    common = [f"Line {i} that comes AGAIN" for i in range(60)] + ["", " ", "ÄÖ", "äö", " ", "x\ry", "ﬀ\x0b"]
    out = []
    for i in range(n):
        own = [f"own {i} {j}" for j in range(pick.randrange(3))]
        again = [pick.choice(["", " ", "\t"]) + pick.choice([str.upper, str])(pick.choice(common)) + pick.choice(["", "\r", "\x0c "])
                 for _ in range(pick.randrange(8))]
        lines = own + again + again[:1]
        pick.shuffle(lines)
        out.append((i, "\n".join(lines)))
    return out + [(None, "own\nLine 3 that comes again"), (5, None), (6, ""), (7, "\n\n"), (8, "Line 1 that comes again")]


def test_equals_plain_python(spark):
    texts = lined()
    docs = frame(spark, texts)
    for least, shard in ((10, 1 << 17), (20, 7), (1, 50), (100_000, 10)):
        index = line_index(docs, least, shard)
        assert rows(drop_lines(docs, index, least)) == brute(texts, least)
    assert line_index(docs, 10, 7).shards > 5


def test_a_lower_index_serves_higher_limits(spark):
    texts = lined()
    docs = frame(spark, texts)
    index = line_index(docs, 2)
    for least in (2, 15, 40):
        assert rows(drop_lines(docs, index, least)) == brute(texts, least)


def test_awkward_and_empty_tables(spark):
    for least in (1, 2):
        docs = awkward(spark)
        assert rows(drop_lines(docs, line_index(docs, least), least)) == brute(awkward_texts(), least)
    empty = awkward(spark, empty=True)
    assert rows(drop_lines(empty, line_index(empty))) == []


def test_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = sorted(
        ((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(texts, 10)), key=repr)
    assert rows(queries.QUERIES["op13_line_dedup"](spark, sf)) == expected


def test_shards_are_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 5000, 100_000):
        h = rng.integers(0, 2 ** 63, (n, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        n_docs = rng.integers(1, 1000, n)
        made = build_shard(h, n_docs)
        shard = Shard(np.frombuffer(made["sizes"], "<i8"), made["bits"], *(
            np.frombuffer(made[k], t) for k, t in (("places", "<u8"), ("prints", "<u8"), ("documents", "<u4"))))
        assert (shard.counts(h) == n_docs).all()
        assert len(shard.prints) == n and shard.words.nbytes * 8 < 5 * n + 2000
        other = rng.integers(0, 2 ** 63, (20_000, 2), dtype=np.uint64) * np.uint64(2)
        assert not shard.counts(other).any()
