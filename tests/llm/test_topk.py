import math

import numpy as np
from helpers import rows

from cityviews.llm import topk
from cityviews.llm.topk import Best, _scores, cover_tree, dual, top_k


def brute(vectors, k, every, scale=256.0):
    ok = []
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for i, v in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))
        out += [(i, n, j, -s) for n, (s, j) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def test_awkward_vectors(spark):
    chance = np.random.default_rng(3)
    data = [(i, chance.normal(0, 1, 6).tolist()) for i in range(120)]
    data += [(i, [0.5] * 6) for i in range(120, 180)]            # one very common vector
    data += [(300, None), (350, []), (400, [1.0, None] * 3), (450, [math.nan] * 6), (500, [math.inf] * 6),
             (None, [9.0] * 6), (550, [1.0, 2.0]), (551, [3.0, 4.0]), (600, [7.0]), (601, [0.5] * 6), (601, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in data],
                               "vec_id long, embedding array<double>, dim string, score string")
    assert rows(top_k(df, 5, 256.0, 50)) == brute(data, 5, 50)


def test_many_parts(spark, monkeypatch):
    for name, value in (("EACH", 40), ("PART", 25), ("QUERIES", 3), ("LEAF", 4)):
        monkeypatch.setattr(topk, name, value)
    chance = np.random.default_rng(4)
    heart = chance.normal(0, 3, (7, 8))
    data = [(i, (heart[i % 7] + chance.normal(0, 0.2, 8)).tolist()) for i in range(400)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    assert rows(top_k(df, 5, 256.0, 10)) == brute(data, 5, 10)


def test_empty_table(spark):
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_trees_cover_and_prune():
    chance = np.random.default_rng(5)
    heart = chance.normal(0, 2000, (30, 5))
    x = np.floor(heart[chance.integers(0, 30, 6000)] + chance.normal(0, 20, (6000, 5)))
    top = cover_tree(x, 64)
    nodes, seen = [top], 0
    for node in nodes:
        nodes += node.children
        assert np.sqrt(((x[node.rows] - node.centre) ** 2).sum(1)).max() <= node.radius
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            assert all(c.radius <= node.radius / 2 for c in node.children)
    counted = topk._scores
    try:
        def count(a, b):
            nonlocal seen
            seen += len(a) * len(b)
            return counted(a, b)

        topk._scores = count
        q = x[:200]
        best = Best(np.arange(200), np.full(200, -np.inf), 5)
        dual(q, x, np.arange(6000), best)
    finally:
        topk._scores = counted
    assert seen < 0.5 * 200 * 6000
    at, vec, score = best.rows()
    whole = q @ x.T
    np.fill_diagonal(whole[:, :200], -np.inf)
    want = [sorted(zip(-whole[i], range(6000)))[:5] for i in range(200)]
    assert [(-s, v) for s, v in zip(score, vec)] == [p for w in want for p in w]


def test_large_components():
    x = np.array([[2.0 ** 40, 1.0]])
    assert _scores(x, x)[0, 0] == 2.0 ** 63 - 1024
    assert _scores(np.array([[2.0 ** 29, 1.0]]), np.array([[2.0 ** 29, 1.0]]))[0, 0] == 2.0 ** 58 + 1


def test_trees_of_even_vectors_have_levels(monkeypatch):
    """The given vectors fill 64 dimensions evenly: no node holds two near ones, so bounds settle little there."""
    import pyarrow.parquet as pq

    x = np.floor(256 * np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist()))
    top, depth = cover_tree(x, topk.LEAF), 0
    level, leaves = [top], []
    while level:
        depth += 1
        leaves += [n for n in level if not n.children]
        level = [c for n in level for c in n.children]
    assert depth >= 3 and max(len(n.rows) for n in leaves) <= topk.LEAF
    assert sorted(np.concatenate([n.rows for n in leaves])) == list(range(len(x)))


def test_two_vectors_of_one_query_id(spark):
    data = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.25, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows(top_k(df, 5, 256.0, 50)) == sorted(
        [(50, 1, 1, 65536), (50, 2, 2, 16384), (50, 1, 2, 65536), (50, 2, 1, 32768)], key=repr)
