import random

import pytest
from helpers import awkward, components, rows, shingle_set, words_of

from cityviews.llm import ngram_join
from cityviews.llm.ngram_join import jaccard_components


def brute(docs, k, per_cent):
    """Rows without id take no part; others are in order of their id."""
    known = sorted((d for d in docs if d[0] is not None), key=lambda d: d[0])
    sets = [shingle_set(t, k) for _, t in known]
    out = [(d[0], len(s), known[c][0]) for d, s, c in zip(known, sets, components(sets, per_cent))]
    out += [(None, len(shingle_set(t, k)), None) for i, t in docs if i is None]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, per_cent", [(3, 90), (5, 80)])
def test_awkward_rows(spark, k, per_cent):
    docs = awkward(spark)
    assert rows(jaccard_components(docs, k, per_cent)) == brute(
        [(r.doc_id, r.text) for r in docs.collect()], k, per_cent)


def test_empty_table(spark):
    assert jaccard_components(awkward(spark, empty=True)).count() == 0


def test_crowds_in_small_blocks(spark, monkeypatch):
    """Near copies around the limit, in lists that are cut into blocks, and oversized groups."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "GROUP", 2)
    chance = random.Random(5)
    base = words_of(9, 120)
    docs = []
    for i in range(150):
        w = base[:]
        for _ in range(chance.randrange(5)):
            w[chance.randrange(len(w))] = f"new{chance.randrange(40)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(jaccard_components(df, 3, 90)) == brute(docs, 3, 90)


def test_groups_of_equal_prefixes(spark, monkeypatch):
    """With every shingle counted as frequent, prefixes follow frequency, and groups fill."""
    import numpy as np

    monkeypatch.setattr(ngram_join, "_frequent", lambda counts: np.maximum(counts, 1).astype(np.uint32))
    base = words_of(4, 400)
    docs = [(i, " ".join(base[:200 + i // 4] + [f"t{i % 4}"])) for i in range(24)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard_components(df, 3, 90)) == brute(docs, 3, 90)
