import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import awkward
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cityviews.llm import packing
from cityviews.llm.bpe import tokenizer
from cityviews.llm.packing import nnls, pack, plan

PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences_of(counts):
    """Expand a plan; every piece must have one place, and sequences no gaps or overlaps."""
    keys, first, sequence, offset = plan(counts)
    full, found = len(counts) - 1, defaultdict(list)
    for size in np.flatnonzero(counts):
        for rank in range(counts[size]):
            at = np.searchsorted(keys, (int(size) << 44) + rank, "right") - 1
            assert keys[at] >> 44 == size
            found[int(sequence[at] + rank - first[at])].append((int(offset[at]), int(size)))
    for places in found.values():
        end = 0
        for offset_, size in sorted(places):
            assert offset_ == end
            end += size
        assert end <= full
    return found


@pytest.mark.parametrize("kind", ["lognormal", "uniform", "small", "full", "half", "one", "none"])
def test_plans_are_close_to_the_bound(kind):
    chance = np.random.default_rng(1)
    sizes = {
        "lognormal": np.clip(np.exp(chance.normal(6.5, 1, 20_000)).astype(int) + 2, 1, 4096),
        "uniform": chance.integers(1, 4097, 20_000), "small": chance.integers(1, 50, 20_000),
        "full": np.full(100, 4096), "half": np.full(101, 2048), "one": np.array([1]), "none": np.array([], dtype=int),
    }[kind]
    counts = np.bincount(sizes, minlength=4097)
    assert len(sequences_of(counts)) <= 1.01 * -(-sizes.sum() // 4096)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200))
def test_any_histogram(sizes):
    sequences_of(np.bincount(np.array(sizes, dtype=int), minlength=41))


def test_nnls():
    chance = np.random.default_rng(2)
    a, b = chance.random((20, 60)), chance.random(20)
    x = nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert x.min() >= 0 and slope.max() < 1e-8 and abs(slope[x > 0]).max() < 1e-6


def test_ids_equal_the_library():
    chance = random.Random(3)
    odd = ["", " ", "it's DON'T 'tis '’s", "Ünïcödé ÀÉ İstanbul ΣΑΣ", "日本語 12345 ١٢٣", "<|endoftext|> x<|startoftext|>y",
           "é ́x", "x" * 300, "foo--bar,,'s baz's 's.", "\x00\x1c a\x85b c", "½ ² ª µ º ×÷ «q»", "A.B_c~{}|é", "🎈🎉"]
    letters = "abcdeéßöÀÑ ABC012.,;'-_|\t\n日ñ"
    texts = odd + ["".join(chance.choice(letters) for _ in range(chance.randrange(200))) for _ in range(500)]
    library = Tokenizer.from_file(PATH)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokenizer(PATH).encode(pa.array(texts))] == want


@pytest.mark.parametrize("length", [4096, 64])
def test_awkward_rows(spark, monkeypatch, length):
    monkeypatch.setattr(packing, "EACH", 5)
    docs = awkward(spark)
    library = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for i, start in enumerate(range(0, len(ids), length)):
            part = ids[start:start + length]
            want.append((r.doc_id, i, start, len(part), zlib.crc32(part.tobytes())))
    got = pack(docs, PATH, length).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        assert [o for o, _ in sorted(p)] == [sum(n for q, n in p if q < o) for o, _ in sorted(p)]
        assert sum(n for _, n in p) <= length
    total = sum(w[3] for w in want)
    assert len(places) <= -(-total // length) + 1


def test_empty_table(spark):
    assert pack(awkward(spark, empty=True), PATH).count() == 0
