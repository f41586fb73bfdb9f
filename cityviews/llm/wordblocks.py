"""Words and word shingles of Arrow text columns, hashed a block of bytes at a time.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D), after A-Z are
lower-cased. Its hash is a polynomial with random 64-bit coefficients per byte value, then
mixed; two different words share a hash with a chance of about 2**-56.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPAN = 1 << 20  # bytes hashed at a time

_rng = np.random.default_rng(20240229)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = (_rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[LOWER]
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 & ~7 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = None, None


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = WHITE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, counts): byte spans of all words, and the number of words per text.

    ``gaps`` tells for each byte value whether it parts words.
    """
    inside = ~gaps[data]
    first = np.zeros(len(data), dtype=bool)
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, np.flatnonzero(finishes) + 1, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    global _UP, _DOWN
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SPAN)))
        width = int(ends[j - 1] - base)
        if _UP is None or len(_UP) <= width:
            size = max(SPAN, width) + 1
            _UP, _DOWN = _powers(_BASE, size), _powers(_INVERSE, size)
        sums = np.zeros(width + 1, dtype=np.uint64)
        np.cumsum(_VALUE[data[base:base + width]] * _UP[:width], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[b] - sums[a]) * _DOWN[a] + (b - a).astype(np.uint64))
        i = j
    return out


def shingles(column: pa.Array, k: int):
    """For each text in turn, the hashes of its ``k``-word shingles, in order, repeats kept.

    A text with fewer words gives one shingle of all of them; one without words gives none.
    """
    data, offsets = text_bytes(column)
    done = 0
    while done < len(offsets) - 1:  # texts are taken together up to SPAN bytes
        upto = max(done + 1, int(np.searchsorted(offsets, offsets[done] + SPAN, "right")) - 1)
        part = data[offsets[done]:offsets[upto]]
        starts, ends, counts = word_spans(part, offsets[done:upto + 1] - offsets[done])
        words = word_hashes(part, starts, ends)
        n = max(0, len(words) - k + 1)
        rolled = np.full(n, k, dtype=np.uint64)
        for step in range(k):
            rolled = mix(rolled * np.uint64(_BASE) + words[step:step + n])
        at = 0
        for c in counts.tolist():
            if c >= k:
                yield rolled[at:at + c - k + 1]
            elif c:
                h = np.full(1, c, dtype=np.uint64)
                for w in words[at:at + c]:
                    h = mix(h * np.uint64(_BASE) + w)
                yield h
            else:
                yield words[:0]
            at += c
        done = upto


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    h = np.sort(h)
    if len(h) > 1:
        h = h[np.concatenate(([True], h[1:] != h[:-1]))]
    return h
