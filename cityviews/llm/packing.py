"""Best-fit packing by patterns: non-negative least squares on the histogram of lengths.

1. Every text becomes ids and an end id; only longer ones are cut, into pieces of the full length.
2. The histogram of piece lengths, a few thousand numbers, is all that the plan needs.
3. Lengths are grouped into steps. Patterns are all ways to fill a sequence with at most three
   steps. Repeat counts are fitted to the histogram by non-negative least squares and rounded down.
4. Each pattern is filled with exact lengths: the longest of each step, and for the last one the
   length that fills the sequence best. What is left over is packed best-fit, longest first, into the gaps of the patterns and into new sequences.
5. The plan is a list of runs: pieces of a length, by rank, go to consecutive sequences at one
   offset. Its size depends on the number of lengths and patterns, not on the number of pieces, so
   it is safe to send everywhere; Spark ranks the pieces and each finds its run.

Null or empty text is a document of the end id alone. Repeated rows are packed each on its own.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityviews.llm.bpe import tokenizer
from cityviews.llm.common import before, buckets_for, by_bytes, lean, saved

STEPS = 256       # steps that lengths are grouped into for the patterns
EACH = 50_000     # pieces that one task ranks at a time


def pack(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1) -> DataFrame:
    """A row per piece of ``docs(doc_id, text)``: where it starts, and its sequence and offset."""
    pieces = saved(_pieces(docs, tokenizer_path, length, end_id), "pieces")
    counts = np.zeros(length + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``length`` rows
        counts[row["length"]] = row["count"]
    runs = pieces.sparkSession.sparkContext.broadcast(plan(counts))

    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                  F.lit(buckets_for(int(counts.sum()), EACH)))
    ranked = before(pieces.withColumn("_part", part), ["length"], "_part",
                    [F.col("doc_id"), F.col("piece")], F.lit(1), "_rank")

    def place(batches):
        keys, first, sequence, offset = runs.value
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, (size << 44) + rank, "right") - 1
            columns = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], PACKED)

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, " \
            "sequence_id bigint, offset bigint"
    return ranked.drop("_part").mapInArrow(place, kinds)


PACKED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def _pieces(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    end = np.array([end_id], dtype=np.uint32)

    def cut(batches):
        encoder = tokenizer(path)
        for batch in by_bytes(batches, "text"):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids = np.concatenate((ids, end)).astype("<u4")
                for i, start in enumerate(range(0, len(ids), length)):
                    part = ids[start:start + length]
                    rows.append((doc, i, start, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), KINDS)] if rows
                else [pa.array([], t) for t in KINDS], PACKED[:5])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")
                       ).mapInArrow(lean(cut), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())


def plan(counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(keys, first rank, sequence, offset) of runs, in order of ``length << 44 | first rank``.

    ``counts[n]`` is the number of pieces of ``n`` ids; the last entry is the full length.
    """
    full = len(counts) - 1
    left = counts.tolist()        # pieces of each length that wait for a place
    given = [0] * (full + 1)      # pieces of each length that have their place
    runs: list[tuple[int, int, int, int]] = []
    sequences = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # space left: (how many sequences, the first)
    spaces: list[int] = []                       # the keys of ``gaps``, in order

    def put(size: int, n: int, sequence: int, offset: int) -> None:
        runs.append((size, given[size], sequence, offset))
        given[size] += n
        left[size] -= n

    def leave(space: int, n: int, sequence: int) -> None:
        if space and n:
            if space not in gaps:
                gaps[space] = []
                bisect.insort(spaces, space)
            gaps[space].append((n, sequence))

    def fill(size: int, n: int, space: int, bins: int, sequence: int) -> int:
        """Put up to ``n`` pieces into ``bins`` sequences with ``space``; returns how many went."""
        each = space // size
        whole = min(bins, n // each)
        for i in range(each if whole else 0):
            put(size, whole, sequence, full - space + i * size)
        leave(space - each * size, whole, sequence)
        went, sequence, bins = whole * each, sequence + whole, bins - whole
        if bins and (rest := min(each, n - went)):
            for i in range(rest):
                put(size, 1, sequence, full - space + i * size)
            leave(space - rest * size, 1, sequence)
            went, sequence, bins = went + rest, sequence + 1, bins - 1
        leave(space, bins, sequence)
        return went

    step = -(-full // STEPS)
    for steps, repeats in _fitted(counts):
        while repeats and (sizes := _filling(left, step, steps)):
            n = min(repeats, *(left[size] // sizes.count(size) for size in sizes))
            offset = 0
            for size in sizes:
                put(size, n, sequences, offset)
                offset += size
            leave(full - offset, n, sequences)
            sequences += n
            repeats -= n
    for size in range(full, 0, -1):
        while left[size]:
            i = bisect.bisect_left(spaces, size)
            if i == len(spaces):
                bins = -(-left[size] // (full // size))
                fill(size, left[size], full, bins, sequences)
                sequences += bins
                continue
            space = spaces[i]
            bins, sequence = gaps[space].pop()
            if not gaps[space]:
                del gaps[space], spaces[i]
            fill(size, left[size], space, bins, sequence)
    runs.sort()
    size, first, sequence, offset = np.array(runs, dtype=np.int64).reshape(-1, 4).T
    return (size << 44) + first, first, sequence, offset


def _filling(left: list[int], step: int, steps: tuple[int, ...]) -> list[int] | None:
    """Sizes for one sequence by a pattern: the longest of each step, but the last fills it best."""
    space, sizes = len(left) - 1, []

    def longest(most: int, least: int) -> int:
        for size in range(most, least, -1):
            if left[size] > sizes.count(size):
                return size
        return 0

    for k in steps[:-1]:
        sizes.append(longest(min(step * k, space), step * (k - 1)))
        if not sizes[-1]:
            return None
        space -= sizes[-1]
    sizes.append(longest(space, step * (steps[-1] - 1)))
    return sizes if sizes[-1] else None


def _fitted(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of steps with their repeat counts, rounded down to what there is."""
    full = len(counts) - 1
    step = -(-full // STEPS)
    top = -(-full // step)
    have = np.zeros(top + 1, dtype=np.int64)
    np.add.at(have, -(-np.arange(1, full + 1) // step), counts[1:])
    total = have.sum()
    if not total:
        return []
    patterns = [(top,)] if have[top] else []
    for a in np.flatnonzero(have).tolist():
        if a < top and 2 * a >= top and have[top - a]:
            patterns.append((a, top - a))
        for b in range(1, a + 1):
            c = top - a - b
            if 1 <= c <= b and have[b] and have[c]:
                patterns.append((a, b, c))
    if not patterns:
        return []
    matrix = np.zeros((top + 1, len(patterns)))
    for j, p in enumerate(patterns):
        for k in p:
            matrix[k, j] += 1
    repeats = np.floor(nnls(matrix, have / total) * total + 1e-6).astype(np.int64)
    out = []
    for j in np.argsort(-repeats, kind="stable").tolist():
        p = patterns[j]
        n = min(int(repeats[j]), *(int(have[k]) // p.count(k) for k in p))
        if n:
            for k in p:
                have[k] -= n
            out.append((p, n))
    return out


def nnls(matrix: np.ndarray, target: np.ndarray, tolerance: float = 1e-10) -> np.ndarray:
    """Non-negative least squares by active sets, on the normal equations."""
    x = np.zeros(matrix.shape[1])
    active: list[int] = []

    def solve() -> np.ndarray:
        part = matrix[:, active]
        return np.linalg.solve(part.T @ part + 1e-12 * np.eye(len(active)), part.T @ target)

    for _ in range(3 * matrix.shape[0]):
        slope = matrix.T @ (target - matrix @ x)
        slope[active] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= tolerance:
            break
        active.append(j)
        s = solve()
        while s.min() <= 0:
            now = x[active]
            low = s <= 0
            share = np.min(now[low] / np.maximum(now[low] - s[low], 1e-300))
            now += share * (s - now)
            gone = low & (now <= 1e-14)
            gone = gone if gone.any() else low
            x[active] = np.where(gone, 0, now)
            active = [k for k, out in zip(active, gone.tolist()) if not out]
            if not active:
                return x
            s = solve()
        x[:] = 0
        x[active] = s
    return x
