"""Inner products of whole-numbered vectors held as doubles, and the best of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def floored(scale: float):
    """A task that turns ``embedding`` into whole multiples: column ``vec`` of doubles, ``dim`` of them.

    Rows with null or non-finite components are left out; other columns stay as they are.
    """

    def make(batches):
        for batch in batches:
            rows, dims, out = [], [], []
            for i, x in enumerate(batch.column("embedding")):
                x = x.values
                if x.null_count:
                    continue
                with np.errstate(over="ignore"):
                    v = np.floor(x.to_numpy() * scale)
                if not np.isfinite(v).all():
                    continue
                rows.append(i)
                dims.append(len(v))
                out.append(v.tobytes())
            kept = batch.drop_columns(["embedding"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                [*kept.schema.names, "dim", "vec"])

    return make


class Best:
    """The best k of each query so far: greater score first, then smaller id.

    A result has another id than the query, and a score from ``floor`` to ``ceiling``.
    """

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int, ceiling: np.ndarray | None = None):
        self.ids, self.k, self.ceiling = ids, k, ceiling
        self.worst = floor.copy()          # a result must reach this
        self.vec = np.zeros((len(ids), k), dtype=np.int64)
        self.score = np.full((len(ids), k), -np.inf)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of vectors ``ids`` for queries ``rows``, no row twice."""
        ok = (scores >= self.worst[rows][:, None]) & (ids[None, :] != self.ids[rows][:, None])
        if self.ceiling is not None:
            ok &= scores <= self.ceiling[rows][:, None]
        i, j = np.nonzero(ok)
        if not len(i):
            return
        hit, at = np.unique(rows[i], return_inverse=True)
        at = np.concatenate((np.repeat(np.arange(len(hit)), self.k), at))
        vec = np.concatenate((self.vec[hit].ravel(), ids[j]))
        score = np.concatenate((self.score[hit].ravel(), scores[i, j]))
        order = np.lexsort((vec, -score, at))
        at = at[order]
        order = order[np.arange(len(at)) - np.searchsorted(at, at) < self.k]
        self.vec[hit], self.score[hit] = vec[order].reshape(-1, self.k), score[order].reshape(-1, self.k)
        self.worst[hit] = np.maximum(self.worst[hit], self.score[hit, -1])

    def rows(self):
        """(row, vector, score) of all results, best first in each row."""
        i, j = np.nonzero(self.score > -np.inf)
        return i, self.vec[i, j], self.score[i, j]


def loose(bound):
    return bound + 1e-9 * np.abs(bound) + 1e-6


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products, exact if they fit into 53 bits; larger ones by whole numbers."""
    if np.abs(x).max() * np.abs(y).max() * x.shape[1] < 2 ** 53:
        return x @ y.T
    whole = [[int(v) for v in row] for row in x], [[int(v) for v in row] for row in y]
    most = 2 ** 63 - 1024  # the greatest double that is a long
    return np.array([[float(max(-most, min(most, sum(a * b for a, b in zip(u, v)))))
                      for v in whole[1]] for u in whole[0]])
