"""Hard negatives from Parquet blocks in Hilbert order, chosen by zone maps.

1. Every component becomes a floored multiple. Rows are sorted by number of components, label, place
   on a Hilbert curve, and id, a range of rows per task. Places come from two bits per component,
   cut at the mean and one deviation beside it; they only decide which rows lie together.
2. A task writes its rows as one Parquet file, a row group per block of ``BLOCK`` rows of one label.
   Zone maps hold the least and greatest value of every component: one per block in a file beside it,
   and one per file in a table that Spark commits last; files it doesn't name don't count.
3. Anchors, in the same order, are searched ``GROUP`` at a time. For block limits lo and hi, an anchor's
   score lies between ``a⁺·lo + a⁻·hi`` and ``a⁺·hi + a⁻·lo`` (its positive and negative components). First the
   blocks of the anchor's label are read, from the highest bound down, while one may still reach the
   worst of the positives. Each positive opens a window of scores, and blocks of other labels are read
   while their interval meets a window above the worst negative found there. Files whose interval
   meets nothing are skipped with all their blocks.

A task holds the zone maps of a file and some blocks at a time, however many rows there are.

Rows with a null id, label, vector or component, a non-finite one, or an empty vector take no part.
Vectors of another length are not compared. Rows that repeat id, label and vector count once; rows
of one id with different vectors or labels are rows of their own, but never each other's results.
Ties go to the smaller id. An anchor without positives, or a window without rows, returns nothing.
Scores are exact up to 53 bits; larger ones are rounded to doubles, and cut off at the limits of 64 bits.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import buckets_for, place, saved
from cityviews.llm.scores import Best, floored, inner_products, loose
from cityviews.sinks.workdir import work_folder

BLOCK = 512      # rows of a block, at most
FILE = 16_384    # rows of a file, about
GROUP = 128      # anchors that search together
BITS = 2         # of a component on the Hilbert curve
LENGTHS = 16     # lengths of vectors, the commonest, that get a curve; others are sorted by id

ZONES = "file string, dim int, least_label int, most_label int, n bigint, lo binary, hi binary"
FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, " \
        "negative_score bigint"
ORDER = ("dim", "label", "curve", "vec_id", "vec")


def mine(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
    low: int = 50, high: int = 95, scale: float = 256.0,
) -> DataFrame:
    """Negatives of ``vectors(vec_id, embedding, label)`` for the rows whose id ``every`` divides.

    For each of an anchor's first ``positives`` rows of its label: the first ``negatives`` rows of other
    labels whose score is from ``low`` to ``high`` hundredths of the positive's.
    """
    rows = saved(vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id is not null and label is not null and size(embedding) > 0").mapInArrow(
        floored(scale), "vec_id bigint, label int, dim int, vec binary"), "vectors")
    curved = rows.mapInArrow(_curved(_spread(rows)), "vec_id bigint, label int, dim int, vec binary, curve binary")
    zones = write_blocks(curved, work_folder(vectors.sparkSession, "blocks"), rows.count())

    anchors = curved.where(F.col("vec_id") % every == 0)
    groups = buckets_for(rows.where(F.col("vec_id") % every == 0).count(), GROUP)
    anchors = saved(anchors.repartitionByRange(groups, *ORDER).sortWithinPartitions(*ORDER), "anchors")
    return anchors.mapInArrow(_searched(zones, positives, negatives, low, high), FOUND)


# --- the curve ---

def _spread(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of each component, for the commonest lengths of vectors."""

    def sums(batches):
        for batch in batches:
            dims, vecs = batch.column("dim").to_numpy(), batch.column("vec")
            for dim in np.unique(dims).tolist():
                x = _matrix(vecs.filter(pa.array(dims == dim)), dim)
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([dim], pa.int32()), "n": pa.array([len(x)], pa.int64()),
                    "total": pa.array([x.sum(0).tobytes()]), "squares": pa.array([(x * x).sum(0).tobytes()])})

    def added(key, parts):
        total, squares = (np.sum([np.frombuffer(v) for v in parts.column(k).to_pylist()], axis=0)
                          for k in ("total", "squares"))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()),
                         "n": pa.array([sum(parts.column("n").to_pylist())], pa.int64()),
                         "total": pa.array([total.tobytes()]), "squares": pa.array([squares.tobytes()])})

    kinds = "dim int, n bigint, total binary, squares binary"
    found = rows.mapInArrow(sums, kinds).groupBy("dim").applyInArrow(added, kinds)
    out = {}
    for r in found.orderBy(F.desc("n"), "dim").limit(LENGTHS).collect():
        mean = np.frombuffer(r["total"]) / r["n"]
        with np.errstate(all="ignore"):
            out[r["dim"]] = mean, np.sqrt(np.maximum(np.frombuffer(r["squares"]) / r["n"] - mean * mean, 0))
    return out


def _curved(spread):
    def make(batches):
        for batch in batches:
            dims, vecs = batch.column("dim").to_numpy(), batch.column("vec")
            curve = [b""] * len(dims)
            for dim in np.unique(dims).tolist():
                if dim in spread:
                    at = np.flatnonzero(dims == dim)
                    x = _matrix(vecs.take(pa.array(at)), dim)
                    mean, deviation = spread[dim]
                    cell = (x >= mean - deviation).astype(np.uint8) + (x >= mean) + (x >= mean + deviation)
                    for i, key in zip(at.tolist(), hilbert(cell, BITS)):
                        curve[i] = key
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(curve, pa.binary())], [*batch.schema.names, "curve"])

    return make


def hilbert(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve, as bytes in order, of points with ``bits`` bits a component.

    Every level of bits turns or mirrors the levels below it, so that neighbours on the curve differ by
    one step in one component; a Gray code over all bits of a level gives its place.
    """
    x = cells.astype(np.uint8).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for i in range(n):
            mirrored = (x[:, i] & bit) != 0
            swap = np.where(mirrored, 0, (x[:, 0] ^ x[:, i]) & below).astype(np.uint8)
            x[mirrored, 0] ^= below
            x[:, 0] ^= swap
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), dtype=np.uint8)
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[:, n - 1] & (1 << level), turn ^ ((1 << level) - 1), turn).astype(np.uint8)
    x ^= turn[:, None]
    planes = np.concatenate([(x >> level) & 1 for level in range(bits - 1, -1, -1)], axis=1)
    return [row.tobytes() for row in np.packbits(planes, axis=1)]


def _matrix(vecs: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs.to_pylist()), dtype="<f8").reshape(-1, dim)


# --- blocks and zone maps ---

def write_blocks(rows: DataFrame, folder: str, count: int, file: int = FILE, block: int = BLOCK) -> str:
    """Write ``rows`` as blocks below ``folder``; returns the folder of the files' zone maps."""

    def written(batches):
        made, out = None, []
        for dim, label, ids, x in _blocks(batches, block):
            if made is None or made.dim != dim:
                if made is not None:
                    out.append(made.close())
                made = _BlockFile(folder, dim)
            made.add(label, ids, x)
        if made is not None:
            out.append(made.close())
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("file", pa.string()), ("dim", pa.int32()), ("least_label", pa.int32()), ("most_label", pa.int32()),
            ("n", pa.int64()), ("lo", pa.binary()), ("hi", pa.binary())]))

    rows.repartitionByRange(buckets_for(count, file), *ORDER).sortWithinPartitions(*ORDER).mapInArrow(
        written, ZONES).write.parquet(f"{folder}/zones")
    return folder


def _blocks(batches, most: int):
    """(dim, label, ids, vectors) of up to ``most`` sorted rows of one label; repeated rows once."""
    last, held, key = None, [], None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("dim", "label", "vec_id", "vec"))):
            if row == last:
                continue
            if held and (row[:2] != key or len(held) == most):
                yield *key, np.array([r[2] for r in held]), np.frombuffer(b"".join(r[3] for r in held)).reshape(len(held), -1)
                held = []
            last, key = row, row[:2]
            held.append(row)
    if held:
        yield *key, np.array([r[2] for r in held]), np.frombuffer(b"".join(r[3] for r in held)).reshape(len(held), -1)


class _BlockFile:
    """Blocks of vectors of one length, and their zone maps, under temporary names until closed."""

    def __init__(self, folder: str, dim: int):
        self.system, self.folder = place(folder)
        self.dim, self.name, self.zones = dim, f"{uuid.uuid4().hex}.parquet", []
        self.system.create_dir(f"{self.folder}/files", recursive=True)
        self.kind = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary(8 * dim))])
        self.out = pq.ParquetWriter(self._temporary(self.name), self.kind, filesystem=self.system, use_dictionary=False)

    def _temporary(self, name: str) -> str:
        return f"{self.folder}/files/_{name}"

    def add(self, label: int, ids: np.ndarray, x: np.ndarray) -> None:
        vecs = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(8 * self.dim), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))])
        self.out.write_table(pa.table([pa.array(ids), vecs], schema=self.kind), row_group_size=len(ids))
        self.zones.append((label, len(ids), x.min(0), x.max(0)))

    def close(self) -> dict:
        self.out.close()
        lo, hi = (np.array([z[i] for z in self.zones]) for i in (2, 3))
        pq.write_table(pa.table({
            "label": pa.array([z[0] for z in self.zones], pa.int32()),
            "lo": [x.tobytes() for x in lo], "hi": [x.tobytes() for x in hi]}),
            self._temporary(f"{self.name}.zones"), filesystem=self.system)
        for name in (f"{self.name}.zones", self.name):
            self.system.move(self._temporary(name), f"{self.folder}/files/{name}")
        return {"file": self.name, "dim": self.dim, "least_label": min(z[0] for z in self.zones),
                "most_label": max(z[0] for z in self.zones), "n": sum(z[1] for z in self.zones),
                "lo": lo.min(0).tobytes(), "hi": hi.max(0).tobytes()}


class Blocks:
    """Files of blocks, read as far as zone maps ask for it."""

    def __init__(self, folder: str, dim: int):
        self.system, self.folder = place(folder)
        self.dim, self.read = dim, 0
        rows = pq.read_table(f"{self.folder}/zones", filesystem=self.system, filters=[("dim", "==", dim)])
        self.files = rows.column("file").to_pylist()
        self.least, self.most = (rows.column(k).to_numpy() for k in ("least_label", "most_label"))
        self.lo, self.hi = (_matrix(rows.column(k), dim) for k in ("lo", "hi"))

    def zones(self, file: int):
        """(labels, lo, hi) of a file's blocks."""
        rows = pq.read_table(f"{self.folder}/files/{self.files[file]}.zones", filesystem=self.system)
        return rows.column("label").to_numpy(), *(_matrix(rows.column(k), self.dim) for k in ("lo", "hi"))

    def open(self, file: int) -> pq.ParquetFile:
        return pq.ParquetFile(f"{self.folder}/files/{self.files[file]}", filesystem=self.system)

    def block(self, file: pq.ParquetFile, number: int):
        rows = file.read_row_group(number)
        self.read += 1
        return rows.column("vec_id").to_numpy(), _matrix(rows.column("vec"), self.dim)


def limits(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each of ``x`` with any point between lo and hi."""
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    return -loose(-(up @ lo.T + down @ hi.T)), loose(up @ hi.T + down @ lo.T)


# --- the search ---

def _searched(folder: str, positives: int, negatives: int, low: int, high: int):
    def search(batches):
        blocks = None
        for dim, label, ids, x in _blocks(batches, GROUP):
            if blocks is None or blocks.dim != dim:
                blocks = Blocks(folder, dim)
            yield search_group(blocks, label, ids, x, positives, negatives, low, high)

    return search


def search_group(blocks: Blocks, label: int, ids, x, positives=5, negatives=3, low=50, high=95) -> pa.RecordBatch:
    """The negatives of anchors ``ids`` with vectors ``x``, all of one label."""
    near = Best(ids, np.full(len(ids), -np.inf), positives)
    one = np.arange(len(ids))
    _visit(blocks, x, one, near, (blocks.least <= label) & (blocks.most >= label), lambda labels: labels == label)
    at, positive, reach = near.rows()
    first, last = np.ceil(reach * low / 100), np.floor(reach * high / 100)
    wide = np.abs(reach) >= 2 ** 45  # beyond that, quotients of doubles may be off by one
    for i in np.flatnonzero(wide).tolist():
        first[i], last[i] = -(-int(reach[i]) * low // 100), int(reach[i]) * high // 100
    open_ = first <= last
    at, positive, reach, first, last = (v[open_] for v in (at, positive, reach, first, last))
    far = Best(ids[at], first, negatives, last)
    _visit(blocks, x, at, far, (blocks.least != label) | (blocks.most != label), lambda labels: labels != label)
    row, negative, score = far.rows()
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in (
            (ids[at][row], pa.int64()), (positive[row], pa.int64()), (rank.astype(np.int32), pa.int32()),
            (negative, pa.int64()), (reach[row].astype(np.int64), pa.int64()), (score.astype(np.int64), pa.int64()))],
        ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def _visit(blocks: Blocks, x: np.ndarray, of: np.ndarray, best: Best, files: np.ndarray, wanted) -> None:
    """Offer to ``best`` all rows that can be among its results, highest bounds first.

    ``of`` is the vector in ``x`` of each row of ``best``. ``files`` may hold labels that ``wanted`` accepts.
    """
    if not len(of):
        return

    def order(lo, hi, allowed):
        """Zones from the greatest bound down: (number, the rows of ``best`` that it can serve)."""
        least, most = limits(x, lo, hi)
        least, most = least[of], most[of]
        if best.ceiling is not None:
            most = np.where(least > best.ceiling[:, None], -np.inf, np.minimum(most, best.ceiling[:, None]))
        most[:, ~allowed] = -np.inf
        for k in np.argsort(-most.max(axis=0), kind="stable").tolist():
            able = np.flatnonzero((most[:, k] >= best.worst) & (most[:, k] > -np.inf))
            if len(able):
                yield k, able

    for f, _ in order(blocks.lo, blocks.hi, files):
        labels, lo, hi = blocks.zones(f)
        opened = None
        for b, able in order(lo, hi, wanted(labels)):
            opened = opened or blocks.open(f)
            ids, y = blocks.block(opened, b)
            need, back = np.unique(of[able], return_inverse=True)
            best.offer(able, ids, inner_products(x[need], y)[back])
        if opened is not None:
            opened.close()
