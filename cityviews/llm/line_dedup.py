"""Drops lines that many documents share, by a sharded minimal perfect hash of their hashes.

1. A line's key is the line without ASCII white space at its ends, A-Z lower-cased; its hash is
   128 bits of BLAKE2b. Tasks count each hash once per document, Spark adds the counts up.
2. Hashes found in ``least`` documents or more are dealt to shards by their first half. Each shard
   becomes a minimal perfect hash: levels of bits, a hash being settled on the first level where
   it has a bit to itself; its slot is the number of set bits before that one. Slots index two
   arrays: the second half of the hash (the fingerprint, 64 bits) and the number of documents.
3. Documents are read once more. A task hashes the lines of some texts, loads the shards that these
   fall into (at most ``HELD`` bytes of them stay in memory), and looks up slot, fingerprint
   and count. No line is joined or shuffled, and the texts stay where they are.

A shard has some 131,072 hashes at 13 bytes, whatever the corpus. Rarer lines need no slot: a hash
that is in no shard differs from the fingerprint in its slot, but for one in 2**64.

Every row is a document, repeated rows and those without an id too. A null or empty text is one
empty line. Empty keys are in no index and stay. Lines are parted by a newline alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import buckets_for, by_bytes, place, saved
from cityviews.llm.wordblocks import LOWER, WHITE, mix, text_bytes
from cityviews.sinks.workdir import work_folder

SHARD = 1 << 17   # hashes of a shard, about
HELD = 64 << 20   # bytes of shards that a worker keeps
RUN = 16 << 20    # bytes of texts that look up their lines together
ROOM = 1.5        # bits of a level for each hash that has to be settled there
LEVELS = 24       # after these, hashes are listed


class Lines:
    """Lines of a text column: their spans, and those of their keys."""

    def __init__(self, column: pa.Array):
        self.data, offsets = text_bytes(column)
        n = len(offsets) - 1
        breaks = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(offsets, breaks, "right") - 1
        self.counts = np.bincount(owner, minlength=n) + 1
        self.upto = np.cumsum(self.counts)
        self.owner = np.repeat(np.arange(n), self.counts)
        at = np.arange(len(breaks)) + owner
        self.starts = np.empty(len(self.owner), dtype=np.int64)
        self.ends = np.empty(len(self.owner), dtype=np.int64)
        self.starts[self.upto - self.counts] = offsets[:-1]
        self.starts[at + 1] = breaks + 1
        self.ends[self.upto - 1] = offsets[1:]
        self.ends[at] = breaks
        solid = np.flatnonzero(~WHITE[self.data])
        first = np.searchsorted(solid, self.starts)
        last = np.searchsorted(solid, self.ends) - 1
        self.keyed = np.flatnonzero(first <= last)
        self.key_starts = solid[first[self.keyed]]
        self.key_ends = solid[last[self.keyed]] + 1

    def hashes(self) -> np.ndarray:
        """Two 64-bit numbers for each line with a key, in order."""
        low = LOWER[self.data].tobytes()
        found = b"".join([
            hashlib.blake2b(low[a:b], digest_size=16).digest()
            for a, b in zip(self.key_starts.tolist(), self.key_ends.tolist())])
        return np.frombuffer(found, dtype="<u8").reshape(-1, 2)


def _counted(batches):
    """Hashes of the lines of some texts, each with the number of texts that have it."""
    for batch in by_bytes(batches, "text"):
        lines = Lines(batch.column("text"))
        h, owner = lines.hashes(), lines.owner[lines.keyed]
        order = np.lexsort((owner, h[:, 1], h[:, 0]))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]).any(axis=1)
        once = new.copy()
        once[1:] |= owner[1:] != owner[:-1]
        n = np.bincount(np.cumsum(new)[once] - 1, minlength=int(new.sum()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[new, 0].view(np.int64)), pa.array(h[new, 1].view(np.int64)), pa.array(n)],
            ["place", "print", "documents"])


class Shard:
    """A minimal perfect hash with its two arrays."""

    def __init__(self, sizes, bits, places, prints, documents):
        self.sizes, self.places, self.prints, self.documents = sizes, places, prints, documents
        self.words = np.frombuffer(bits, dtype="<u8")
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(ones, dtype=np.uint32) - ones
        self.bytes = sum(x.nbytes for x in (self.words, self.before, places, prints, documents))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash; any slot, or -1, for one that the shard lacks."""
        out = np.full(len(h), -1, dtype=np.int64)
        open_, start = np.arange(len(h)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _spot(h[open_], level, size) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            word, bit = word[hit], bit[hit]
            under = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = self.before[word] + under
            open_ = open_[~hit]
            start += size
            if not len(open_):
                return out
        if len(self.places):
            found = np.minimum(np.searchsorted(self.places, h[open_]), len(self.places) - 1)
            settled = len(self.prints) - len(self.places)
            out[open_] = np.where(self.places[found] == h[open_], settled + found, -1)
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The number of documents that have each line; 0 where the shard lacks it."""
        if not len(self.prints):
            return np.zeros(len(h), dtype=np.int64)
        slot = self.slots(_code(h))
        same = (slot >= 0) & (self.prints[slot] == h[:, 1])
        return np.where(same, self.documents[slot], 0).astype(np.int64)


def _code(h: np.ndarray) -> np.ndarray:
    return mix(h[:, 0] ^ (h[:, 1] << np.uint64(1)))


def _spot(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h + np.uint64(level * 0x9E3779B97F4A7C15 & 2 ** 64 - 1)) % np.uint64(size)).astype(np.int64)


def build_shard(h: np.ndarray, documents: np.ndarray) -> dict:
    """The columns of a shard of hashes ``h`` (two 64-bit numbers each, all different)."""
    code = _code(h)
    sizes, levels, left = [], [], np.arange(len(h))
    while len(left) and len(sizes) < LEVELS:
        size = -(-int(len(left) * ROOM) // 64) * 64 + 64
        at = _spot(code[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        sizes.append(size)
        left = left[~alone[at]]
    bits = np.packbits(np.concatenate(levels or [np.zeros(64, dtype=bool)]), bitorder="little").tobytes()
    left = left[np.argsort(code[left], kind="stable")]
    if len(np.unique(code[left])) < len(left):
        raise ValueError("two line hashes agree in all their levels")
    shard = Shard(np.array(sizes, dtype=np.int64), bits, np.zeros(0, np.uint64), np.zeros(0, np.uint64),
                  np.zeros(0, np.uint32))
    slot = shard.slots(code)
    slot[left] = len(h) - len(left) + np.arange(len(left))
    prints, counts = np.empty(len(h), dtype="<u8"), np.empty(len(h), dtype="<u4")
    prints[slot] = h[:, 1]
    counts[slot] = np.minimum(documents, 2 ** 32 - 1)
    return {"sizes": shard.sizes.astype("<i8").tobytes(), "bits": bits,
            "places": code[left].astype("<u8").tobytes(), "prints": prints.tobytes(),
            "documents": counts.tobytes()}


PARTS = ("sizes", "bits", "places", "prints", "documents")


class LineIndex:
    """Shards below a folder that all executors reach; workers load those they need."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards
        self._held: dict[int, Shard] = {}

    def counts(self, h: np.ndarray) -> np.ndarray:
        """The number of documents that have each line hash, 0 for those not in the index."""
        out = np.zeros(len(h), dtype=np.int64)
        if not self.shards:
            return out
        shard = (h[:, 0].view(np.int64) % self.shards).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(part):
                out[part] = self._shard(int(shard[part[0]])).counts(h[part])
        return out

    def _shard(self, number: int) -> Shard:
        found = self._held.pop(number, None)
        if found is None:
            system, path = place(f"{self.folder}/shard={number}")
            rows = pq.read_table(path, filesystem=system, columns=list(PARTS), partitioning=None).to_pylist()
            if len(rows) != 1:
                raise ValueError(f"{path} holds {len(rows)} shards")
            row = rows[0]
            found = Shard(np.frombuffer(row["sizes"], "<i8"), row["bits"], *(
                np.frombuffer(row[k], t) for k, t in (("places", "<u8"), ("prints", "<u8"), ("documents", "<u4"))))
            while self._held and found.bytes + sum(s.bytes for s in self._held.values()) > HELD:
                del self._held[next(iter(self._held))]  # the one unused for longest
        self._held[number] = found
        return found


def line_index(docs: DataFrame, least: int = 10, shard: int = SHARD) -> LineIndex:
    """An index of the lines that ``least`` rows of ``docs(text)`` or more have."""
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _counted, "place bigint, print bigint, documents bigint")
    found = saved(found.groupBy("place", "print").agg(F.sum("documents").alias("documents")).where(
        F.col("documents") >= least), "lines")
    shards = found.count()
    shards = buckets_for(shards, shard) if shards else 0
    folder = work_folder(docs.sparkSession, "line-index")
    if not shards:
        return LineIndex(folder, 0)

    def build(key, table):
        h = np.stack([table.column(k).to_numpy().view(np.uint64) for k in ("place", "print")], axis=1)
        made = build_shard(h, table.column("documents").to_numpy())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()),
                         **{k: pa.array([made[k]], pa.binary()) for k in PARTS}})

    found.withColumn("shard", F.pmod("place", F.lit(shards).cast("bigint"))).groupBy("shard").applyInArrow(
        build, "shard bigint, " + ", ".join(f"{k} binary" for k in PARTS)).write.partitionBy("shard").parquet(folder)
    return LineIndex(folder, shards)


def drop_lines(docs: DataFrame, index: LineIndex, least: int = 10) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and the ``kept`` text of each row of ``docs``."""
    folder, shards = index.folder, index.shards

    def probed(batches):
        held = LineIndex(folder, shards)
        for run in by_bytes(batches, "text", RUN):
            parts = [(part, lines := Lines(part.column("text")), lines.hashes())
                     for part in by_bytes([run], "text")]
            n = held.counts(np.concatenate([h for _, _, h in parts]))
            for part, lines, h in parts:
                common, n = n[:len(h)] >= least, n[len(h):]
                yield _kept(part, lines, lines.keyed[common])

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(probed, "doc_id bigint, n_lines bigint, n_dropped bigint, kept string")


def _kept(batch, lines: Lines, dropped: np.ndarray) -> pa.RecordBatch:
    gone = np.zeros(len(lines.owner), dtype=bool)
    gone[dropped] = True
    n = np.bincount(lines.owner[dropped], minlength=batch.num_rows)
    texts = batch.column("text").fill_null("")
    if n.any():
        raw, texts = lines.data.tobytes(), texts.to_pylist()
        for i in np.flatnonzero(n).tolist():
            stay = np.flatnonzero(~gone[lines.upto[i] - lines.counts[i]:lines.upto[i]]) + lines.upto[i] - lines.counts[i]
            texts[i] = b"\n".join(
                [raw[a:b] for a, b in zip(lines.starts[stay].tolist(), lines.ends[stay].tolist())]).decode()
        texts = pa.array(texts, pa.string())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(lines.counts.astype(np.int64)), pa.array(n.astype(np.int64)), texts],
        ["doc_id", "n_lines", "n_dropped", "kept"])
