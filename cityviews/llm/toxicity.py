"""Toxicity scores: FTRL-proximal logistic regression on hashed word n-grams and skip-grams.

Features of a text: its words, their four-byte stems, pairs of neighbours, and pairs with one or
two words between, each present or not, hashed to 2**22 places. Every coordinate has its own
learning rate; L1 keeps the weights of few (places that a single text has get none). Those few are
sent to all executors.

The model is fitted on a sample of at most ``SAMPLE`` labelled rows, those with the least hash of
their id, as far as their features fit into ``SAMPLE_BYTES``, in one task. The bias is then set
so that ``THRESHOLD`` falls where the labels part best, by models fitted on the other folds of the same rows.
Scoring reads every whole text; its rows are independent of each other.
A null or empty text has no features and gets the score of the bias alone. Labels other than 0
and 1 are ignored; an id with both counts as toxic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import by_bytes, lean, saved
from cityviews.llm.wordblocks import SPAN, WHITE, mix, text_bytes, word_hashes, word_spans

SAMPLE = 16_384   # labelled rows that the model is fitted on, at most
SAMPLE_BYTES = 160 << 20  # of their features, four bytes each, at most
PLACES = 1 << 22  # hashed features
STEM = 4          # bytes of a word that its stem keeps
GAPS = (1, 2, 3)  # distances of the two words of a pair
THRESHOLD = 0.7
FOLDS = 3         # of the labelled rows, to set the bias
STRICT = 10       # a share of clean rows called toxic weighs so many times that of toxic ones missed

#: Bytes between words: white space and ASCII punctuation.
BREAKS = WHITE.copy()
for _b in range(33, 127):
    BREAKS[_b] = not chr(_b).isalnum()


def _hashed(column: pa.Array):
    """(features of all words in a block of texts, text that each belongs to, number of texts)."""
    data, offsets = text_bytes(column)
    done = 0
    while done < len(offsets) - 1:
        upto = max(done + 1, int(np.searchsorted(offsets, offsets[done] + SPAN, "right")) - 1)
        part = data[offsets[done]:offsets[upto]]
        starts, ends, counts = word_spans(part, offsets[done:upto + 1] - offsets[done], BREAKS)
        words = word_hashes(part, starts, ends)
        stems = mix(word_hashes(part, starts, np.minimum(ends, starts + STEM)) + np.uint64(9))
        owner = np.repeat(np.arange(upto - done), counts)
        found, whose = [words, stems], [owner, owner]
        for gap in GAPS:
            same = owner[gap:] == owner[:-gap]
            pair = mix(words[:-gap][same] * np.uint64(2 * gap + 1) + words[gap:][same])
            found.append(pair)
            whose.append(owner[gap:][same])
        yield (np.concatenate(found) & np.uint64(PLACES - 1)).astype(np.int64), \
            np.concatenate(whose), upto - done
        done = upto


class Ftrl:
    """Weights that follow the regularised leader; a document is a set of places, and the bias."""

    def __init__(self, places: int, alpha=1.0, beta=1.0, l1=8.0, l2=0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(places + 1)  # the last place is the bias
        self.n = np.zeros(places + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, PLACES)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def unseen(rows: list, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of weights, labels) of ``rows``, each by a model that learnt from the other folds."""
    sums, labels = np.zeros(len(rows)), np.array([y for _, y in rows])
    for fold in range(FOLDS):
        model = Ftrl(PLACES)
        for _ in range(rounds):
            for i, (x, y) in enumerate(rows):
                if i % FOLDS != fold:
                    model.learn(x, y)
        for i in range(fold, len(rows), FOLDS):
            sums[i] = model.weights(np.append(rows[i][0], PLACES)).sum()
    return sums, labels


def boundary(sums: np.ndarray, labels: np.ndarray) -> float:
    """The sum that parts the labels best: toxic rows found, less ``STRICT`` times the share of others.

    Of equally good ones, the middle of the last stretch. Without both labels, the one that means ``THRESHOLD``.
    """
    toxic, clean = np.sort(sums[labels == 1]), np.sort(sums[labels == 0])
    if not len(toxic) or not len(clean):
        return logit(THRESHOLD)
    cuts = np.unique(sums)
    gain = (len(toxic) - np.searchsorted(toxic, cuts)) / len(toxic) - STRICT * (
        len(clean) - np.searchsorted(clean, cuts)) / len(clean)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)[-1]
    return float(cuts[best] if best == 0 else (cuts[best] + cuts[best - 1]) / 2)


def logit(share: float) -> float:
    return float(np.log(share / (1 - share)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = 5) -> tuple:
    """(places, weights) learnt from ``labels(doc_id, toxic)`` on ``docs(doc_id, text)``."""
    picked = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` rows of two numbers
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")).join(
        F.broadcast(saved(picked, "sample")), "doc_id")

    def featured(batches):
        for batch in by_bytes(batches, "text"):
            out = []
            for places, whose, n in _hashed(batch.column("text")):
                cut = np.searchsorted(whose := whose[order := np.argsort(whose, kind="stable")], np.arange(n + 1))
                places = places[order]
                out += [np.unique(places[a:b]).astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())],
                ["doc_id", "label", "places"])

    def learnt(batches):
        model = Ftrl(PLACES)
        seen, room = [], SAMPLE_BYTES
        for batch in batches:
            sizes = pc.binary_length(batch.column("places")).to_numpy()
            fits = np.cumsum(sizes) <= room
            if fits.any():
                seen.append(batch if fits.all() else batch.filter(pa.array(fits)))
                room -= int(sizes[fits].sum())
        # views into the batches, not copies
        rows = [(np.frombuffer(x.as_buffer(), dtype=np.int32), y) for batch in seen
                for y, x in zip(batch.column("label").to_pylist(), batch.column("places"))]
        for _ in range(rounds):
            for x, y in rows:
                model.learn(x, y)
        at = np.union1d(np.flatnonzero(np.abs(model.z) > model.l1), [PLACES])
        w = model.weights(at)
        del model
        w[-1] += logit(THRESHOLD) - boundary(*unseen(rows, rounds)) if rows else 0.0
        yield pa.RecordBatch.from_pydict({
            "places": pa.array([at.astype(np.int32).tobytes()], pa.binary()),
            "weights": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    examples = saved(
        rows.mapInArrow(lean(featured), "doc_id bigint, label int, places binary"), "examples")
    found = saved(examples.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "places").mapInArrow(
        lean(learnt), "places binary, weights binary"), "model").first()
    return (found.places, found.weights) if found else (b"", b"")  # no labels, no weights


def score(docs: DataFrame, model: tuple, *keep: Column) -> DataFrame:
    """``docs`` columns ``keep`` and ``score``, from 0 to 1, of each row's ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = rows.drop("_text").withColumn("score", F.lit(0.0)).schema

    def scored(batches):
        places, weights = sent.value
        table = np.zeros(PLACES + 1, dtype=np.float32)
        table[np.frombuffer(places, dtype=np.int32)] = np.frombuffer(weights, dtype=np.float32)
        for batch in by_bytes(batches, "_text"):
            sums = []
            for found, whose, n in _hashed(batch.column("_text")):
                hit = np.flatnonzero(table[found])
                one = np.unique(whose[hit] * PLACES + found[hit])  # a feature counts once in a text
                sums.append(np.bincount(one // PLACES, table[one % PLACES], minlength=n))
            total = np.concatenate(sums or [np.zeros(0)]) + table[PLACES]
            result = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in schema.fields[:-1]), pa.array(result)],
                [f.name for f in schema.fields])

    return rows.mapInArrow(lean(scored), schema)


def held_out() -> Column:
    """Rows that the model never sees: a third, by a checksum of the id."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``."""
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model, F.col("doc_id").cast("bigint").alias("doc_id")).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
