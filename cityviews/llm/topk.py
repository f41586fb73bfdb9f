"""Exact top-k by inner product with dual-tree search on cover trees.

The first level of the tree is shared by all tasks: some centres, far apart, from a bounded sample
of vectors, and for each the radius that covers the vectors nearest to it. Below it each part of a
centre's vectors gets a cover tree of its own, and so do the queries that meet it. A pair of nodes
is dropped if its best possible score,
``<q, r> + rq |r| + rr |q| + rq rr`` for centres q, r and covering radii rq, rr,
is below the worst k-th score of the queries in it; ties are kept. Near pairs go first.

A query first searches the part it belongs to, so that it has a k-th score before it is sent to
the others; centres that cannot reach that score get no copy of it.

Components are floored multiples, as double. Vectors that are null, empty or hold null or
non-finite components take no part, nor do null ids; vectors of another length are not compared.
A query's own id is never its result.
Query rows that repeat id and vector are one query; two vectors of one id are two, each with its
own list. Rows that repeat are candidates each on its own. Scores are exact up to 53 bits; larger ones are rounded to
doubles, and cut off at the limits of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityviews.llm.common import buckets_for, saved
from cityviews.llm.scores import Best, floored, loose
from cityviews.llm.scores import inner_products as _scores

SAMPLE_BYTES = 4 << 20  # of the sample that centres are taken from
CENTRES = 64
EACH = 512              # vectors for which there is one centre, up to CENTRES
PART = 16_384           # vectors of a centre that one task holds
QUERIES = 4_096         # queries that meet a part in one task
LEAF = 256              # vectors that a node need not split
QUERY_LEAF = 32
FAN = 48                # children of a node, if they are within half its radius of all its points
FEW = 4                 # children of a node that has none so near
KEYS = ("dim", "centre", "chunk", "part")
ROWS = "vec_id bigint, dim int, centre int, dist double, vec binary"


def top_k(vectors: DataFrame, k: int = 5, scale: float = 256.0, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` rows of ``vectors(vec_id, embedding)``
    for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    source = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id is not null and size(embedding) > 0")
    usable = saved(source.mapInArrow(floored(scale), "vec_id bigint, dim int, vec binary"), "vectors")
    total = usable.count()
    centres = spark.sparkContext.broadcast(_centres(usable, total))
    data = saved(usable.mapInArrow(_assigned(centres), ROWS), "assigned")

    wide = data.groupBy("dim", "centre").agg(
        F.count("*").alias("n"), F.max("dist").alias("radius")).collect()  # a row per centre
    parts = {(r["dim"], r["centre"]): (buckets_for(r["n"], PART), r["radius"]) for r in wide}
    chunks = F.create_map(*[F.lit(x) for (d, c), (n, _) in parts.items() for x in (f"{d}:{c}", n)]) \
        if parts else F.create_map(F.lit(""), F.lit(1))
    key = F.concat_ws(":", "dim", "centre")
    data = data.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.get(F.array(chunks), F.lit(0))[key]).cast("int"))

    queries = data.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "vec"]).select(
        F.col("vec_id").alias("query_id"), "dim", "centre", "chunk", "vec")
    queries = saved(queries.withColumn("floor", F.lit(None).cast("double")), "queries")
    near = saved(_searched(queries.withColumn("part", F.lit(0)), data.withColumn("part", F.lit(0)), k), "near")
    kth = near.groupBy("query_id", "vec").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    rest = queries.drop("floor").join(kth, ["query_id", "vec"], "left").mapInArrow(
        _sent(centres, parts), "query_id bigint, dim int, centre int, chunk int, vec binary, floor double")
    groups = buckets_for(queries.count(), QUERIES)
    rest = saved(rest.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")), "sent")
    # a part is copied for those groups of queries alone that have one for it
    asked = rest.select("dim", "centre", "chunk", F.col("part").alias("_part")).distinct()
    met = data.join(asked, ["dim", "centre", "chunk"]).withColumn("part", F.col("_part") + 0)
    far = _searched(rest, met, k)
    order = Window.partitionBy("query_id", "vec").orderBy(F.desc("score"), "vec_id")
    return near.unionByName(far).select("query_id", "vec", "vec_id", "score").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.col("score").cast("bigint").alias("score"))


def _centres(usable: DataFrame, total: int) -> dict[int, np.ndarray]:
    """For each length, points far apart: each is the farthest from those before it."""
    if not total:
        return {}
    longest = usable.agg(F.max("dim")).first()[0]
    rows = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(
        max(CENTRES, SAMPLE_BYTES // (8 * longest))).collect()
    out = {}
    for dim in sorted({r["dim"] for r in rows}):
        x = np.array([np.frombuffer(r["vec"]) for r in rows if r["dim"] == dim])
        picked, far = [0], np.linalg.norm(x - x[0], axis=1)
        while len(picked) < min(CENTRES, max(1, total // EACH)) and far.max() > 0:
            picked.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(x - x[picked[-1]], axis=1))
        out[dim] = x[picked]
    return out


def _assigned(centres):
    def make(batches):
        for batch in batches:
            vecs, dims = batch.column("vec").to_pylist(), batch.column("dim").to_numpy()
            centre, dist = np.zeros(len(vecs), dtype=np.int32), np.zeros(len(vecs))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.array([np.frombuffer(vecs[i]) for i in at])
                to = centres.value.get(int(dim), np.zeros((1, dim)))
                far = np.sqrt(np.maximum(
                    (x * x).sum(1)[:, None] - 2 * x @ to.T + (to * to).sum(1)[None, :], 0))
                centre[at] = far.argmin(axis=1)
                dist[at] = np.linalg.norm(x - to[centre[at]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("dim"), pa.array(centre), pa.array(dist),
                 batch.column("vec")], ["vec_id", "dim", "centre", "dist", "vec"])

    return make


def _sent(centres, parts):
    """A copy of each query for every other part that may reach its k-th score."""

    def make(batches):
        for batch in batches:
            out = []
            for q, dim, centre, chunk, vec, floor in zip(*(
                    batch.column(k).to_pylist() for k in ("query_id", "dim", "centre", "chunk", "vec", "floor"))):
                x = np.frombuffer(vec)
                to = centres.value.get(dim, np.zeros((1, dim)))
                best = to @ x
                for c in range(len(to)):
                    n, radius = parts.get((dim, c), (0, 0.0))
                    reach = loose(best[c] + radius * np.linalg.norm(x))
                    if floor is not None and reach < floor:
                        continue
                    out += [(q, dim, c, i, vec, floor) for i in range(n) if (c, i) != (centre, chunk)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)],
                ["query_id", "dim", "centre", "chunk", "vec", "floor"])

    return make


def _searched(queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    def search(q: pa.Table, r: pa.Table) -> pa.Table:
        found = ([], [], [])
        if q.num_rows and r.num_rows:
            r = r.sort_by("vec_id")
            floor = q.column("floor").to_numpy().astype(float)
            best = Best(q.column("query_id").to_numpy(), np.where(np.isnan(floor), -np.inf, floor), k)
            x, y = (np.array([np.frombuffer(v) for v in t.column("vec").to_pylist()]) for t in (q, r))
            dual(x, y, r.column("vec_id").to_numpy(), best)
            found = best.rows()
            vecs = q.column("vec").to_pylist()
        return pa.table({
            "query_id": pa.array(best.ids[found[0]] if len(found[0]) else [], pa.int64()),
            "vec": pa.array([vecs[i] for i in found[0]], pa.binary()),
            "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    wanted = queries.select("query_id", "vec", "floor", *KEYS).groupBy(*KEYS)
    return wanted.cogroup(data.select("vec_id", "vec", *KEYS).groupBy(*KEYS)).applyInArrow(
        search, "query_id bigint, vec binary, vec_id bigint, score double")


class Node:
    __slots__ = ("centre", "radius", "rows", "children", "norm")

    def __init__(self, x: np.ndarray, rows: np.ndarray, centre: np.ndarray):
        self.centre, self.rows, self.children = centre, rows, []
        self.radius = float(np.sqrt(((x[rows] - centre) ** 2).sum(1).max()))
        self.norm = float(np.linalg.norm(centre))


def cover_tree(x: np.ndarray, leaf: int) -> Node:
    """A node's children are points of it far apart, ``FAN`` at most, each with the points it is nearest to.

    They are picked until all points are within half the node's radius of one. Where ``FAN`` points
    don't reach that far, as with many even dimensions, the first ``FEW`` part the node, and the radii of
    the children are what they are.
    """
    top = Node(x, np.arange(len(x)), x[0])
    open_ = [top]
    while open_:
        node = open_.pop()
        if len(node.rows) <= leaf or node.radius == 0:
            continue
        part = x[node.rows]
        far, nearest = np.sqrt(((part - node.centre) ** 2).sum(1)), np.zeros(len(part), dtype=np.int64)
        centres, few = [node.centre], nearest
        while len(centres) < FAN and far.max() > node.radius / 2:
            centres.append(part[far.argmax()])
            new = np.sqrt(((part - centres[-1]) ** 2).sum(1))
            nearest = np.where(new < far, len(centres) - 1, nearest)
            far = np.minimum(far, new)
            if len(centres) == FEW:
                few = nearest
        if far.max() > node.radius / 2:
            centres, nearest = centres[:FEW], few
        node.children = [Node(x, node.rows[nearest == i], c) for i, c in enumerate(centres) if (nearest == i).any()]
        open_ += node.children
    return top


def _bounds(node: Node, others: list[Node]) -> np.ndarray:
    centres = np.array([o.centre for o in others])
    norm, radius = np.array([o.norm for o in others]), np.array([o.radius for o in others])
    return loose(centres @ node.centre + node.radius * norm + radius * node.norm + node.radius * radius)


def dual(x: np.ndarray, y: np.ndarray, ids: np.ndarray, best: Best) -> None:
    q, r = cover_tree(x, QUERY_LEAF), cover_tree(y, LEAF)
    stack = [(float(_bounds(q, [r])[0]), q, r)]
    while stack:
        bound, q, r = stack.pop()
        if bound < best.worst[q.rows].min():
            continue
        if not q.children and not r.children:
            for i in range(0, len(q.rows), 512):
                a = q.rows[i:i + 512]
                for j in range(0, len(r.rows), 1024):
                    b = r.rows[j:j + 1024]
                    best.offer(a, ids[b], _scores(x[a], y[b]))
            continue
        if r.children and (r.radius >= q.radius or not q.children):
            pairs = list(zip(_bounds(q, r.children).tolist(), [q] * len(r.children), r.children))
        else:
            pairs = list(zip(_bounds(r, q.children).tolist(), q.children, [r] * len(q.children)))
        stack += sorted(pairs, key=lambda p: p[0])
