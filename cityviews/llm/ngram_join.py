"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct word shingles. Two link when
``per_cent * |union| <= 100 * |intersection|``. The steps:

1. A tally of fixed size, over all documents, tells frequent shingles from rare ones. It fixes a
   global order: rare shingles by hash, then frequent ones by frequency.
2. Documents with equal sets become one class; classes with the same size and the same prefix
   (the first shingles in that order, enough that linked sets must share one) one group.
3. Groups that share a prefix shingle are compared, by size and by a 512-bit parity map whose
   Hamming distance never exceeds the symmetric difference. No set is needed for that.
4. Of a pair that is left, wider parity maps, of about a bit per shingle, are compared.
5. First only a spanning forest of the remaining group pairs is expanded to members and verified
   on whole sets. Then every remaining pair is whose sides are not yet in one component. So no
   link is lost, and a crowd of near copies doesn't make all its pairs.

A list of groups that share a shingle may be of any length: long ones are cut into blocks, and
blocks are compared two at a time. Verification is exact but for equal 64-bit hashes.

Null or empty text, or text of white space only: no shingles, component of its own. A null
``doc_id`` takes no part and has a null component. Rows with one ``doc_id`` are documents of
their own that happen to share a name. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import as_blocks, by_bytes, gathered, lean, saved, slices
from cityviews.llm.components import roots
from cityviews.llm.wordblocks import distinct, shingles

CELLS = 1 << 20       # counters of the tally, 4 MB
MAP_BYTES = 64        # size of a parity map in the lists
BLOCK = 1024          # groups compared at a time in one list
GROUP = 16            # classes that a group may hold; larger ones are kept as single classes
FIRST = 8             # prefix shingles that tell in which list a pair is reported
PAIRS = 1 << 16       # pairs of groups looked at together


def jaccard_components(docs: DataFrame, words: int = 3, per_cent: int = 90) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(_frequent(_tally(docs, words)))
    rows = saved(_features(docs, words, per_cent, frequent), "features")

    classes = rows.where("doc_id is not null and cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"),
        F.first(F.struct("n", "gid", "prefix", "bits", "wide")).alias("f"))
    classes = saved(
        classes.select(F.monotonically_increasing_id().alias("cid"), "cls", "rep", "f.*"), "classes")

    sizes = classes.groupBy("gid").agg(F.count("*").alias("m"), F.min("cid").alias("head"))
    shared = saved(sizes.where("m > 1"), "shared")
    in_group = classes.join(shared, "gid")  # few rows: sets that agree in size and whole prefix
    small, large = in_group.where(F.col("m") <= GROUP), in_group.where(F.col("m") > GROUP)
    alone = classes.join(shared, "gid", "left_anti").select(
        F.col("cid").alias("uid"), "n", "prefix", "bits")
    units = alone.unionByName(
        small.where("cid = head").select(
            (-1 - F.col("head")).alias("uid"), "n", "prefix", F.lit(None).cast("binary").alias("bits"))
    ).unionByName(large.select(F.col("cid").alias("uid"), "n", "prefix", "bits"))
    members = saved(small.select((-1 - F.col("head")).alias("uid"), "cid"), "members")

    lists = _lists(units, large)
    lists = saved(lists, "lists")
    inside = members.alias("x").join(members.alias("y"), "uid").where("x.cid < y.cid").select(
        F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))

    looks = units.select("uid", "n", "bits", F.slice("prefix", 1, FIRST).alias("first"))
    tried = saved(_pairs(lists, looks.drop("first"), None, per_cent), "pairs")
    found = saved(_verified(docs, classes, _expand(tried, members).unionByName(inside),
                            words, per_cent), "links")
    rest = _pairs(lists, looks, roots(found), per_cent).join(tried, ["a", "b"], "left_anti")
    more = _verified(docs, classes, _expand(rest, members), words, per_cent)
    found = saved(found.unionByName(more), "links")

    top = classes.select("cid", "rep", "cls").join(
        roots(found).withColumnRenamed("node", "cid"), "cid", "left")
    top = top.withColumn("root", F.coalesce("root", "cid"))
    least = top.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = top.join(least, "root").select("cls", "component_id")
    out = rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("cls")).alias("cls"))
    return out.where("cls is not null").join(named, "cls", "left").unionByName(
        out.where("cls is null").withColumn("component_id", F.col("doc_id"))
    ).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")


def _tally(docs: DataFrame, words: int) -> np.ndarray:
    """How many documents hold a shingle that falls into each counter."""

    def count(batches):
        counts = np.zeros(CELLS, dtype=np.uint32)
        for batch in batches:
            for h in shingles(batch.column("text"), words):
                counts[np.unique(h & np.uint64(CELLS - 1))] += 1
        yield as_blocks(counts)

    return gathered(docs.select("text").mapInArrow(lean(count), "block int, data binary"), CELLS, "uint32")


def _frequent(counts: np.ndarray) -> np.ndarray:
    """The counts that stand out from the rest; 0 for others, which are as good as rare."""
    mean = float(np.mean(counts))
    return np.where(counts > mean + 6 * mean ** 0.5 + 16, counts, 0).astype(np.uint32)


def _features(docs, words, per_cent, frequent) -> DataFrame:
    def make(batches):
        heavy = frequent.value
        for batch in by_bytes(slices(batches), "text"):
            out = {k: [] for k in ("n", "cls", "gid", "prefix", "bits", "wide")}
            for h in shingles(batch.column("text"), words):
                s = distinct(h)
                n = len(s)
                out["n"].append(n)
                if not n:
                    for k in ("cls", "gid", "prefix", "bits", "wide"):
                        out[k].append(None)
                    continue
                weight = heavy[s & np.uint64(CELLS - 1)]
                k = n + (-per_cent * n // 100) + 1
                prefix = s[np.flatnonzero(weight == 0)[:k]]
                if len(prefix) < k:
                    rest = np.flatnonzero(weight)
                    rest = rest[np.argsort(weight[rest], kind="stable")]
                    prefix = np.concatenate((prefix, s[rest[:k - len(prefix)]]))
                bits = max(8 * MAP_BYTES, 1 << (n - 1).bit_length())
                odd = np.bincount((s >> np.uint64(32)).astype(np.int64) & (bits - 1), minlength=bits) & 1
                wide = np.packbits(odd.astype(np.uint8))
                out["cls"].append(xxhash.xxh128_digest(s.tobytes()))
                out["gid"].append(xxhash.xxh128_digest(prefix.tobytes(), seed=n))
                out["prefix"].append(prefix.view(np.int64))
                out["bits"].append(_folded(wide, MAP_BYTES).tobytes())
                out["wide"].append(wide.tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(out["n"], pa.int32()),
                pa.array(out["cls"], pa.binary()), pa.array(out["gid"], pa.binary()),
                pa.array(out["prefix"], pa.list_(pa.int64())), pa.array(out["bits"], pa.binary()),
                pa.array(out["wide"], pa.binary()),
            ], ["doc_id", "n", "cls", "gid", "prefix", "bits", "wide"])

    return docs.mapInArrow(
        lean(make), "doc_id bigint, n int, cls binary, gid binary, prefix array<bigint>, bits binary, "
        "wide binary")


def _folded(parity: np.ndarray, size: int) -> np.ndarray:
    """A parity map of ``size`` bytes from a larger one: shingles keep the low bits of their place."""
    return np.bitwise_xor.reduce(parity.reshape(-1, size), axis=0)


def _lists(units: DataFrame, large: DataFrame) -> DataFrame:
    """``token, bi, bj, side, uid``: who shares a shingle, in blocks two at a time."""
    posts = units.select("uid", F.explode("prefix").alias("token")).unionByName(
        # classes of an oversized group meet once more, whatever else they share
        large.select(F.col("cid").alias("uid"), F.xxhash64("gid").alias("token"))).distinct()
    often = posts.groupBy("token").agg(F.count("*").alias("_c")).where("_c > 1").select(
        F.col("token").alias("_t"), F.ceil(F.col("_c") / BLOCK).cast("int").alias("_b"))
    posts = posts.join(often, F.col("token") == F.col("_t")).select(
        "token", "uid", "_b", F.pmod(F.xxhash64("uid"), F.col("_b")).cast("int").alias("side"))
    return posts.select(
        "token", "uid", "side", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)).alias("_o")
    ).select("token", F.least("side", "_o").alias("bi"), F.greatest("side", "_o").alias("bj"),
             "side", "uid")


def _pairs(lists: DataFrame, looks: DataFrame, known: DataFrame | None, per_cent: int) -> DataFrame:
    """Pairs of units that may link, as far as sizes and parity maps tell.

    Without ``known``, enough pairs to connect what may be connected. With ``known(node, root)``,
    all pairs whose sides aren't in one component yet; a pair is reported in the list of the
    first shingle that both have, if that is among their first few.
    """
    forest = known is None
    keys = ["token", "bi", "bj"]
    if forest:
        rows = lists.join(looks, "uid").withColumn("label", F.col("uid"))
        extra = []
    else:
        rows = lists.join(known, F.col("uid") == F.col("node"), "left").select(
            *lists.columns, F.coalesce("root", "uid").alias("label"))
        live = rows.groupBy(*keys).agg(F.min("label").alias("_x"), F.max("label").alias("_y")).where(
            "_x != _y").select(*keys)
        rows = rows.join(live, keys, "left_semi").join(looks, "uid")
        extra = ["first"]
    rows = rows.select(*keys, "side", "uid", "label", "n", "bits", *extra).repartition(
        *keys).sortWithinPartitions(*keys)

    def find(batches):
        parents: dict[int, int] = {}

        def top(x):
            while (y := parents.get(x, x)) != x:
                parents[x] = x = parents.get(y, y)
            return x

        for group in _whole_lists(batches, keys):
            for a, b, multi in _near(group, per_cent):
                if forest:
                    keep = []
                    for i, (x, y, m) in enumerate(zip(a.tolist(), b.tolist(), multi.tolist())):
                        if not m:
                            x, y = top(x), top(y)
                            if x == y:
                                continue
                            parents[x] = y
                        keep.append(i)
                    a, b = a[keep], b[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return rows.mapInArrow(lean(find), "a bigint, b bigint").distinct()


def _whole_lists(batches, keys):
    """Tables that hold only whole lists; a list's rows come one after another."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < 4 * BLOCK:
            continue
        starts = _starts(held, keys)
        if len(starts) > 1:
            yield held.slice(0, starts[-1]).combine_chunks()
            held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _starts(table: pa.Table, keys) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    change[:1] = True
    for k in keys:
        x = table.column(k).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(change)


def _near(table: pa.Table, per_cent: int):
    """(a, b, multi) arrays of pairs within lists that pass the filters."""
    col = {k: table.column(k).to_numpy() for k in ("bi", "bj", "side", "uid", "label", "n")}
    bits = table.column("bits").to_pylist()
    multi = np.array([x is None for x in bits], dtype=bool)
    blank = bytes(MAP_BYTES)
    maps = np.frombuffer(b"".join(x or blank for x in bits), dtype=np.uint64).reshape(
        len(bits), MAP_BYTES // 8)
    first = None
    if "first" in table.column_names:
        tokens = table.column("token").to_numpy()
        heads = table.column("first").to_pylist()
        first = lambda i, j: _earliest(heads[i], heads[j], tokens[i])
    starts = np.append(_starts(table, ("token", "bi", "bj")), table.num_rows)
    sizes = np.diff(starts)
    for m in np.unique(sizes):
        if m < 2:
            continue
        at = starts[:-1][sizes == m]
        i, j = (x.astype(np.int32) for x in np.triu_indices(m, 1))
        step = max(1, PAIRS // len(i))
        for k in range(0, len(at), step):
            some, passed = at[k:k + step, None].astype(np.int32), []
            for p in range(0, len(i), PAIRS):
                x, y = (some + i[p:p + PAIRS]).ravel(), (some + j[p:p + PAIRS]).ravel()
                small, big = np.minimum(col["n"][x], col["n"][y]), np.maximum(col["n"][x], col["n"][y])
                ok = (100 * small.astype(np.int64) >= per_cent * big.astype(np.int64)) & (
                    col["label"][x] != col["label"][y])
                ok &= (col["bi"][x] == col["bj"][x]) | (col["side"][x] != col["side"][y])
                x, y = x[ok], y[ok]
                apart = np.bitwise_count(maps[x] ^ maps[y]).sum(axis=1, dtype=np.int32)
                both = (col["n"][x] + col["n"][y]).astype(np.int64)
                ok = multi[x] | multi[y] | (apart.astype(np.int64) * (100 + per_cent) <= both * (100 - per_cent))
                x, y, apart = x[ok], y[ok], apart[ok]
                if first is not None and len(x):
                    ok = np.fromiter((first(p, q) for p, q in zip(x.tolist(), y.tolist())), bool, len(x))
                    x, y, apart = x[ok], y[ok], apart[ok]
                passed.append((x, y, apart))
            x, y, apart = (np.concatenate(c) for c in zip(*passed))
            order = np.argsort(apart, kind="stable")  # the nearest first
            for p in range(0, len(order), PAIRS):
                a, b = x[order[p:p + PAIRS]], y[order[p:p + PAIRS]]
                yield col["uid"][a], col["uid"][b], multi[a] | multi[b]


def _earliest(a, b, token) -> bool:
    """No other list among the first shingles of both comes before the one of ``token``."""
    common = set(a) & set(b)
    return not common or token == next(t for t in a if t in common)


def _expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of units as pairs of classes."""
    x = members.select(F.col("uid").alias("a"), F.col("cid").alias("_a"))
    y = members.select(F.col("uid").alias("b"), F.col("cid").alias("_b"))
    return pairs.join(x, "a", "left").join(y, "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))


def _plausible(pairs: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """The pairs of classes that their wide parity maps don't rule out."""

    def check(batches):
        for batch in batches:
            keep = []
            for m, n, x, y in zip(*(batch.column(k).to_pylist() for k in ("m", "n", "x", "y"))):
                size = min(len(x), len(y))
                apart = np.bitwise_count(
                    _folded(np.frombuffer(x, np.uint8), size) ^ _folded(np.frombuffer(y, np.uint8), size))
                keep.append(int(apart.sum()) * (100 + per_cent) <= (m + n) * (100 - per_cent))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    maps = classes.select("cid", "n", "wide")
    return pairs.join(maps.toDF("a", "m", "x"), "a").join(maps.toDF("b", "n", "y"), "b").mapInArrow(
        lean(check), "a bigint, b bigint")


def _verified(docs, classes, pairs, words, per_cent) -> DataFrame:
    """The pairs of classes whose sets really link."""
    spark = docs.sparkSession
    pairs = saved(_plausible(pairs, classes, per_cent), "candidates")
    wanted = saved(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(
        classes.select("cid", "cls", "rep"), "cid"), "wanted")

    def mark(batches):
        seen = np.zeros(CELLS * 8, dtype=np.uint8)
        for batch in batches:
            seen[_slot(batch.column("rep").to_numpy())] = 1
        yield as_blocks(seen)

    seen = spark.sparkContext.broadcast(np.packbits(gathered(
        wanted.select("rep").mapInArrow(mark, "block int, data binary"), CELLS * 8, "uint8") > 0))

    def sets(batches):
        maybe = np.unpackbits(seen.value)
        for batch in by_bytes(slices(batches), "text"):
            ids = batch.column("doc_id")
            keep = ids.is_valid().to_numpy(zero_copy_only=False)
            keep &= maybe[_slot(ids.fill_null(0).to_numpy())] > 0
            batch = batch.filter(pa.array(keep))
            found = [distinct(h) for h in shingles(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([xxhash.xxh128_digest(s.tobytes()) for s in found], pa.binary()),
                pa.array([s.tobytes() for s in found], pa.binary())], ["rep", "cls", "members"])

    # a row of fixed width for each document that may be wanted; the join is exact
    sets_of = docs.mapInArrow(lean(sets), "rep bigint, cls binary, members binary").join(
        wanted, ["rep", "cls"]).select("cid", "members").dropDuplicates(["cid"])
    sets_of = saved(sets_of, "sets")

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x = np.frombuffer(x.as_py(), dtype=np.uint64)
                y = np.frombuffer(y.as_py(), dtype=np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int(np.count_nonzero(y[at] == x))
                keep.append(100 * both >= per_cent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return pairs.join(sets_of.toDF("a", "x"), "a").join(sets_of.toDF("b", "y"), "b").mapInArrow(
        lean(check), "a bigint, b bigint")


def _slot(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(41)).astype(np.int64)
