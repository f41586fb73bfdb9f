"""Document fingerprints: bottom-k sketches of word-shingle hashes.

The sketch of a text holds the ``k`` least hashes of its distinct shingles, in order. A text of
fewer words than a shingle has one shingle, a text without words none. Sketches of parts merge
into the sketch of the whole; two sketches tell the resemblance and containment of their texts,
one tells how many distinct shingles a text has. All of it is DataFrame code. Null text is as
empty; two empty sketches are alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityviews.llm.common import id_ranges, saved, text_order

K = 128
WORDS = 5
EACH = 2_000     # rows of a range of ids


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    w = F.array_remove(F.split(F.lower(text), r"[ \t-\r]+"), "")

    def hashed(w: Column) -> Column:
        rolled = F.transform(
            F.sequence(F.lit(0), F.size(w) - words),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(words)]))
        return F.when(F.size(w) >= words, rolled).when(
            F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    # the words are bound to a variable, so that the text is split once
    hashes = F.get(F.transform(F.array(w), hashed), F.lit(0))
    return least(F.coalesce(hashes, F.array().cast("array<bigint>")), k)


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return least(F.concat(a, b), k)


def merge_by(df: DataFrame, keys: Sequence[str], column: str, k: int = K, salts: int = 64) -> DataFrame:
    """One sketch per key from any number of sketches; a hot key is merged in ``salts`` parts first."""
    rows = df.select(*keys, F.explode(column).alias("_h")).distinct()
    for salt in (F.pmod("_h", F.lit(salts)), F.lit(0)):
        order = Window.partitionBy(*keys, "_s").orderBy("_h")
        rows = rows.withColumn("_s", salt).withColumn(
            "_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_s", "_r")
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    both = F.size(F.array_intersect(merged(a, b, k), F.array_intersect(a, b)))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        both / F.size(merged(a, b, k)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    j = resemblance(a, b, k)
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), j * union / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each text of ``docs(doc_id, text)``, of its edited text, and likeness.

    The edited text has its last quarter (``floor(n_chars / 4)`` code points) replaced by as many
    code points, or all, from the start of the next document by ``doc_id``; the first follows the
    last. Equal ids are ordered by the hash of their text, then by text; a null id comes first, as
    the least id.

    Texts are shuffled once, by range of ids; only the first row of each range is fetched from
    outside the range. Ranges grow in number with the rows, and rows of one id are split by the
    hash of their text, so only rows equal in id and text must be one task's.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("_k"),
        text_order(F.col("text")).alias("_h"))
    docs = id_ranges(docs, "_k", "_h", EACH)
    heads = saved(docs.groupBy("_r").agg(F.min(F.struct("_k", "_h", "text")).alias("_m")).select(
        "_r", F.col("_m.text").alias("_head")), "heads")
    order = Window.orderBy("_r")  # one number per range
    following = heads.select(
        F.col("_r").alias("_of"),
        F.coalesce(F.lead("_r").over(order),
                   F.first("_r").over(order.rowsBetween(
                       Window.unboundedPreceding, Window.unboundedFollowing))).alias("_then"))
    heads = following.join(heads, F.col("_then") == F.col("_r")).select("_of", "_head")
    inside = Window.partitionBy("_r").orderBy("_k", "_h", "text")
    rows = docs.repartition("_r").select(
        "_r", "_k", "_h", "doc_id", "text", F.lead("text").over(inside).alias("_next"),
        F.lead(F.lit(True)).over(inside).isNull().alias("_last"))
    rows = rows.join(heads, F.col("_r") == F.col("_of"), "left").select(
        "_r", "_k", "_h", "doc_id", "text",
        F.when(F.col("_last"), F.col("_head")).otherwise(F.col("_next")).alias("_next"),
        sketch(F.col("text"), k).alias("_a"), "_last", "_head")
    rows = rows.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "_next", "_a",
        F.when(F.col("_last"), sketch(F.col("_head"), k)).otherwise(
            F.lead("_a").over(inside)).alias("_c"),
        "text")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.select(
        "doc_id", "n_chars", "_a", "_c", F.concat(
            F.left("text", (F.col("n_chars") - quarter).cast("int")), F.left("_next", quarter)).alias("_edited"))
    rows = rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        "_a", sketch(F.col("_edited"), k).alias("_b"), "_c")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("_a")).alias("fingerprint"),
        as_text(F.col("_b")).alias("edited_fingerprint"),
        resemblance(F.col("_a"), F.col("_b"), k).alias("near_edited"),
        resemblance(F.col("_a"), F.col("_c"), k).alias("near_next"))
