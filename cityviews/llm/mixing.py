"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

A source with token share ``s`` gets a weight in proportion to ``s ** exponent``. The exponent is
found by bisection: the least in [0, 1], so the flattest mixture, whose entropy is at most the
target, or in which no source is read more than ``max_repeats`` times. If there is none, it is 1.
By default the budget is such that the source that is read least is read once, so no document is
lost; the others are repeated.

A source's part of the budget is taken in passes, each over a permutation of its documents; the
last pass ends where the budget does. The mixture is a row of blocks: each block has the same part
of every source's budget, in shuffled order, so the weights hold all along.

Tokens are words between ASCII white space. Sources without tokens are read once. A null source
is a source, a null text has no tokens, rows with one ``doc_id`` are drawn together. All of it is
DataFrame code; the driver sees only sums over sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityviews.llm.common import before, buckets_for, saved

MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 20
EACH = 20_000           # documents of a source that one task adds up
SECTIONS = 64           # exponents tried at once: six bisections
ROUNDS = 8


def tokens() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def draw_key(pass_: Column) -> Column:
    """Eight hexadecimal digits that order the documents of a pass."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), pass_.cast("string"))
    return F.substring(F.md5(name), 1, 8)


def exponent(
    sources: DataFrame, entropy: float | None = None, max_repeats: float | None = None,
    budget: float | None = None,
) -> float:
    """The least exponent that meets the target for ``sources(source, tokens)``."""
    some = sources.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    top = some.agg(F.max("t")).first()[0]
    if top is None:
        return 1.0
    low, high = 0.0, 1.0
    for i in range(ROUNDS):
        tried = [low + (high - low) * k / SECTIONS for k in range(0 if i == 0 else 1, SECTIONS + 1)]
        power = F.pow(F.col("t") / top, F.col("a"))
        each = some.select("t", F.explode(F.array(*[F.lit(a) for a in tried])).alias("a"))
        read = F.max(power / F.col("t"))   # times the weight of the largest source, per token
        sums = each.groupBy("a").agg(
            F.sum(power).alias("sum"), F.sum(power * F.log(power)).alias("log"),
            read.alias("most"), F.min(power / F.col("t")).alias("least"))
        good = []
        for r in sums.collect():  # SECTIONS rows
            scale = budget / r["sum"] if budget else 1 / r["least"]
            met = (entropy is None or math.log(r["sum"]) - r["log"] / r["sum"] <= entropy) and (
                max_repeats is None or r["most"] * scale <= max_repeats)
            if met:
                good.append(r["a"])
        if not good:
            return 1.0
        high = min(good)
        if high == 0.0:
            return 0.0
        low = max(a for a in [low, *tried] if a < high)
    return high


def plan(
    docs: DataFrame, entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
    budget: float | None = None,
) -> DataFrame:
    """A row per source of ``docs``: its weight, its budget in tokens, and where its last pass ends.

    Written to the shared folder, so Spark knows its size and picks the way to join it.
    """
    rows = docs.select("doc_id", "source", tokens().alias("tokens"))
    rows = saved(rows, "tokens")
    sources = saved(rows.groupBy("source").agg(
        F.sum("tokens").cast("bigint").alias("tokens"), F.count("*").alias("docs")), "sources")
    a = exponent(sources, entropy, max_repeats, budget)
    top = sources.agg(F.max("tokens")).first()[0] or 1
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / float(top), F.lit(a))).otherwise(0.0)
    sources = sources.withColumn("_p", power)
    total, least = sources.where("tokens > 0").agg(
        F.sum("_p"), F.min(F.col("_p") / F.col("tokens"))).first()
    per_power = 0.0 if not total else budget / total if budget else 1 / least
    sources = sources.select(
        "source", "tokens", "docs", F.lit(a).alias("exponent"),
        (F.col("_p") / F.lit(total or 1.0)).alias("weight"),
        F.round(F.col("_p") * per_power).cast("bigint").alias("quota")
    ).select(
        "*", F.when(F.col("tokens") > 0, F.call_function("div", F.col("quota"), F.greatest("tokens", F.lit(1))))
        .otherwise(1).cast("int").alias("passes"))
    sources = saved(sources.withColumn("rest", F.when(
        F.col("tokens") > 0, F.col("quota") - F.col("passes") * F.col("tokens")).otherwise(0)), "quotas")

    last = rows.join(sources.where("rest > 0").select(
        F.col("source").alias("_s"), "passes", "rest", "docs"), F.col("source").eqNullSafe(F.col("_s"))
    ).select("source", "doc_id", "tokens", "rest", "docs", draw_key(F.col("passes")).alias("_k"))
    last = before(last.withColumn("_b", _bucket(F.col("docs"))), ["source"], "_b",
                  [F.col("_k"), F.col("doc_id")], F.col("tokens"), "_at").where("_at < rest")
    ends = last.groupBy(F.col("source").alias("_s")).agg(
        F.max(F.concat_ws(":", "_k", _padded())).alias("cut"))
    return saved(sources.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "plan")


def _padded() -> Column:
    return F.lpad(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), 20, "0")


def _bucket(docs: Column) -> Column:
    """Ranges of the draw key with about EACH documents of a source."""
    parts = F.ceil(docs / EACH)
    return F.floor(F.conv(F.col("_k"), 16, 10).cast("bigint") * parts / F.lit(1 << 32)).cast("int")


def copies(docs: DataFrame, plan: DataFrame, *keep: str) -> DataFrame:
    """``docs`` as often as the mixture reads each row, with the number of the ``pass`` and the
    columns ``keep`` of the plan. No row is shuffled if the plan is small."""
    p = plan.select(*[F.col(c).alias(f"_{c}") for c in {"source", "passes", "cut", *keep}])
    rows = docs.join(p, F.col("source").eqNullSafe(F.col("_source")))
    more = F.coalesce(F.concat_ws(":", draw_key(F.col("_passes")), _padded()) <= F.col("_cut"), F.lit(False))
    times = F.col("_passes") + F.when(more, 1).otherwise(0)
    return rows.select(
        *docs.columns, *[F.col(f"_{c}").alias(c) for c in keep if c not in docs.columns],
        F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1))).alias("pass"))


def mix(docs: DataFrame, plan: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Where each copy of each row of ``docs`` stands in the mixture: block, and slot in it."""
    rows = docs.select("doc_id", "source", tokens().alias("n"))
    rows = copies(rows, plan, "tokens", "docs", "quota", "exponent", "weight")
    total = plan.agg(F.sum("quota")).first()[0] or 0
    blocks = buckets_for(int(total), block_tokens)
    rows = rows.withColumn("_k", draw_key(F.col("pass")))
    rows = before(rows.withColumn("_b", _bucket(F.col("docs"))), ["source", "pass"], "_b",
                  [F.col("_k"), F.col("doc_id")], F.col("n"), "_in")
    at = (F.col("_in") + F.col("pass") * F.col("tokens")) / F.greatest(F.col("quota"), F.lit(1))
    rows = rows.withColumn("block", F.least(F.floor(at * blocks), F.lit(blocks - 1)).cast("bigint"))
    shuffled = F.md5(F.concat_ws(
        ":", F.col("block").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.col("pass").cast("string")))
    order = Window.partitionBy("block").orderBy(shuffled, "n")
    return rows.select(
        "doc_id", "source", F.col("n").cast("bigint").alias("tokens"), "pass", "block",
        F.row_number().over(order).alias("slot"),
        F.round("exponent", 6).alias("exponent"), F.round("weight", 6).alias("weight"))
