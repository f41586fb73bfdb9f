"""Repairs the structure of conversations at least cost, by an auction for shortest paths.

The role initials of a conversation shall be ``(s?(ua)+)?``. Its rows, in order, span a lattice of
nodes (rows done, state), where the state is what the initials so far allow next. Keep, Rerole and Delete lead
past a row, Insert to another state; all costs are whole numbers. Every node has a price, at most
its distance to the end. A path grows from its origin: while the price of its last node is less
than the cheapest arc and the price behind it, the price rises to that and the path draws back;
else it is extended along that arc. Nodes are origins from the last row backwards, so a path ends
at the first node whose price is final. With final prices the arcs of all cheapest paths are tight
(price = cost + price behind), and the least letter along tight arcs, from the start, spells the
least of the cheapest edits.

The auction needs one letter per row, so that is all a conversation's rows are gathered for, in pieces
of ``PIECE`` letters; texts are read in order by a task that holds one row at a time. Both
are as long as the conversation's result. Positions come from a range sort over all rows, so that a
conversation may hold any share of the rows until then.

Null ids, roles, turns and texts count as one space in text and as null in order (turns: nulls
first). Rows that share a turn are taken by role, then by SHA-256 of the text. A conversation with a
null id is one of its own. Roles are judged by their first character, whatever follows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityviews.llm.common import before, saved

PIECE = 512
WHITE = " \t\n\x0b\f\r"
LEGAL = frozenset(("su", "ua", "au"))
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1  # costs; CUT: a truncated row that stays
START, SYSTEM, USER, ASSISTANT = range(4)         # states, by the last initial
NEXT = (USER, USER, ASSISTANT, USER)              # state after a rerole or an insert
ROLES = {USER: "user", ASSISTANT: "assistant"}
REMEMBERED = 50_000                               # short conversations whose edits a task keeps

#: One letter per row: its initial; upper case if truncated, a digit if it must go.
INITIALS = "suax"
MUST_GO = "0123"


def edits(rows: str) -> tuple[str, int]:
    """The least of the cheapest edits for ``rows``, a letter each, and their cost."""
    n = len(rows)
    behind = [0] * 4
    # letters[4 * i + state]: the first edit of the best path from there; 0 at an end
    letters = bytearray(4 * (n + 1))
    for i in range(n, -1, -1):
        arcs = [_arcs(rows[i] if i < n else None, state) for state in range(4)]
        price, final = [min(behind)] * 4, [False] * 4  # no arc is shorter than nothing
        for origin in range(4):
            path = [origin]
            while not final[path[-1]]:
                last = path[-1]
                best, to, stays = min(
                    (cost + (price if inside else behind)[to], to, inside)
                    for _, cost, to, inside in arcs[last])
                if price[last] < best:
                    price[last] = best      # contraction
                    if len(path) > 1:
                        path.pop()
                elif stays:
                    path.append(to)         # extension
                else:
                    break                   # what lies behind is final
            for state in path:
                final[state] = True
        for state in range(4):
            letters[4 * i + state] = min(
                letter for letter, cost, to, inside in arcs[state]
                if price[state] == cost + (price if inside else behind)[to])
        behind = price
    out, i, state = [], 0, START
    while letter := letters[4 * i + state]:
        out.append(letter)
        state, i = _after(chr(letter), rows[i] if i < n else "", state), i + (letter != ord("I"))
    return bytes(out).decode(), behind[START]


def _arcs(row: str | None, state: int) -> list[tuple[int, int, int, bool]]:
    """(letter, cost, next state, whether the row stays ahead); letter 0 leads to the end."""
    out = [(ord("I"), INSERT, NEXT[state], True)]
    if row is None:
        if state in (START, ASSISTANT):
            out.append((0, 0, state, False))
        return out
    out.append((ord("D"), DELETE, state, False))
    if row not in MUST_GO:
        cut = CUT if row.isupper() else 0
        out.append((ord("R"), REROLE + cut, NEXT[state], False))
        kept = _kept(row, state)
        if kept is not None:
            out.append((ord("K"), KEEP + cut, kept, False))
    return out


def _kept(row: str, state: int) -> int | None:
    to = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(row.lower())
    return to if to == NEXT[state] or to == SYSTEM and state == START else None


def _after(letter: str, row: str, state: int) -> int:
    return state if letter == "D" else _kept(row, state) if letter == "K" else NEXT[state]


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as a checksum of ``conv_id:turn`` damages them: dropped, emptied, cut, repeated, reroled."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        said("role").alias("role"), said("text").alias("text"), code.alias("_code")).where("_code <> 0")
    text = F.when(F.col("_code") == 1, "").when(
        F.col("_code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def _digest() -> Column:
    return F.sha2(F.encode("text", "UTF-8"), 256)


def judged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, pos, initial, fault`` of each of ``rows(conv_id, turn, role, text)``, without texts."""
    ending = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    facts = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), (ending == "").alias("blank"),
        (~ending.isin(".", "!", "?")).alias("truncated"))
    order = ["turn", "role", "digest"]
    facts = saved(facts.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    placed = saved(before(facts, ["conv_id"], "part", [F.col(c) for c in order], F.lit(1), "pos"), "placed")
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("_first")).select(
        F.col("conv_id").alias("_conv"), "_first")
    new = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("pos") == F.col("_first"))
    return placed.join(firsts, new, "left").select(
        "conv_id", "turn", "pos", F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("blank"), "blank").when(F.col("_first").isNull(), "duplicate").when(
            F.col("truncated"), "truncated").alias("fault"))


def _letter() -> Column:
    where = F.when(F.col("initial").isin("s", "u", "a"), F.instr(F.lit(INITIALS), F.col("initial"))).otherwise(4)

    def of(letters: str) -> Column:
        return F.substring(F.lit(letters), where, F.lit(1))

    return F.when(F.col("fault").isin("blank", "duplicate"), of(MUST_GO)).when(
        F.col("fault") == "truncated", of(INITIALS.upper())).otherwise(of(INITIALS))


def plan(facts: DataFrame) -> DataFrame:
    """``conv_id``, faults, ``illegal``, ``cost`` and ``audit`` of each conversation that has rows."""
    pieces = facts.select(
        "conv_id", "fault", F.floor(F.col("pos") / PIECE).alias("piece"),
        F.struct("pos", _letter().alias("letter")).alias("_row")).groupBy("conv_id", "piece").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_row")), lambda x: x["letter"]), "").alias("rows"),
        *[F.count_if(F.col("fault") == k).alias(k) for k in ("blank", "duplicate", "truncated")])
    whole = pieces.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("piece", "rows"))), lambda x: x["rows"]).alias("rows"),
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated")])

    def solve(batches):
        known: dict[str, tuple[str, int]] = {}
        initial = dict(zip(MUST_GO + INITIALS + INITIALS.upper(), 3 * INITIALS))
        for batch in batches:
            illegal, cost, audit = [], [], []
            for parts in batch.column("rows").to_pylist():
                rows = "".join(parts)
                if rows not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    found = edits(rows)
                    if len(rows) <= 64:
                        known[rows] = found
                else:
                    found = known[rows]
                audit.append(found[0])
                cost.append(found[1])
                said = [initial[x] for x in rows]
                illegal.append(sum(a + b not in LEGAL for a, b in zip(said, said[1:])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("conv_id", "blank", "duplicate", "truncated")),
                 pa.array(illegal, pa.int64()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return whole.mapInArrow(
        solve, "conv_id bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def _edited(batches):
    """(conv_id, role, text) of the repaired rows, conversation by conversation; role None ends one."""
    conv, audit, at, state, open_ = None, "", 0, START, False

    def inserts():
        nonlocal at, state
        while audit[at:at + 1] == "I":
            at, state = at + 1, NEXT[state]
            yield conv, ROLES[state], ""

    for batch in batches:
        for id_, letters, role, text in zip(*(
                batch.column(k).to_pylist() for k in ("conv_id", "audit", "role", "text"))):
            if letters is not None:
                if open_:
                    yield from inserts()
                    yield conv, None, None
                conv, audit, at, state, open_ = id_, letters, 0, START, True
                continue
            yield from inserts()
            letter, at = audit[at], at + 1
            state = _after(letter, role[:1], state)
            if letter != "D":
                yield conv, role if letter == "K" else ROLES[state], text
    if open_:
        yield from inserts()
        yield conv, None, None


def _ordered(rows: DataFrame, plans: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    heads = plans.select(
        "conv_id", "audit", F.lit(None).cast("bigint").alias("turn"), none.alias("role"), none.alias("text"))
    rows = rows.select("conv_id", none.alias("audit"), "turn", "role", "text")
    order = ["conv_id", F.col("audit").isNull(), "turn", "role", _digest()]
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "audit", "role", "text")


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id``, ``at`` (from 0), ``role`` and ``text``."""
    def lines(batches):
        out, at = [], 0
        for conv, role, text in _edited(batches):
            if role is None:
                at = 0
                continue
            out.append((conv, at, role, text))
            at += 1
            if len(out) == 1024:
                yield made(out)
                out = []
        yield made(out)

    def made(out):
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["conv_id", "at", "role", "text"])

    return _ordered(rows, plans).mapInArrow(lines, "conv_id bigint, at bigint, role string, text string")


def digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation: ``role:text`` of its rows, parted by newlines."""
    def hashed(batches):
        out, digest, first = [], hashlib.sha256(), True
        for conv, role, text in _edited(batches):
            if role is not None:
                digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
                first = False
                continue
            out.append((conv, digest.hexdigest()))
            digest, first = hashlib.sha256(), True
            if len(out) == 4096:
                yield made(out)
                out = []
        yield made(out)

    def made(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())],
            ["conv_id", "repaired_sha256"])

    return _ordered(rows, plans).mapInArrow(hashed, "conv_id bigint, repaired_sha256 string")


def _gaps(facts: DataFrame) -> DataFrame:
    """Turns that a conversation lacks between its first and last; null where that is no long."""
    wide = [F.col(c).cast("decimal(38,0)") for c in ("_last", "_first", "_n")]
    return facts.groupBy("conv_id", "turn").agg(F.count("*").alias("_c")).groupBy("conv_id").agg(
        F.max("turn").alias("_last"), F.min("turn").alias("_first"), F.count("turn").alias("_n")).select(
        F.col("conv_id").alias("_g"),
        F.coalesce(wide[0] - wide[1] + 1 - wide[2], F.lit(0)).try_cast("bigint").alias("gaps"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage, faults and cheapest repair of every conversation of ``conversations``.

    A conversation that lost all rows has zeros, no edits and the hash of an empty text.
    """
    rows = damage(conversations)
    facts = saved(judged(rows), "facts")
    plans = saved(plan(facts), "plans")
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    hashes = digests(rows, plans).select(F.col("conv_id").alias("_h"), "repaired_sha256")
    plans = plans.withColumnRenamed("conv_id", "_p")
    found = ids.join(plans, F.col("conv_id").eqNullSafe(F.col("_p")), "left").join(
        _gaps(facts), F.col("conv_id").eqNullSafe(F.col("_g")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("_h")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.when(F.col("_p").isNull() & F.col("audit").isNull(), F.lit(0)).otherwise(F.col(c)).alias(c)
                     for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
