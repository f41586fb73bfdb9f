import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from helpers import rows

from cityviews.llm import queries
from cityviews.llm.conversation_repair import _edited, edits, damage, plan, judged, repair_damaged, repaired

SF = "/root/testdata/sf0.001"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(seq):
    """(cost, audit) of ``seq`` of (initial, fault): all ways kept by state, least first."""
    ways = {"": (0, "")}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                ways[to] = min(ways.get(to, (10 ** 9, "")), (cost + 2, audit + "I"))
        return ways

    ways = inserted(ways)
    for initial, fault in seq:
        new = {}

        def offer(state, cost, audit):
            new[state] = min(new.get(state, (10 ** 9, "")), (cost, audit))

        for state, (cost, audit) in ways.items():
            offer(state, cost + 3, audit + "D")
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                need = "a" if state == "u" else "u"
                offer(need, more + 2, audit + "R")
                if initial == need or initial == "s" and state == "":
                    offer(initial, more, audit + "K")
        ways = inserted(new)
    return min(ways[s] for s in ("", "a") if s in ways)


def brute(table):
    by_conv, out = defaultdict(list), []
    for conv, turn, role, text, *_ in table:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, given in by_conv.items():
        kept = []
        for turn, role, text in given:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            code = zlib.crc32(key.encode()) % 20
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            kept += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, seq = set(), []
        for _, role, text in kept:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else \
                "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            seq.append((role[:1], fault))
        cost, audit = cheapest(seq)
        lines, state, at = [], "", 0
        for letter in audit:
            need = "a" if state == "u" else "u"
            if letter == "I":
                lines.append({"a": "assistant", "u": "user"}[need] + ":")
                state = need
                continue
            _, role, text = kept[at]
            at += 1
            if letter == "R":
                role = {"a": "assistant", "u": "user"}[need]
            if letter != "D":
                lines.append(f"{role}:{text}")
                state = role[:1]
        turns = [r[0] for r in kept if r[0] is not None]
        faults = [f for _, f in seq]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(seq, seq[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


#: A conversation that keeps both its rows, with more turns between them than a long can count.
WIDE = next(c for c in range(902, 2000) if all(
    zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in (-2 ** 63, 2 ** 63 - 1)))
KINDS = "conv_id bigint, turn bigint, role string, text string, pos bigint, part int, digest string, audit string"


def awkward():
    pick = random.Random(5)
    texts = [None, "", " \t", "Yes.", "Yes. ", "No", "Why?\n", "Ünï 🎈!", "a" * 40_000 + ".", "Same text.", "…"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
    out = []
    for conv in range(150):
        for turn in range(pick.randrange(1, 9)):
            out.append((conv, pick.choice([turn, turn, turn, None, turn * 3]), pick.choice(roles), pick.choice(texts)))
    out += [(None, t, "user", "Hello.") for t in range(4)] + [(900, None, None, None)] * 3
    out += [(901, t, pick.choice(roles), pick.choice(texts[3:])) for t in range(1500)]  # a long one
    out += [(WIDE, -2 ** 63, "user", "a."), (WIDE, 2 ** 63 - 1, "assistant", "b.")]
    return [(*r, 1, 2, "x", "y") for r in out]


def test_equals_plain_python_on_awkward_rows(spark):
    table = awkward()
    found = rows(repair_damaged(spark.createDataFrame(table, KINDS)))
    expected = brute(table)
    expected = [(*r[:1], None if r[0] == WIDE else r[1], *r[2:]) for r in expected]
    assert found == expected


def test_query_equals_plain_python(spark):
    found = rows(queries.QUERIES["op11_conversation_repair"](spark, SF))
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert found == brute(table)


def test_empty_table_and_lost_conversations(spark):
    assert rows(repair_damaged(spark.createDataFrame([], KINDS))) == []
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:7".encode()) % 20 == 0)
    found = rows(repair_damaged(spark.createDataFrame([(lost, 7, "user", "x.", 0, 0, "", "")], KINDS)))
    assert found == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("seed", range(40))
def test_auction_finds_the_least_of_the_cheapest(seed):
    pick = random.Random(seed)
    letters = "suaxSUAX0123" if seed % 2 else "uuuaS1"
    row = "".join(pick.choice(letters) for _ in range(pick.randrange(0, 40)))
    seq = [("suaxsuaxsuax"["suaxSUAX0123".index(x)],
            "truncated" if x.isupper() else "blank" if x.isdigit() else None) for x in row]
    cost, audit = cheapest(seq)
    assert edits(row) == (audit, cost)


def test_long_conversations_take_steps_in_proportion():
    audit, cost = edits("u" * 20_000)
    assert len(audit) >= 20_000 and cost == 20_000  # every other user becomes an assistant


def test_repaired_rows_follow_the_audit(spark):
    table = awkward()
    kept = damage(spark.createDataFrame(table, KINDS))
    found = repaired(kept, plan(judged(kept))).collect()
    by_conv = defaultdict(list)
    for r in sorted(found, key=lambda r: (str(r.conv_id), r["at"])):
        by_conv[r.conv_id].append(r)
    digests = {r[0]: r[-1] for r in brute(table)}
    for conv, lines in by_conv.items():
        assert [r["at"] for r in lines] == list(range(len(lines)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in lines))
        text = "\n".join(f"{r.role}:{r.text}" for r in lines)
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv]
