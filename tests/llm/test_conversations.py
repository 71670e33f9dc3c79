"""Conversation repair against a search over edit strings, and odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tieout.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, fate int, mark string, salt long, is_open string"
NEXT, ROLE = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}


def cheapest(faults, initials):
    """(cost, audit) by relaxing (cost, edit string) over all states, row by row."""

    def close(best):
        again = True
        while again:
            again = False
            for s, (c, a) in list(best.items()):
                n, v = NEXT[s], (c + 5, a + "I")
                if n not in best or v < best[n]:
                    best[n], again = v, True
        return best

    best = close({"": (0, "")})
    for fault, initial in zip(faults, initials, strict=True):
        new = {}
        for s, (c, a) in best.items():
            steps = [("D", 2, s)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                steps.append(("R", 1 + more, NEXT[s]))
                if initial == NEXT[s] or (initial == "s" and s == ""):
                    steps.append(("K", more, initial))
            for e, cost, t in steps:
                if t not in new or (c + cost, a + e) < new[t]:
                    new[t] = (c + cost, a + e)
        best = close(new)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    chats, out = defaultdict(list), {}
    for conv, turn, role, text, *_ in rows:
        chats[conv].append((turn, role, text))
    for conv, kept in chats.items():
        after = []
        for turn, role, text in kept:
            role, text = (" " if x is None else x for x in (role, text))
            key = ":".join(" " if x is None else str(x) for x in (conv, turn))
            fate = zlib.crc32(key.encode()) % 20
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            if fate:
                after += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faults = set(), []
        for _, role, text in after:
            end = re.sub("[\x20\x09-\x0d]+$", "", text)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[1][:1] for r in after]
        cost, audit = cheapest(faults, initials)
        state, at, lines = "", 0, []
        for e in audit:
            if e == "I":
                state = NEXT[state]
                lines.append(ROLE[state] + ":")
                continue
            _, role, text = after[at]
            at += 1
            if e != "D":
                state = initials[at - 1] if e == "K" else NEXT[state]
                lines.append((role if e == "K" else ROLE[state]) + ":" + text)
        turns = {r[0] for r in after if r[0] is not None}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def chats():
    rng = random.Random(4)
    texts = ["Fine.", "Is it?\n", "cut", " \t", "", "x" * 50 + "!", "Ünïcode …", None, "same.", "same."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(150)]:
        for k in range(rng.randrange(1, 10)):
            rows.append((conv, rng.choice([k, k, k, 3 * k, None]), ("user", "assistant")[k % 2] if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts[:6]) + str(k) if rng.random() < 0.7 else rng.choice(texts)))
    # rows of one turn keep to one text: those of one role stand by a hash of it
    once = {}
    rows = [(c, t, r, once.setdefault((c, t), x)) for c, t, r, x in rows]
    for k in range(7_000):  # a third of the rows and more, in many segments and ranges
        rows.append((1000, k - 9, ("user", "assistant")[k % 2] if k % 11 else "system", f"turn {k % 3000}" + ".?! "[k % 4]))
    rows += [(1001, 5, "user", "copy.")] * 5_000
    rows += [(1002, k, "user", "long " * 300_000 + ".") for k in range(6)]
    return [(*r, 1, "m", None, "open") for r in rows]


def by_id(frame):
    got = frame.collect()
    out = {r[0]: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def test_auction_finds_the_least_audit():
    letters = "DsuaSUA-_"
    fault = lambda c: "blank" if c == "D" else "truncated" if c.isupper() or c == "_" else ""
    rng = random.Random(1)
    some = ["".join(c) for n in range(4) for c in itertools.product(letters, repeat=n)]
    some += ["".join(rng.choice(letters + "uaua") for _ in range(rng.choice([6, 30, 200]))) for _ in range(300)]
    for codes in some:
        assert C.repair(codes) == cheapest([fault(c) for c in codes], [c.lower() if c in "suaSUA" else "-" for c in codes]), codes


def test_segments_cost_as_much_as_the_whole():
    rng = random.Random(2)
    for _ in range(200):
        codes = "".join(rng.choice("DsuaSUA-_uaua") for _ in range(12))
        k = rng.randrange(1, 12)
        left, right = C.through(codes[:k]), C.through(codes[k:])
        whole = min(left[e] + right[4 * e + f] + C.ENDS[f] for e in range(4) for f in range(4))
        assert whole == C.repair(codes)[0]


def test_repair_of_all_conversations(spark):
    rows = chats()
    got = by_id(C.repaired(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    want = expected(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], (conv, [r[:4] for r in rows if r[0] == conv][:12])


def test_nothing_left_and_no_rows(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = by_id(C.repaired(spark.createDataFrame([(dropped, 0, "user", "x.", 0, "", 0, "")], SCHEMA)))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert C.repaired(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert by_id(C.op11_auction_repair(spark, sf)) == expected(rows)
