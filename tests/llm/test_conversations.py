"""Conversation repair against a shortest-path search over all edits, in one segment and in many."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from tidemark.llm import conversation_repair as cr

FORM = re.compile(r"(s?(ua)+)?")
ROLES = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "user", "assistant"]
TEXTS = ["Yes.", "No!", "Really?", "cut off", "cut", " \n", "", None, "Fine. ", "A longer answer that ends.", "And one that does not, end"]


def brute_repair(rows):
    """rows: (role, text, fault); (cost, audit, repaired) by dynamic programming over whole strings of edits."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, r = best(i + 1, state, 0)
            found.append((c + 3, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                initial = role[:1]
                if initial and (initial == step[state] or (state, initial) == ("", "s")):
                    c, a, r = best(i + 1, initial, 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *r)))
                c, a, r = best(i + 1, step[state], 0)
                found.append((c + 2 + extra, "R" + a, ({"u": "user", "a": "assistant"}[step[state]] + ":" + text, *r)))
        if inserted < 3:
            c, a, r = best(i, step[state], inserted + 1)
            found.append((c + 2, "I" + a, ({"u": "user:", "a": "assistant:"}[step[state]], *r)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def brute(rows):
    """Results by conversation of rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            fate = zlib.crc32(name.encode()) % 20
            role, text = role if role is not None else " ", text if text is not None else " "
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            after += [(turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text)] * (2 if fate == 3 else 1)
        after.sort()
        seen, faults = set(), []
        for _, _, role, _, text in after:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for there, t, *_ in after if there]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in after]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = brute_repair(tuple((r[2], r[4], f) for r, f in zip(after, faults)))
        assert FORM.fullmatch("".join(k[0] for k in kept))
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha)
    return out


def made_rows(seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(ROLES), rng.choice(TEXTS)))
    rows += [(100, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(40)]
    rows += [(101, t, rng.choice(ROLES), rng.choice(TEXTS)) for t in range(45)]
    rows += [(102, t // 3, rng.choice(ROLES), rng.choice(TEXTS)) for t in range(30)]
    rows += [(103, None, "user", "Hello."), (103, None, "user", "Hello."), (103, 5, "assistant", "Hi."), (103, 5, "assistant", "Hi.")]
    rows += [(104, 3, "user", "x" * 20_000), (104, 9, "assistant", "y" * 20_000 + ".")]
    rows += [(105, 0, "user", "Same.")] * 50
    dropped = next(c for c in range(200, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "Gone.")]


def as_rows(found):
    return {r[0]: tuple(r[1:]) for r in found.collect()}


@pytest.fixture(scope="module")
def conversations(spark):
    from pyspark.sql import functions as F

    rows = made_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, df.withColumns({c: F.lit("!") for c in ("n", "part", "at", "whole", "costs", "fate", "spread")}).repartition(5)


@pytest.mark.parametrize("options", [{}, {"segment_rows": 4, "fan": 2}, {"segment_rows": 1, "fan": 3}, {"segment_bytes": 40, "fan": 256}])
def test_repair(conversations, options):
    rows, df = conversations
    found = cr.repair_conversations(df, **options)
    assert found.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    expected = brute(rows)
    got = as_rows(found)
    assert found.count() == len(expected)
    assert {c: (got.get(c), e) for c, e in expected.items() if got.get(c) != e} == {}


def test_search_is_the_cheapest_first():
    rng = random.Random(9)
    letters = {cr.START: "x", cr.SYSTEM: "s", cr.USER: "u", cr.ASSISTANT: "a"}
    faults = {cr.SOUND: "", cr.BLANK: "blank", cr.DUPLICATE: "duplicate", cr.TRUNCATED: "truncated"}
    for _ in range(400):
        n = rng.randint(0, 14)
        states = [rng.choice([0, 1, 2, 2, 3, 3]) for _ in range(n)]
        kinds = [rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, edits = cr.EditSearch(states, kinds).best()
        _, state = cr.repaired_rows([letters[s] for s in states], [""] * n, edits)
        expected = brute_repair(tuple((letters[s], "", faults[k]) for s, k in zip(states, kinds)))
        assert (cost, edits + cr.END_EDITS[state]) == expected[:2]


def test_estimate_never_exceeds_the_cost():
    rng = random.Random(10)
    for _ in range(200):
        n = rng.randint(1, 10)
        states, kinds = [rng.randrange(4) for _ in range(n)], [rng.choice([0, 0, 1, 2, 3]) for _ in range(n)]
        for final in (cr.END_COST, *[[0 if s == e else cr.INF for s in range(4)] for e in range(4)]):
            for entry in range(4):
                estimate = cr.EditSearch(states, kinds, final).least(0, entry)
                found = cr.EditSearch(states, kinds, final).best(entry)
                assert estimate <= (found[0] if found else cr.INF)


def test_failed_states_bound_the_work():
    """Without the table, hundreds of misplaced rows would take exponential time."""
    cost, edits = cr.EditSearch([1, 3, 3, 2, 2, 1, 0] * 60, [0, 3, 0, 2, 0, 1, 0] * 60).best()
    assert len(edits) >= 420 and cost > 0


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_conversations(empty).count() == 0
