"""What op 9 compares in pairs at the end, and the passes over words that both similarity joins share."""

import random
import time
from collections import defaultdict
from itertools import combinations

import numpy as np

from tidemark.llm import ngram_join, shingles, tokens


def test_blocks_meet_seldom_and_lose_no_pair(spark):
    rng = random.Random(4)
    # near copies: 120 classes with about 75 of 100 signatures each; and chains, in which few classes share a signature
    rows = [(s, c, s) for c in range(120) for s in range(100) if rng.random() < 0.75]
    rows += [(1000 + c + d, 500 + c, d) for c in range(60) for d in (0, 1)]
    frame = spark.createDataFrame(
        [(s, c, 100, p, 0, c, True) for s, c, p in rows], "sig long, cid long, n int, place int, own int, label long, light boolean"
    )
    before, after = defaultdict(dict), defaultdict(dict)
    for s, c, p in rows:
        before[s][c] = p
    for r in ngram_join.blocks(frame).collect():
        assert r["cid"] not in after[r["block"], r["merged"]] and (r["n"], r["label"], r["light"]) == (100, r["cid"], True)
        after[r["block"], r["merged"]][r["cid"]] = r["place"]

    def pairs(groups):
        return [(a, b) for g in groups.values() for a, b in combinations(sorted(g), 2)]

    assert set(pairs(before)) <= set(pairs(after))
    for s, group in before.items():
        assert any(all(g.get(c, 101) <= p for c, p in group.items()) for g in after.values()), s
    assert len(pairs(after)) * 5 < len(pairs(before))
    assert not ngram_join.blocks(frame.limit(0)).collect()


def test_tokens_of_a_unit_are_in_order():
    rng = np.random.default_rng(3)
    unit = np.sort(rng.integers(0, 50, 5000))
    for drawn, units in ((rng.integers(0, 1 << 63, 5000), 50), (rng.integers(0, 1 << 18, 5000), 50), (rng.integers(0, 9, 5000), 70_000)):
        held = drawn.astype(np.uint64)
        found, plain = shingles.by_unit(held, unit, units), np.lexsort((held, unit))
        assert (held[found] == held[plain]).all() and (unit[found] == unit[plain]).all()


def test_hashes_are_sums_over_words():
    raw = b" ab c\n" + bytes(range(14, 32)) + b"\xff\xfe\x00 z" + b"q" * 300
    base, wrap = tokens._BASE, (1 << 64) - 1
    sums = [sum((b + 1) * pow(base, i, 1 << 64) for i, b in enumerate(w)) + len(w) & wrap for w in raw.split()]
    assert (tokens.split_hashes(raw)[0] == tokens.mix(np.array(sums, np.uint64))).all()


def test_sets_of_lines_cost_less_than_two_plain_sorts():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(20_000)]
    texts = ["\n".join(" ".join(rng.choices(words, k=45)) for _ in range(10)).encode() for _ in range(350)]
    units = shingles.units_of(texts, 5, True, 1)
    mixed = np.random.default_rng(1).permutation(len(units.tokens))
    unit, held = units.unit[np.sort(mixed)], units.tokens[mixed]

    def least(work):
        took = []
        for _ in range(7):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: shingles.units_of(texts, 5, True, 1)) < 1.6 * least(lambda: np.lexsort((held, unit)))
