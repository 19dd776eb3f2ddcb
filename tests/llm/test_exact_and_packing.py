"""Exact dedup, packing and shards against brute force, with nulls, ties, repeated rows and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import docs, make_docs, rows_of, texts  # noqa: F401

from tidemark.llm import exact_dedup, packing, sharding
from tidemark.llm.queries import tokenizer_path


def key(t):
    return t or ""


@pytest.mark.parametrize(("keep", "rows_per_run", "fan_in"), [("largest", 3, 2), ("smallest", 3, 4), ("largest", 1000, 64)])
def test_exact_groups(docs, rows_of, keep, rows_per_run, fan_in):
    groups = defaultdict(list)
    for i, t in rows_of:
        groups[key(t)].append(i)
    found = exact_dedup.exact_duplicates(docs, keep=keep, rows_per_run=rows_per_run, fan_in=fan_in).collect()
    assert len(found) == len(rows_of)
    kept = Counter()
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in found:
        t = by_hash[r["text_sha256"]]
        ids = [i for i in groups[t] if i is not None]
        assert r["keep_id"] == (max if keep == "largest" else min)(ids, default=None)
        assert r["group_size"] == len(groups[t])
        if r["kept"]:
            kept[t] += 1
            assert r["doc_id"] == r["keep_id"]
    assert kept == Counter(dict.fromkeys(groups, 1))


def test_exact_uses_no_python(docs):
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_exact_keep_is_checked(docs):
    with pytest.raises(ValueError):
        exact_dedup.exact_duplicates(docs, keep="first")


def test_empty_tables(make_docs):
    none = make_docs([])
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert packing.pack_documents(none, tokenizer_path()).count() == 0
    assert sharding.shard_documents(none).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_shortest_pack_first_holds_everything(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 2048])
    histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 3000)))
    packs = packing.shortest_pack_first(dict(histogram), capacity)
    used = Counter()
    for count, pattern in packs:
        assert count > 0 and sum(pattern) <= capacity
        for length in pattern:
            used[length] += count
    assert used == histogram
    total = sum(n * k for n, k in histogram.items())
    sequences = sum(count for count, _ in packs)
    # two packs that fit together are never left open beside each other by the items that came last
    assert sequences <= max(1, 2 * -(-total // capacity))


def test_pack_lengths_are_checked():
    with pytest.raises(ValueError):
        packing.shortest_pack_first({9: 1}, 8)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_round_trip(docs, rows_of, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = Counter()
    for i, t in rows_of:
        ids = [*tokenizer.encode(key(t), add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            expected[i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    found = packing.pack_documents(docs, tokenizer_path(), capacity).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity


def test_word_dictionary_is_exact():
    """Marks, digits, contractions, special tokens and other scripts, with a full dictionary and an empty one."""
    texts = [
        "Don't stop.,; that*** it's 12.5% <|endoftext|> x<|startoftext|>y",
        "WORD! word!! ''s 's, a's. é. É, ﬁ ﬁ. İstanbul ΣΑΣ Σ. 漢字。  nb em",
        "é café. ... !!! a.b.c a,b x\x0by\x1cz �",
        "",
        "rock'n'roll they'll, we've. I'm; you're: he'd",
    ]
    for max_words in (0, 10_000):
        encoder = packing.WordEncoder(tokenizer_path(), max_words)
        for _ in range(2):
            found = list(encoder.encode([t.encode() for t in texts]))
            for t, ids in zip(texts, found, strict=True):
                assert ids.tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_shards(docs, rows_of):
    for n_shards in (1, 3, 24, 200):
        found = sharding.shard_documents(docs, n_shards).collect()
        expected = Counter((i, len(key(t).encode()) + 8, zlib.crc32(key(t).encode())) for i, t in rows_of)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
        slots = defaultdict(list)
        for r in found:
            assert 0 <= r["shard"] < n_shards and r["law"] == "rows" and r["grown_shard"] is None
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots[s]) for s in range(n_shards)]
        assert max(sizes) - min(sizes) <= 1


def test_equal_texts_share_shards(make_docs):
    """Groups that fit stay together; one of half of all rows fills as few shards as it can."""
    rng = random.Random(4)
    texts = [f"group {g}" for g in range(30) for _ in range(4)] + ["hot"] * 300 + [f"single {i}" for i in range(180)]
    rng.shuffle(texts)
    found = sharding.shard_documents(make_docs(texts), 10).collect()
    shards = defaultdict(set)
    for r in found:
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(shards[f"group {g}"]) > 1 for g in range(30)) <= 6
    assert len(shards["hot"]) <= 8
