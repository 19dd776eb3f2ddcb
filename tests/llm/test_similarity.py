"""The two similarity joins and substring dedup against brute force over all pairs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_cases import docs, edited, make_docs, rows_of, sentence, texts  # noqa: F401
from tidemark.llm import line_dedup, ngram_join, shingles, sketch, substring_dedup, tokens

LOWER = {c: c + 32 for c in range(65, 91)}
LAST = (1 << 63) - 1


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingle_set(text, k=5):
    w = words_of((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def linked(a, b, percent):
    common = len(a & b)
    return common and 100 * common >= percent * (len(a) + len(b) - common)


def components(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                parent[find(i)] = find(j)
    best = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        best[find(i)].append(LAST if d is None else d)
    out = Counter()
    for i, (d, _) in enumerate(rows):
        c = min(best[find(i)])
        out[d, len(sets[i]), None if c == LAST else c] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"frequent_bits": 2}, {"star_rounds": 0, "frequent_bits": 1}, {"percent": 50}])
def test_components(docs, rows_of, options):
    found = ngram_join.ngram_components(docs, **options).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == components(rows_of, options.get("percent", 80))


def test_one_of_each(docs, rows_of):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = defaultdict(set)
    for (d, n, c), _ in components(rows_of, 80).items():
        if n:
            groups[LAST if c is None else c].add(LAST if d is None else d)
    stay = Counter(LAST if r["doc_id"] is None else r["doc_id"] for r in kept.collect() if shingle_set(r["text"]))
    assert stay == Counter(dict.fromkeys(groups, 1))
    assert {r["doc_id"] for r in kept.collect()} >= {d for d, t in rows_of if d is not None and not shingle_set(t)}


@pytest.mark.parametrize("frequent", [0, 3, 40])
def test_combination_prefixes_share_a_signature(frequent):
    """Random pairs of sets at or above the threshold always have a signature in common."""
    rng = np.random.default_rng(3)
    make = ngram_join.combination_prefixes(80, frequent)
    for n in (1, 2, 5, 9, 30, 200, 900):
        for _ in range(30):
            universe = np.unique(rng.integers(1, 1 << 57, 3 * n + 8, dtype=np.uint64))
            rng.shuffle(universe)
            common = n - int(rng.integers(0, n // 9 + 1))
            a = np.concatenate((universe[:common], universe[common:n]))
            extra = int(rng.integers(0, n // 9 + 1))
            b = np.concatenate((universe[:common], universe[n : n + extra]))
            if 100 * common < 80 * (len(a) + len(b) - common):
                continue
            bits = {int(t): np.uint64(t % np.uint64(50)) << np.uint64(58) for t in universe}
            both = [np.sort(np.array([t | bits[int(t)] for t in s], np.uint64)) for s in (a, b)]
            sizes = np.array([len(a), len(b)])
            unit, sig, *_ = make(np.concatenate(both), sizes, np.array([0, len(a), len(a) + len(b)]))
            assert set(sig[unit == 0]) & set(sig[unit == 1])


def grouped(make_docs, kind):
    """Texts that share a passage and are not similar, or near copies around the threshold."""
    rng = random.Random(11)
    if kind == "passage":
        passage = sentence(rng, 20)
        return make_docs([f"{sentence(rng, rng.randint(4, 9))} {passage}" for _ in range(160)] + [passage] * 3)
    base = sentence(rng, 120)
    return make_docs([edited(rng, base, rng.randint(0, 6)) for _ in range(140)])


@pytest.mark.parametrize("kind", ["passage", "copies"])
@pytest.mark.parametrize("star_rounds", [0, 3])
def test_large_groups(make_docs, kind, star_rounds):
    """Many different sets under one signature, similar or not, against all pairs."""
    docs = grouped(make_docs, kind)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = ngram_join.ngram_components(docs, star_rounds=star_rounds).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == components(rows, 80)


def line_report(rows, percent=80):
    order = sorted({(LAST if d is None else d, t or "") for d, t in rows})
    lines, gone = [], defaultdict(set)
    hashes = defaultdict(list)
    for d, t in order:
        hashes[d].append(t)
    assert all(len(x) == 1 for x in hashes.values() if x is not hashes.get(LAST))
    for d, t in order:
        for i, line in enumerate(t.split("\n")):
            s = shingle_set(line)
            if s:
                if any(s == x or linked(s, x, percent) for x in lines):
                    gone[d, t].add(i)
                lines.append(s)
    return gone


@pytest.mark.parametrize("star_rounds", [0, 2])
def test_lines(docs, rows_of, star_rounds):
    gone = line_report(rows_of)
    assert sum(map(len, gone.values())) > 20
    expected = Counter()
    for d, t in rows_of:
        drop = gone[LAST if d is None else d, t or ""]
        text = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop)
        expected[d, text, 0 if t is None else t.count("\n") + 1, len(drop)] += 1
    found = line_dedup.dedup_lines(docs, star_rounds=star_rounds)
    assert found.columns == [*docs.columns, "__n_lines", "__n_removed"]
    assert Counter((r["doc_id"], r["text"], r["__n_lines"], r["__n_removed"]) for r in found.collect()) == expected


def test_short_lines(make_docs):
    """Lines of one to four words go if the same words stood on an earlier line; blank lines stay."""
    docs = make_docs(["Les.\n\nErheed. Titionly.", "one two three four\nles.\n \n", "Les. Les.\nerheed.  titionly.\nOne two three FOUR", "\n", "Les."])
    found = {r["doc_id"]: (r["text"], r["__n_lines"], r["__n_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {
        0: ("Les.\n\nErheed. Titionly.", 3, 0),
        1: ("one two three four\n \n", 4, 1),
        2: ("Les. Les.", 3, 2),
        3: ("\n", 2, 0),
        4: ("", 1, 1),
    }


@pytest.mark.parametrize("star_rounds", [0, 2])
def test_lines_of_all_lengths(docs, rows_of, star_rounds):
    """Against all pairs of lines; only blank ones are left out."""
    order = sorted({(LAST if d is None else d, t or "") for d, t in rows_of})
    seen, gone = [], defaultdict(int)
    for d, t in order:
        for line in t.split("\n"):
            s = shingle_set(line)
            gone[d, t] += any(linked(s, x, 80) for x in seen) if s else 0
            seen.append(s)
    found = line_dedup.dedup_lines(docs, star_rounds=star_rounds).collect()
    assert Counter((r["doc_id"], r["__n_removed"]) for r in found) == Counter((d, gone[LAST if d is None else d, t or ""]) for d, t in rows_of)


def near_lines(make_docs):
    rng = random.Random(8)
    base = sentence(rng, 80)
    return make_docs([edited(rng, base, n % 3) for n in range(60)])


def test_near_lines(make_docs):
    docs = near_lines(make_docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    gone = line_report(rows)
    found = {r["doc_id"]: r["__n_removed"] for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {d: len(gone[d, t]) for d, t in rows}


def substring_report(rows, size):
    order = sorted({(LAST if d is None else d, t or "") for d, t in rows})
    seen, cover = set(), {}
    for d, t in order:
        w = words_of(t)
        gone = set()
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        cover[d, t] = gone
    out = Counter()
    for d, t in rows:
        w, gone = words_of(t or ""), cover[LAST if d is None else d, t or ""]
        out[d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("size", "options"), [(20, {}), (20, {"slice_bytes": 300}), (5, {"most_bits": 18}), (3, {"slice_bytes": 1})])
def test_substrings(docs, rows_of, size, options):
    found = substring_dedup.dedup_substrings(docs, size, **options).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == substring_report(rows_of, size)


def test_periodic_text(make_docs):
    """A window that repeats inside one document, a few words later."""
    docs = make_docs(["a b c " * 8, "x y " * 11 + "z", "q"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = substring_dedup.dedup_substrings(docs, 20).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == substring_report(rows, 20)


def test_empty_tables(make_docs):
    none = make_docs([])
    assert ngram_join.ngram_components(none).count() == 0
    assert ngram_join.one_of_each(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert substring_dedup.dedup_substrings(none).count() == 0
    blank = make_docs([None, ""])
    assert ngram_join.one_of_each(blank).count() == 2
    assert [r["__n_removed"] for r in line_dedup.dedup_lines(blank).collect()] == [0, 0]


def test_words_are_hashed_alike_wherever_slices_end():
    rng = random.Random(2)
    raw = (" ".join(sentence(rng, 3) for _ in range(200)) + "\t\x0b" + "y" * 500).encode()
    whole, places = tokens.split_hashes(raw)
    assert len(whole) == len(raw.split())
    for size in (7, 64, 501):
        again, at = tokens.split_hashes(raw, slice_bytes=size)
        assert (again == whole).all() and (at == places).all()


def test_sketch_never_underestimates(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 3000, 20_000, dtype=np.uint64)
    bits, depth = 18, 2
    parts = spark.createDataFrame([(i,) for i in range(10)], "i long").repartition(5)

    def work(batches):
        for batch in batches:
            for i in batch.column("i").to_pylist():
                yield from sketch.sketch_parts(iter([keys[i * 2000 : (i + 1) * 2000]]), bits, depth, held=700)

    found = sketch.repeated_cells(parts.mapInArrow(work, sketch.PART_TYPE), bits, depth)
    values, counts = np.unique(keys, return_counts=True)
    assert sketch.met_twice(values[counts > 1], found, bits).all()
    assert sketch.met_twice(np.arange(10**6, 10**6 + 5000, dtype=np.uint64), found, bits).mean() < 0.01


def test_prefix_length_is_exact():
    for percent in (50, 80, 95):
        for n in range(1, 60):
            least = next(o for o in range(n + 1) if 100 * o >= percent * n)
            assert shingles.prefix_length(np.array([n]), percent)[0] == n - least + 1


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_parities_lose_nothing(spark, percent):
    """Similar sets of any size pass; bits apart never exceed tokens apart; most pairs of different sets fail."""
    draw = np.random.default_rng(percent)
    texts, pairs = [], []
    for size in (1, 2, 5, 30, 140, 400, 3000):
        for kept in (1.0, 0.97, 0.9, 0.82, 0.6, 0.0):
            words = [f"w{x}" for x in draw.integers(0, 10**9, size)]
            other = [w if draw.random() < kept else f"x{draw.integers(0, 10**9)}" for w in words]
            pairs.append((len(texts), len(texts) + 1))
            texts += [" ".join(words).encode(), " ".join(other).encode()]
    texts.append(b"")
    units = shingles.units_of(texts, 1, False, 1)
    sets = [set(x.tolist()) for x in np.split(units.tokens, units.offsets[1:-1])]
    marks = shingles.parities(units, 4).view(np.int64)
    assert not marks[-1].any()
    rows = [(a, b, len(sets[a]), marks[a].tolist(), len(sets[b]), marks[b].tolist()) for a, b in pairs]
    frame = spark.createDataFrame(rows, "a int, b int, n_a int, marks_a array<long>, n_b int, marks_b array<long>")
    passed = {(r.a, r.b) for r in frame.filter(shingles.few_apart(percent, "n_a", "marks_a", "n_b", "marks_b", 4)).collect()}
    similar = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert similar and similar <= passed
    assert len(passed) < len(pairs)
    for a, b in pairs:
        bits = sum(int(x).bit_count() for x in (marks[a] ^ marks[b]).view(np.uint64))
        assert bits <= len(sets[a] ^ sets[b])
