"""License scan, quality, languages and decontamination against brute force, held-out accuracy and edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import docs, make_docs, rows_of, sentence, texts, word  # noqa: F401
from tidemark.llm import decontamination, language_id, license_scan, quality

LOWER = {c: c + 32 for c in range(65, 91)}


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def license_report(text, threshold):
    w = license_words(text)
    places, labels, best = [], set(), 0.0
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += [(i, label) for i in at]
        if at:
            labels.add(label)
            best = 1.0
    for phrase, label in license_scan.TEMPLATES.items():
        p = phrase.split()
        for start in range(0, len(w), len(p)):
            block = set(w[start : start + 2 * len(p)])
            share = len(block & set(p)) / len(set(p))
            if share >= threshold:
                labels.add(label)
                best = max(best, share)
    at = [i for i, _ in places]
    base = ",".join(sorted({x for _, x in places}))
    return len(w), len(at), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)), round(best, 9)


@pytest.mark.parametrize("threshold", [0.6, 0.85])
def test_licenses(make_docs, threshold):
    rng = random.Random(3)
    pool = [*license_scan.BASE, *license_scan.TEMPLATES]
    texts = [None, "", "...", "MIT", "MIT\nLicense", "cc-by cc by CC_BY", "Apache License, Apache license! the GNU General (Public) License", "mit licenseé"]
    texts += ["cc by " * 500, "gnu general public gnu general public license"]
    for _ in range(120):
        words = [word(rng) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            phrase = rng.choice(pool).split()
            if rng.random() < 0.5:
                phrase = rng.sample(phrase, rng.randint(1, len(phrase)))
            at = rng.randint(0, len(words))
            words[at:at] = phrase
        texts.append(rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in words))
    found = license_scan.scan_licenses(make_docs(texts), threshold=threshold).collect()
    assert len(found) == len(texts)
    for r in found:
        got = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9))
        assert got == license_report(texts[r["doc_id"]], threshold), texts[r["doc_id"]]


def edit_distance_in(pattern, text):
    """Edits from the pattern to its nearest substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        before, row = row, [i] * (len(text) + 1)
        for j, d in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d))
    return min(row)


@pytest.mark.parametrize("seed", range(20))
def test_bit_parallel_distance(seed):
    rng = random.Random(seed)
    pattern = "".join(rng.choice("abcß") for _ in range(rng.randint(1, 90)))
    text = "".join(rng.choice("abcß") for _ in range(rng.randint(0, 120)))
    edits, end = decontamination.Pattern(pattern).best(text)
    assert edits == edit_distance_in(pattern, text)
    assert edit_distance_in(pattern, text[:end]) == edits


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [out[at], "q"], ["z"]])
    return "".join(out)


@pytest.mark.parametrize("block_chars", [2_000_000, 300])
def test_benchmark_matches(spark, make_docs, block_chars):
    rng = random.Random(6)
    items = [(i, sentence(rng, rng.randint(4, 30))) for i in range(12)] + [(90, None), (91, ""), (92, "  "), (None, "lost"), (5, "zzzz")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [None, "", "short"]
    for _ in range(40):
        i, item = items[rng.randrange(12)]
        middle = changed(rng, item, rng.randint(0, 6))
        texts.append(f"{sentence(rng, 10)}\n{middle.upper()}   {sentence(rng, 10)}")
    texts += [items[0][1] * 30, sentence(rng, 400)]
    docs = make_docs(texts, clash=False)
    expected = set()
    by_id = {i: decontamination.normalise(t) for i, t in sorted((i, t) for i, t in items if None not in (i, t))[::-1]}
    for d, t in enumerate(texts):
        for i, item in by_id.items():
            budget = int(len(item) * 0.05)
            if item:
                edits = edit_distance_in(item, decontamination.normalise(t or ""))
                if edits <= budget:
                    expected.add((d, i, edits))
    found = decontamination.benchmark_matches(docs, benchmark, block_chars=block_chars).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in found} == expected
    assert len(expected) > 15
    clean = {r["doc_id"] for r in decontamination.decontaminate(docs, benchmark, block_chars=block_chars).collect()}
    assert clean == set(range(len(texts))) - {d for d, _, _ in expected}


def test_nothing_to_match(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs(["a b c", None])
    assert decontamination.benchmark_matches(docs, none).count() == 0
    assert decontamination.decontaminate(docs, none).count() == 2
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.benchmark_matches(make_docs([]), some).count() == 0


def quality_table(spark, n=500):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = sentence(rng, rng.randint(5, 120))
        rows.append((i, text if good else text.replace(" ", "*** "), None))
        marks.append((i, int(good), 0))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(4),
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int"),
    )


def test_quality_held_out(spark, make_docs):
    docs, labels = quality_table(spark)
    net = quality.train(docs, labels)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    found = quality.quality_scores(docs, net).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    kept = quality.quality_filter(docs, net)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found if r["predicted"]}
    odd = make_docs([None, "", "x", "x", sentence(random.Random(1), 3000)], [1, None, 3, 3, 4])
    scores = quality.quality_scores(odd, net).collect()
    assert len(scores) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] == 3}) == 1
    assert quality.quality_scores(make_docs([]), net).count() == 0


def test_quality_without_labels(spark, make_docs):
    docs, labels = quality_table(spark, 20)
    net = quality.train(docs, labels.limit(0))
    assert {r["predicted"] for r in quality.quality_scores(docs, net).collect()} == {1}


def test_slices_score_like_the_whole():
    net = quality.ByteNet.new()
    text = sentence(random.Random(5), 4000).encode()
    assert net.scores([text], slice_chunks=50) == pytest.approx(net.scores([text], slice_chunks=10**9), abs=1e-5)
    alone = [net.scores([t])[0] for t in (b"", b"abc", text)]
    assert net.scores([b"", b"abc", text]) == pytest.approx(alone, abs=1e-5)


LANGS = {"aa": "ka lo mi ne ru ta".split(), "bb": "den gor hum ist jel kur".split(), "ru": "да не при во ста ло".split()}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_languages(spark, make_docs):
    rng = random.Random(2)
    rows = [(i, spoken(rng, lang := rng.choice(list(LANGS)), rng.randint(3, 80)), lang) for i in range(400)]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "x", None)], "doc_id long, text string, lang string").repartition(4)
    model = language_id.train(docs)
    assert model.langs == sorted(LANGS)
    found = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([found[i]["lang_pred"] == lang for i, lang in held]) > 0.97
    mixed = f"{spoken(rng, 'aa', 40)}. {spoken(rng, 'ru', 30)}! {spoken(rng, 'bb', 20)}"
    odd = make_docs([None, "", "12 3!", mixed, mixed, spoken(rng, "bb", 5000)], [1, 2, 3, 4, 4, None])
    results = language_id.identify(odd, model).collect()
    by_id = {r["doc_id"]: r for r in results}
    assert len(results) == 6
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and by_id[i]["spans"] == [] for i in (1, 2, 3))
    assert [s["lang"] for s in by_id[4]["spans"]] == ["aa", "ru", "bb"]
    assert [s["first_word"] for s in by_id[4]["spans"]] == [0, 40, 70]
    assert by_id[4]["lang_pred"] == "aa" and 0 < by_id[4]["score"] < 1
    assert by_id[None]["lang_pred"] == "bb"
    assert language_id.identify(make_docs([]), model).count() == 0


def test_no_language_is_known(make_docs):
    model = language_id.train(make_docs([None, None], clash=False))
    assert model.langs == []
    assert {r["lang_pred"] for r in language_id.identify(make_docs(["abc"]), model).collect()} == {"und"}


@pytest.mark.parametrize("seed", range(8))
def test_best_path_is_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 7, 9)
    scores = rng.normal(0, 3, (int(lengths.sum()), 3)).astype(np.float32)
    path, at = language_id.best_path(scores, lengths, 2.0), 0
    for n in lengths:
        own = scores[at : at + n]
        best = max(
            (sum(own[i, p] for i, p in enumerate(labels)) - 2.0 * sum(a != b for a, b in zip(labels, labels[1:], strict=False)) for labels in _all(n)),
            default=0.0,
        )
        mine = path[at : at + n]
        value = sum(own[i, p] for i, p in enumerate(mine)) - 2.0 * sum(a != b for a, b in zip(mine, mine[1:], strict=False))
        assert value == pytest.approx(best, abs=1e-3)
        at += n


def _all(n):
    import itertools

    return itertools.product(range(3), repeat=int(n))


def test_counts_of_rows(docs, rows_of):
    """Every row, repeated or not, has a row in the result."""
    expected = Counter(d for d, _ in rows_of)
    assert Counter(r["doc_id"] for r in license_scan.scan_licenses(docs).collect()) == expected
    assert Counter(r["doc_id"] for r in quality.quality_scores(docs, quality.ByteNet.new()).collect()) == expected
