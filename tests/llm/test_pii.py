"""Personal data: base spans against plain patterns, added spans on planted formats."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import make_docs, sentence  # noqa: F401

from tidemark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def card(rng, sep=" ", valid=True):
    head = "".join(str(rng.randint(0, 9)) for _ in range(15))
    digits = next(head + str(c) for c in range(10) if luhn(head + str(c)) == valid)
    return sep.join(digits[i : i + 4] for i in range(0, 16, 4))


def planted(rng, kind):
    if kind == "email":
        return f"{rng.choice(['ann', 'bo.b', 'c_d+e'])}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        return card(rng, rng.choice(["", " ", "-"]))
    return f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"


def corpus(seed=6, n=260):
    """Texts with one planted span or decoy each, and the spans that are meant."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        kind = list(PLAIN)[i % 4]
        texts.append(f"{sentence(rng, 6)} {planted(rng, kind)} {sentence(rng, 4)}")
        decoys = [card(rng, "", False), "999.999.999.300", f"{rng.randint(10, 99)} {rng.randint(100, 999)}", "a@b", "+12 34"]
        texts.append(f"{sentence(rng, 3)} {rng.choice(decoys)} {sentence(rng, 3)}")
    return texts


ODD = [
    None, "", " ", "a@b.c.d%x@e.f", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "0001.2.3.0255", "1..2.3.4.5", "+1-2-3-4-5-6-7-8+12345678 9",
    "x" * 3_000, "1" * 4_000, "1 " * 4_000, "a." * 1_500, "+1" + "(" * 30_000 + "2", "a@" * 5_000, "a@b" + ".c" * 2_000 + " z",
    "Ünï@ex.com \U0001f600 me@ex.com +49 (30) 1234567", "4111 1111 1111 1111 4111111111111111", "5500-0000-0000-0004-123", "1.1.1.1@h.io",
]


def told(spans):
    order = list(PLAIN)
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order.index(s[0]), s[1])))


def check_base(texts, found):
    got = Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in found)
    expected = Counter()
    for i, t in enumerate(texts):
        spans = base_spans(t)
        n = Counter(k for k, *_ in spans)
        expected[i, *(n[k] for k in PLAIN), hashlib.sha256(told(spans).encode()).hexdigest()] += 1
    assert got == expected


def test_base_spans(make_docs):  # noqa: F811
    rng = random.Random(2)
    alphabet = "0123456789" * 3 + "  .-+@()ab%_é漢\n"
    noise = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(300)]
    texts = [*ODD, *noise, *corpus(n=40)]
    found = pii.find_personal_data(make_docs(texts)).collect()
    check_base(texts, found)
    for r in found:
        base = set(told(base_spans(texts[r["doc_id"]])).split(",")) - {""}
        spans = set(r["spans"].split(",")) - {""}
        assert base <= spans and len(spans) == len(base) + r["n_added"]


def test_added_spans(make_docs):  # noqa: F811
    """Looser forms of what the corpus holds are found, decoys and plain texts are left alone."""
    rng = random.Random(3)
    loose = {
        "email": ["ann7 (at) mail3.example.com", "bo.b41[at]mail2.example.com"],
        "phone": ["(512) 555-1234", "001 (512) 555-1234"],
        "card": [card(rng, "."), card(rng, "/")],
    }
    texts = corpus()
    at = len(texts)
    meant = {}
    for kind, forms in loose.items():
        for form in forms:
            before = sentence(rng, 5)
            meant[len(texts)] = f"{kind}:{len(before) + 1}:{len(before) + 1 + len(form)}"
            texts.append(f"{before} {form} {sentence(rng, 3)}")
    found = {r["doc_id"]: r for r in pii.find_personal_data(make_docs(texts)).collect()}
    check_base(texts, found.values())
    assert {i: found[i]["spans"] for i in meant} == meant
    for i in range(at):
        assert found[i]["spans"] == told(base_spans(texts[i])), texts[i]


def test_very_long_runs(make_docs):  # noqa: F811
    """Runs that plain patterns would need a stack or a quadratic time for."""
    texts = ["x" * 2_000_000, "a." * 500_000, "1" * 2_000_000, "1 " * 300_000, "a@b" + ".c" * 500_000, "+1" + "(" * 500_000, "0." * 500_000 + "x" * 9, "a@" * 300_000]
    found = {r["doc_id"]: r for r in pii.find_personal_data(make_docs(texts)).collect()}
    assert {i: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for i, r in found.items()} == {
        i: (int(i == 4), 125_000 * (i == 6), 0, 0) for i in range(len(texts))
    }


def test_redact(make_docs):  # noqa: F811
    texts = ["Mail ann7@mail.example.com or +1 (512) 555-1234.", None, "nothing", "\U0001f600 10.0.0.1!", "Mail ann7@mail.example.com or +1 (512) 555-1234."]
    docs = make_docs(texts)
    found = pii.redact(docs)
    assert found.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {
        0: "Mail <email> or <phone>.", 1: None, 2: "nothing", 3: "\U0001f600 <ip>!", 4: "Mail <email> or <phone>."
    }


def test_nothing_in_python(make_docs):  # noqa: F811
    docs = make_docs(corpus(n=20))
    spans = pii.touching(pii.placed(pii.proposals(docs)))
    model = pii.train(spans)
    for df in (pii.find_personal_data(docs), pii.training_cells(spans), pii.selected_spans(spans, model)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_repeated_rows_and_null_identifiers(make_docs):  # noqa: F811
    docs = make_docs(["x@y.zz"] * 3 + [None], [4, 4, None, None])
    found = Counter((r["doc_id"], r["spans"]) for r in pii.find_personal_data(docs).collect())
    assert found == {(4, "email:0:6"): 2, (None, "email:0:6"): 1, (None, ""): 1}


def test_empty_table(make_docs):  # noqa: F811
    none = make_docs([])
    assert pii.find_personal_data(none).count() == 0 and pii.redact(none).count() == 0


def test_trees_in_sql_are_those_that_were_trained(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (400, len(pii.FEATURES)))
    good = (x[:, 1] + x[:, 3] > 3).astype(float) * 3
    start, trees = pii.boosted(x, good, 1.0 - (good > 0))
    margin = start + sum(pii.evaluated(t, x) for t in trees)
    assert ((margin > 0) == (good > 0)).mean() > 0.99
    rows = spark.createDataFrame([tuple(map(int, r)) for r in x], ", ".join(f"{f} int" for f in pii.FEATURES))
    model = pii.Model(start, trees, (0.0, None, 0.0, None))
    found = rows.select("kind", model.score().alias("s"), model.selected().alias("chosen")).collect()
    assert np.allclose([r["s"] for r in found], margin)
    assert [r["chosen"] for r in found] == [k in (0, 2) and m >= 0 for k, m in zip(x[:, 0], margin)]


@pytest.mark.parametrize("precision", [0.5, 0.9])
def test_thresholds(precision):
    """Shares that rise with the score but for noise: the threshold parts them where they pass the precision."""
    rng = np.random.default_rng(2)
    x = np.zeros((2000, len(pii.FEATURES)), int)
    margin = rng.integers(-9, 10, 2000).astype(float)
    good = (rng.random(2000) < 1 / (1 + np.exp(-margin))).astype(float)
    threshold = pii.calibrated(margin, x, good, 1 - good, precision, 5)[0]
    assert abs(threshold - np.log(precision / (1 - precision))) <= 1.5
    assert good[margin >= threshold].mean() >= precision
    assert pii.calibrated(margin, x, good, 1 - good, precision, 5000) == (None,) * 4
    assert pii.calibrated(margin, x, 0 * good, 1 - 0 * good, precision, 5) == (None,) * 4
