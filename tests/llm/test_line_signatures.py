"""What the join of lines compares, and how its lines are packed."""

import random

import pytest

from llm_cases import edited, make_docs, sentence  # noqa: F401
from tidemark.llm import line_dedup
from test_similarity import line_report


def report(docs):
    gone = line_report([(r["doc_id"], r["text"]) for r in docs.collect()])
    return {(d, len(lines)) for (d, _), lines in gone.items() if lines}


def removed(docs):
    return {(r["doc_id"], r["__n_removed"]) for r in line_dedup.dedup_lines(docs).collect() if r["__n_removed"]}


def test_copies_are_not_compared(make_docs, monkeypatch):
    """Signatures that only copies of one line share make no rows: copies are one class, whatever their number."""
    rng = random.Random(4)
    lines = [sentence(rng, 30) for _ in range(20)]
    near = sentence(rng, 60)
    docs = make_docs(["\n".join(rng.sample(lines, 6)) for _ in range(40)] + [near, edited(rng, near, 1)])
    compared = []
    plain = line_dedup.matched_classes

    def counted(rows, *others):
        compared.append(rows.select("cid").distinct().count())
        return plain(rows, *others)

    monkeypatch.setattr(line_dedup, "matched_classes", counted)
    assert removed(docs) == report(docs)
    assert compared == [2]


@pytest.mark.parametrize("lines", [1, 3])
def test_long_documents_take_several_rows(make_docs, monkeypatch, lines):
    monkeypatch.setattr(line_dedup, "ROW_LINES", lines)
    rng = random.Random(5)
    own = [sentence(rng, rng.randint(1, 40)) for _ in range(12)]
    docs = make_docs(["\n".join(edited(rng, rng.choice(own), rng.randint(0, 1)) for _ in range(rng.randint(1, 9))) for _ in range(20)] + ["\n\n", ""])
    assert len(report(docs)) > 5
    assert removed(docs) == report(docs)


def test_changed_texts(make_docs):
    """Only the lines named go; line feeds at the ends and blank lines stay as they were."""
    docs = make_docs(["a b c\n", "\na b c\n\nx\n", "a b c", None, "é ü\na b c\ny\né ü", "\n"])
    found = {r["doc_id"]: (r["text"], r["__n_lines"], r["__n_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {
        0: ("a b c\n", 2, 0),
        1: ("\n\nx\n", 5, 1),
        2: ("", 1, 1),
        3: (None, 0, 0),
        4: ("é ü\ny", 4, 2),
        5: ("\n", 2, 0),
    }
