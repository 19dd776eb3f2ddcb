"""Windows of an anchor that is everywhere are spread over buckets, and equal ones still meet."""

from collections import Counter

import numpy as np
import pytest

from llm_cases import docs, make_docs, rows_of, texts  # noqa: F401
from test_similarity import substring_report
from tidemark.llm import substring_dedup


def buckets_of(first_doc, key, hot):
    n = len(key)
    zero = np.zeros(n, np.int64)
    rows = substring_dedup._emitted(np.arange(first_doc, first_doc + n), zero, zero, np.full(n, 9, np.uint64), key, np.full(n, hot), 64)
    found = {}
    for batch in rows:
        for row in batch.to_pylist():
            if row["kind"] == substring_dedup.CHECK:
                found |= dict.fromkeys(np.frombuffer(row["keys"], "<u8").tolist(), row["bucket"])
    return found


def test_windows_of_a_hot_anchor_are_spread():
    key = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    spread = buckets_of(0, key, True)
    assert max(Counter(spread.values()).values()) < 50
    assert buckets_of(5000, key[::-1], True) == spread
    assert len(set(buckets_of(0, key, False).values())) == 1


@pytest.mark.parametrize("options", [{"hot_bits": 0}, {"hot_bits": 0, "slice_bytes": 300}])
def test_substrings_of_hot_anchors(docs, rows_of, options):  # noqa: F811
    found = substring_dedup.dedup_substrings(docs, 20, **options).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == substring_report(rows_of, 20)
