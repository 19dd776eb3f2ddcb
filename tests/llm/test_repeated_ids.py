"""Near duplicates whose identifiers are repeated or null."""

import random

from llm_cases import edited, make_docs, sentence  # noqa: F401
from tidemark.llm import ngram_join


def test_one_of_each_with_repeated_and_null_ids(make_docs):  # noqa: F811
    rng = random.Random(3)
    groups = [sentence(rng, 200) for _ in range(3)]
    texts = [edited(rng, groups[g], 1) for g in (0, 0, 0, 1, 1, 1, 2, 2, 2)]
    ids = [7, 7, 8, None, None, None, 7, 7, 7]
    kept = ngram_join.one_of_each(make_docs(texts, ids)).collect()
    assert sorted((texts.index(r["text"]) // 3, r["doc_id"] or -1) for r in kept) == [(0, 7), (1, -1), (2, 7)]
