"""Benchmark rows without a number, and several texts under one."""

import pytest

from llm_cases import make_docs  # noqa: F401
from tidemark.llm import decontamination


@pytest.mark.parametrize("block_chars", [2_000_000, 30])
def test_every_distinct_row_is_an_item(spark, make_docs, block_chars):  # noqa: F811
    items = [(1, "alpha beta gamma delta"), (1, "omega psi chi phi"), (1, "Omega  psi chi phi"), (None, "nobody knows my number"), (None, "nor mine either"), (2, "nor mine either")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(["x alpha beta gamma delta", "OMEGA psi chi phi x", "nobody knows my number, nor mine either", "clean"], clash=False)
    found = decontamination.benchmark_matches(docs, benchmark, block_chars=block_chars).collect()
    expected = [(0, 1), (1, 1), (2, -1), (2, -1), (2, 2)]
    assert sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"]) for r in found) == expected
    kept = decontamination.decontaminate(docs, benchmark, block_chars=block_chars).collect()
    assert [r["doc_id"] for r in kept] == [3]
