"""The registered queries and the pipeline on the smallest tables."""

import os
from collections import defaultdict

import duckdb
import pytest
from llm_cases import docs, make_docs, texts  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemark.llm import decontamination, line_dedup, ngram_join, packing, quality
from tidemark.llm.queries import ORACLES, QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")

COLUMNS = {
    "op1": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3": "doc_id size text_crc32 law shard slot grown_shard",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_lines n_removed kept_sha256",
    "op6": "doc_id keep_id group_size kept text_sha256",
    "op7": "doc_id n_words n_removed kept_sha256",
    "op8": "doc_id item_id edits end_char",
    "op9": "doc_id n_shingles component_id",
    "op10": "doc_id held_out lang_pred score",
    "op11": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12": "vec_id component n deviation whitened explained identity_error",
    "op13": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


def test_queries_are_registered():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(found.columns)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    result = connection.execute(ORACLES[name])
    names = sorted(d[0] for d in result.description)
    expected = result.df()[names]
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert sorted(found.columns) == names
    assert sorted(map(tuple, found[names].astype(str).values.tolist())) == sorted(map(tuple, expected.astype(str).values.tolist()))


def test_pipeline_stages(spark):
    """Every stage works on what the stage before kept, and its decision is its operator's."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near-duplicates", "benchmark", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR).cache()
        if name == "quality":
            net = quality.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            good = quality.quality_scores(docs, net, 0.3).filter("predicted = 1")
            assert ids(after) == ids(good)
        if name == "lines":
            cleaned = line_dedup.dedup_lines(docs)
            stay = cleaned.filter("__n_removed = 0 or __n_removed < __n_lines")
            assert sorted(map(tuple, after.select("doc_id", "text").collect())) == sorted(map(tuple, stay.select("doc_id", "text").collect()))
            assert after.filter(F.col("n_chars") != F.char_length("text")).isEmpty()
        if name == "near-duplicates":
            groups = defaultdict(list)
            for r in ngram_join.ngram_components(docs).collect():
                groups[r["component_id"]].append(r["doc_id"])
            assert ids(after) == sorted(min(g) for g in groups.values())
        if name == "benchmark":
            bad = {r["doc_id"] for r in decontamination.benchmark_matches(docs, items).collect()}
            assert bad and ids(after) == sorted(set(ids(docs)) - bad)
        if name == "packing":
            assert after.count() == packing.token_pieces(docs, tokenizer_path(), 2048).count()
        else:
            assert after.columns == columns
            kept[name] = after.count()
            docs = after
    assert list(kept.values()) == sorted(kept.values(), reverse=True)


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_on_odd_documents(spark, docs, make_docs):  # noqa: F811
    """Nulls, blanks, repeated rows, clashing column names, and no rows at all."""
    for start in (docs, make_docs([])):
        held = start
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, held, SF_DIR)
            assert name == "packing" or after.columns == start.columns
            held = after.cache()
        assert (held.count() > 0) == (start is docs)
