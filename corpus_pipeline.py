"""The corpus pipeline: each stage calls one operator of ``tidemark.llm`` and takes what the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of documents.
Rows with null or empty text go through the stages like any other; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, ngram_join, packing, quality
from tidemark.llm.common import documents
from tidemark.llm.queries import tokenizer_path
from tidemark.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_filter(docs, net, 0.3)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that repeat earlier ones. Those of which every line went are repeats themselves and go."""
    cleaned = line_dedup.dedup_lines(docs, 80, 5)
    kept = cleaned.filter((F.col("__n_removed") == 0) | (F.col("__n_removed") < F.col("__n_lines")))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("__n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
        kept = kept.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return kept.select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by similar shingle sets."""
    return ngram_join.one_of_each(docs, 80, 5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048 from what is left."""
    return packing.pack_documents(docs, tokenizer_path(), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("lines", without_repeated_lines),
    ("near-duplicates", one_of_near_duplicates),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: A learned classifier and a tokenizer cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
