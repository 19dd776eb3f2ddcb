"""The queries of these operators, with production parameters over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversation_repair,
    decontamination,
    embedding_whitening,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    pii,
    quality,
    sharding,
    substring_dedup,
)
from tidemark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op2_pack_sequences")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(), 2048)


@register("op3_balanced_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), 24)


@register(
    "op6_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), keep="largest")


@register("op4_quality_score")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_scores(docs, net, 0.3)


@register("op10_language_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs)).select(
        "doc_id",
        language_id.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


@register("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


@register("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them, and which; all others are clean."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.benchmark_matches(documents(spark, sf_dir), items).select("doc_id", "item_id", "edits", "end_char")


@register("op9_ngram_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir), 80, 5)


@register("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, how many went as repeats of earlier ones, and a digest of what is left."""
    return line_dedup.dedup_lines(documents(spark, sf_dir), 80, 5).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@register(
    "op7_substring_dedup",
    r"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS words
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS i FROM split)
    ), later AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS place FROM windows
        ) WHERE place > 1
    ), gone AS (
        SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest(generate_series(0, 19)) AS k)
    ), kept AS (
        SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text, count(*) AS n
        FROM (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM split) w
        ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i
        GROUP BY w.doc_id
    )
    SELECT s.doc_id, len(s.words) AS n_words, len(s.words) - coalesce(k.n, 0) AS n_removed,
           sha256(coalesce(k.text, '')) AS kept_sha256
    FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(documents(spark, sf_dir), 20).drop("kept")


@register("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@register("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 8)


@register("op13_personal_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))
