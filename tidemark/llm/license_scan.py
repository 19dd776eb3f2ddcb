"""License texts in documents: an exact set-similarity join of text blocks with templates."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, cut, texts_of

#: Phrases whose words must stand consecutively, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Templates that the similarity join adds; a block holds one if it has enough of its words in any order.
TEMPLATES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "all rights reserved": "all-rights-reserved",
    "released into the public domain": "public-domain",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the terms of the eclipse public license": "epl",
}

NOT_A_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_hits(docs: DataFrame, tokens: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, __row, n_words, hits): number of words, and place and word of those among ``tokens``, A-Z in lower case."""
    words = F.split(F.regexp_replace("text", f"^{NOT_A_WORD}", ""), NOT_A_WORD)
    split = texts_of(docs, id_col, text_col).select("doc_id", ROW, words.alias("words"))
    n_words = F.size("words") - (F.element_at("words", -1) == "").cast("int")
    # lower() also changes other letters, so it only narrows; translate() decides.
    near = F.filter(
        F.transform("words", lambda w, i: F.when(F.lower(w).isin(tokens), F.struct(i.alias("pos"), F.translate(w, UPPER, LOWER).alias("token")))),
        lambda h: h.isNotNull() & h["token"].isin(tokens),
    )
    return split.select("doc_id", ROW, n_words.cast("long").alias("n_words"), near.alias("hits"))


def template_rows(templates: dict[str, str], frequency: dict[str, int], threshold: float) -> list[tuple]:
    """(template, label, phrase words, distinct words, needed words, word, rank): words of a template from rare to frequent."""
    rows = []
    for t, (phrase, label) in enumerate(templates.items()):
        words = phrase.split()
        order = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        needed = ceil(threshold * len(order) - 1e-9)
        rows += [(t, label, words, len(words), len(order), needed, w, rank) for rank, w in enumerate(order)]
    return rows


def license_blocks(hits: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """(__row, template, label, block, containment, starts) of every block with at least ``threshold`` of a template's words.

    For a template of n words a block is 2 n consecutive words, and blocks begin every n words, so any n
    consecutive words lie in one. Words are ordered by their number in all documents. Only the rarest words of
    a template, its prefix, make a block a candidate: a block without any of them misses too many. A template's
    words that may still follow the first common one bound the overlap (position), and a block shorter than
    the needed words is none (length). Candidates are then verified against all their words. ``starts`` are
    places in the block where the template's words stand consecutively, each counted in one block only.
    """
    spark = hits.sparkSession
    frequency = {
        r["token"]: r["n"]
        for r in hits.select(F.explode("hits.token").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()
    }
    table = F.broadcast(  # bounded: one row for each word of a template
        spark.createDataFrame(
            template_rows(templates, frequency, threshold),
            "template int, label string, phrase array<string>, span int, width int, needed int, token string, rank int",
        )
    )
    prefix = sorted({r[6] for r in template_rows(templates, frequency, threshold) if r[7] <= r[4] - r[5]})
    at_all = hits.filter(F.exists("hits", lambda h: h["token"].isin(prefix)))
    placed = (
        at_all.select(ROW, "n_words", F.explode("hits").alias("hit"))
        .select(ROW, "n_words", "hit.pos", "hit.token")
        .join(table, "token")
        .withColumn("block", F.explode(F.expr("array(pos div span - 1, pos div span)")))
        .filter((F.col("block") >= 0) & (F.least(F.col("n_words") - F.col("block") * F.col("span"), 2 * F.col("span")) >= F.col("needed")))
    )
    key = [ROW, "template", "block"]
    candidates = placed.filter(F.col("rank") <= F.col("width") - F.col("needed")).select(*key).distinct()
    blocks = (
        placed.join(candidates, key, "left_semi")
        .groupBy(*key, "label", "phrase", "span", "width", "needed")
        .agg(
            F.count_distinct("token").alias("common"),
            F.map_from_entries(F.array_sort(F.collect_set(F.struct("pos", "token")))).alias("words"),
        )
        .filter("common >= needed")
    )
    starts = F.expr(
        "filter(map_keys(words), p -> p div span = block and "
        "forall(sequence(0, span - 1), i -> coalesce(try_element_at(words, p + i) = phrase[i], false)))"
    )
    return blocks.select(*key, "label", (F.col("common") / F.col("width")).alias("containment"), starts.alias("starts"))


def scan_licenses(
    docs: DataFrame,
    base: dict[str, str] = BASE,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = 0.85,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters a-z (A-Z count as those) and all characters beyond ASCII. Blocks of the
    text are joined with the templates (see license_blocks). ``labels`` are those of all templates of which
    some block holds at least ``threshold`` of the words; for ``base`` phrases the words must also stand
    consecutively: ``n_base`` such places, the first and last of them, and ``base_labels``. ``score`` is the largest
    containment, 0 without labels. Null and empty texts have no words, no places (first and last are null) and
    empty labels. Repeated rows give equal rows; no rows give no rows; other columns are ignored.
    """
    every = {**base, **templates}
    tokens = sorted({w for phrase in every for w in phrase.split()})
    hits = cut(word_hits(docs, tokens, id_col, text_col))
    blocks = license_blocks(hits, every, threshold).withColumn("is_base", F.col("template") < len(base))
    counted = blocks.filter(~F.col("is_base") | (F.size("starts") > 0))
    found = counted.groupBy(ROW).agg(
        F.sum(F.when(F.col("is_base"), F.size("starts")).otherwise(0)).alias("n_base"),
        F.min(F.when(F.col("is_base"), F.array_min("starts"))).alias("first_word"),
        F.max(F.when(F.col("is_base"), F.array_max("starts"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("containment").alias("score"),
    )
    return hits.drop("hits").join(found, ROW, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"),
        F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
