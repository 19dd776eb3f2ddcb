"""Exact duplicates by a tree merge of digest runs, an aggregation for each level. DataFrame functions only."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, cut, texts_of

KEY = ["digest", "n_bytes", "sha"]


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    rows_per_run: int = 1_000,
    fan_in: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows form a group if their texts are identical. The texts are read once; afterwards only digests move.
    Rows are dealt to runs of about ``rows_per_run`` rows. A run holds one entry per text, by its 64-bit digest:
    the identifier to keep and the number of rows. In every round ``fan_in`` runs merge into one by an aggregation, so a text with a third of all rows never has more than ``fan_in`` entries (or, in the first
    round, the rows of one run) under one key, and each run is itself spread over tasks by its digests.
    An equal digest counts only if length and SHA-256 agree as well. The outcome then goes the same way
    back, from a run to those it was merged from, and at last to the rows.

    keep: "largest" or "smallest" identifier. Null text is empty text, and all empty texts are one group.
    A null identifier is kept only if its group has no other (keep_id is then null). Of rows that repeat
    identifier and text exactly one is kept. No rows give no rows; other columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    text = F.col("text")
    rows = cut(
        texts_of(docs, id_col, text_col).select(
            "doc_id",
            ROW,
            F.xxhash64(text).alias("digest"),
            F.octet_length(text).alias("n_bytes"),
            F.unhex(F.sha2(text, 256)).alias("sha"),
        )
    )
    runs = max(1, ceil(rows.count() / rows_per_run))
    rows = rows.withColumn("run", F.pmod(F.xxhash64(ROW), F.lit(runs)))

    best = F.max if keep == "largest" else F.min
    present = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    levels = [
        cut(
            rows.groupBy("run", *KEY).agg(best(F.struct(present, "doc_id", ROW)).alias("best"), F.count("*").alias("n"))
        )
    ]
    while runs > 1:
        runs = ceil(runs / fan_in)
        levels.append(
            cut(
                levels[-1]
                .withColumn("run", F.floor(F.col("run") / fan_in))
                .groupBy("run", *KEY)
                .agg(best("best").alias("best"), F.sum("n").alias("n"))
            )
        )

    # Texts with one row need no way back: whoever finds nothing stands alone.
    known = levels.pop().filter("n > 1").select("run", *KEY, "best", "n")
    for level in reversed(levels):
        parts = level.select(F.col("run").alias("part"), F.floor(F.col("run") / fan_in).alias("run"), *KEY)
        known = parts.join(known, ["run", *KEY]).select(F.col("part").alias("run"), *KEY, "best", "n")
    alone = F.col("n").isNull()
    return rows.join(known, ["run", *KEY], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(ROW) == F.col(f"best.{ROW}"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
