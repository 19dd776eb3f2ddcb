"""Ranking: global and per-window top N. Ties go to the smaller key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import sliding_count, tumbling_count


def top_n(counts: DataFrame, key: str, n: int, count: str = "cnt") -> DataFrame:
    """The n highest rows with their rank. Each task keeps n rows, so the rank sees n rows only."""
    best = counts.orderBy(F.desc(count), F.asc(key)).limit(n)
    return best.withColumn("row_num", F.row_number().over(Window.orderBy(F.desc(count), F.asc(key))).cast("bigint"))


def top_n_per(counts: DataFrame, group: list[str], key: list[str], n: int, count: str = "cnt") -> DataFrame:
    """The n highest rows per group. The limit applies before the shuffle as well as after it."""
    order = Window.partitionBy(*group).orderBy(F.desc(count), *[F.asc(k) for k in key])
    return counts.withColumn("row_num", F.row_number().over(order).cast("bigint")).where(F.col("row_num") <= n)


def window_top_n(df: DataFrame, ts: str, size: str, key: str, n: int, slide: str | None = None) -> DataFrame:
    """The n most frequent keys of each tumbling or sliding window."""
    if slide:
        counts = sliding_count(df, ts, size, slide, [key])
    else:
        counts = tumbling_count(df, ts, size, [key])
    return top_n_per(counts, ["window_start", "window_end"], [key], n)


def top_values_per_window(counts: DataFrame, n: int = 2) -> DataFrame:
    """(window_end, value, rank): the n highest counts per window end, best first."""
    keys = [c for c in counts.columns if c not in ("cnt", "window_start", "window_end")]
    best = top_n_per(counts, ["window_end"], keys, n)
    return best.select("window_end", F.col("cnt").alias("value"), F.col("row_num").alias("rank"))
