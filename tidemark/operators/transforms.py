"""Row-wise projection, filtering and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.strings import split_words


def words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per blank-separated word."""
    return df.select(F.explode(split_words(F.col(text))).alias(word))


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Words and how often they occur; counted map-side, so a frequent word is no hot spot."""
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def flat_map(df: DataFrame, cases: list[tuple[Column, list[Column]]], name: str, keep: list[str]) -> DataFrame:
    """Each row gives the values of the first case it meets, and no row if it meets none."""
    values = None
    for condition, outputs in cases:
        array = F.array(*outputs)
        values = F.when(condition, array) if values is None else values.when(condition, array)
    return df.select(*keep, F.explode(values).alias(name))


def emit_times(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` says; null and 0 drop it."""
    copies = F.array_repeat(F.lit(True), F.coalesce(times, F.lit(0)))
    return df.select("*", F.explode(copies).alias("__copy")).drop("__copy")


def tagged_outputs(
    df: DataFrame, outputs: dict[str, tuple[Column, Column]], tag: str = "tag", value: str = "value"
) -> DataFrame:
    """Several outputs of one pass: a row appears under each tag whose condition it meets."""
    tagged = [
        F.when(condition, F.struct(F.lit(name).alias(tag), shape.alias(value)))
        for name, (condition, shape) in outputs.items()
    ]
    return df.select(F.inline(F.array_compact(F.array(*tagged))))


def split_outputs(
    df: DataFrame, side: dict[str, tuple[Column, list[Column]]]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The whole main frame, and one frame per side output with its own filter and columns."""
    return df, {name: df.where(cond).select(*cols) for name, (cond, cols) in side.items()}


def lateral_split(df: DataFrame, text: str, delimiter: str, keep: list[str]) -> DataFrame:
    """(word, length) rows of the text's pieces next to the kept columns."""
    pieces = F.explode(split_words(F.col(text), delimiter)).alias("word")
    return df.select(*keep, pieces).withColumn("length", F.length("word"))
