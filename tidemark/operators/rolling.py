"""Rolling aggregates: one output row per input row, in arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import millis
from tidemark.plans.scans import highest, lowest, running, total


def rolling_count(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """How many rows the key has had so far."""
    return running(df, [key], [arrival], cnt=total(F.lit(1)))


def rolling_sum(df: DataFrame, key: str, arrival: str, value: str, name: str = "total") -> DataFrame:
    """Sum of the key's values so far."""
    return running(df, [key], [arrival], **{name: total(F.col(value))})


def rolling_max(df: DataFrame, key: str, arrival: str, value: str, frozen: list[str]) -> DataFrame:
    """Highest value so far; the ``frozen`` columns keep those of the key's first row."""
    first = lowest(F.struct(arrival, *frozen))
    out = running(df, [key], [arrival], __first=first, __top=highest(F.col(value)))
    return out.select(
        arrival, key, *[F.col(f"__first.{c}").alias(c) for c in frozen], F.col("__top").alias(value)
    )


def rolling_max_by(df: DataFrame, key: str, arrival: str, value: str, carried: list[str]) -> DataFrame:
    """The row with the highest value so far; the earlier one on a tie."""
    best = highest(F.struct(value, (-F.col(arrival)).alias("__earliness"), *carried))
    out = running(df, [key], [arrival], __best=best)
    return out.select(arrival, key, *[F.col(f"__best.{c}").alias(c) for c in [*carried, value]])


def most_active(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """After each row: the key with the most rows so far; the later one on a tie."""
    counted = rolling_count(df.select(key, arrival), key, arrival)
    best = highest(F.struct("cnt", arrival, key))
    out = running(counted, [], [arrival], __best=best)
    return out.select(
        arrival, F.col(f"__best.{key}").alias(f"active_{key}"), F.col("__best.cnt").alias("active_cnt")
    )


def final_most_active(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """The key with the most rows; the one whose last row is latest on a tie."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.max(arrival).alias("__last"))
    return counts.agg(
        F.max_by(key, F.struct("cnt", "__last")).alias(key), F.max("cnt").alias("cnt")
    )


def every_nth_average(df: DataFrame, key: str, arrival: str, ts: str, n: int = 5) -> DataFrame:
    """At every n-th row of a key: the mean epoch millisecond of all its rows so far, cut off.

    The sum is kept as a decimal: a heavy key's sum of epoch milliseconds leaves the bigint range.
    """
    out = running(
        df.select(key, arrival, ts),
        [key],
        [arrival],
        cnt=total(F.lit(1)),
        __sum=total(millis(F.col(ts)).cast("decimal(20,0)")),
    )
    return out.where(F.col("cnt") % n == 0).select(
        key, arrival, "cnt", F.expr("__sum div cnt").alias("avg_millis")
    )


def count_changelog(df: DataFrame, key: str, arrival: str) -> DataFrame:
    """(arrival, key, kind, cnt): the changes that each row makes to the count of its key.

    A key's first row inserts its count (+I). Any other withdraws the count that held before (-U) and gives the
    new one (+U), so whatever is computed from the changes can take back what no longer holds: see ``signed``.
    """
    old, new = F.col("cnt") - 1, F.col("cnt")
    changes = F.when(
        new == 1, F.array(F.struct(F.lit("+I").alias("kind"), new.alias("cnt")))
    ).otherwise(F.array(F.struct(F.lit("-U").alias("kind"), old.alias("cnt")), F.struct(F.lit("+U").alias("kind"), new.alias("cnt"))))
    counted = rolling_count(df.select(key, arrival), key, arrival)
    return counted.select(arrival, key, F.explode(changes).alias("__change")).select(arrival, key, "__change.*")


def signed(kind: str = "kind") -> Column:
    """1 for a change that adds a row and -1 for one that withdraws it."""
    return F.when(F.col(kind).startswith("-"), -1).otherwise(1)


def keys_per_count(changes: DataFrame) -> DataFrame:
    """How many keys have each count, from a changelog alone: withdrawn counts are taken off again."""
    held = changes.groupBy("cnt").agg(F.sum(signed()).alias("keys"))
    return held.where(F.col("keys") > 0)
