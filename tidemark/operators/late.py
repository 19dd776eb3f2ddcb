"""Per-row watermarks, allowed lateness and late-row side outputs on arrival-ordered data.

The engine's own watermark moves once per micro-batch and drops late rows silently. Here the
watermark before each row is computed as data: the highest event time that arrived earlier, less the
allowed disorder and one millisecond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import interval, window_start
from tidemark.plans.scans import highest, running, total
from tidemark.plans.skew import hot_keys

ON_TIME, LATE, DROPPED = "on_time", "late", "dropped"


def _behind(seen: Column, delay: str) -> Column:
    return seen - interval(delay) - interval("1 millisecond")


def watermark_trace(df: DataFrame, ts: str, arrival: list[str], delay: str) -> DataFrame:
    """Add ``watermark``: its value just before the row arrived (null before the first row)."""
    out = running(df, [], arrival, __seen=highest(F.col(ts), before=True))
    return out.withColumn("watermark", _behind(F.col("__seen"), delay)).drop("__seen")


def union_watermark(
    inputs: dict[str, DataFrame], ts: str, arrival: list[str], delay: str, name: str = "stream"
) -> DataFrame:
    """Union of streams and the combined watermark before each row: the lowest of theirs.

    It stays null until every stream has had a row.
    """
    merged = None
    for label, df in inputs.items():
        part = df.withColumn(name, F.lit(label))
        merged = part if merged is None else merged.unionByName(part)
    seen = {
        f"__seen_{label}": highest(F.when(F.col(name) == label, F.col(ts)), before=True)
        for label in inputs
    }
    out = running(merged, [], arrival, **seen)
    started = F.lit(True)
    for column in seen:
        started = started & F.col(column).isNotNull()
    lowest_seen = F.least(*[F.col(c) for c in seen]) if len(seen) > 1 else F.col(next(iter(seen)))
    return out.withColumn("watermark", F.when(started, _behind(lowest_seen, delay))).drop(*seen)


def classify_late(
    df: DataFrame, ts: str, arrival: list[str], window: str, delay: str, lateness: str
) -> DataFrame:
    """Add the row's window, the watermark before it, and ``arrived``: on_time, late or dropped.

    A row is late once its window has fired, and dropped once the window's lateness is over too.
    """
    traced = watermark_trace(df, ts, arrival, delay)
    start = window_start(F.col(ts), window)
    last = F.col("window_end") - interval("1 millisecond")
    arrived = (
        F.when(last + interval(lateness) <= F.col("watermark"), F.lit(DROPPED))
        .when(last <= F.col("watermark"), F.lit(LATE))
        .otherwise(F.lit(ON_TIME))
    )
    return (
        traced.withColumn("window_start", start)
        .withColumn("window_end", F.col("window_start") + interval(window))
        .withColumn("arrived", arrived)
    )


def refired_counts(classified: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """Every result the windows emit: the first one, then one more per accepted late row.

    ``refired_by`` is the arrival of the late row that caused the result, null for the first one.
    Only late rows need an order; on-time rows of a window become one row without arrival, by the same pass over
    the watermarks. Which windows are hot is asked of all rows, which needs no watermarks.
    """
    group = [*keys, "window_start", "window_end"]
    hot = hot_keys(classified, group)
    is_late = F.col("arrived") == LATE
    rows = classified.where(is_late | (F.col("arrived") == ON_TIME)).groupBy(
        *group, *[F.when(is_late, F.col(c)).alias(c) for c in arrival]
    )
    counted = rows.agg(F.count(F.lit(1)).alias("__n"))
    # The first result has no arrival, so it comes first in the order and the late rows add to it.
    emitted = running(counted, group, arrival, hot=hot, cnt=total(F.col("__n")))
    return emitted.select(*group, F.col(arrival[-1]).alias("refired_by"), "cnt")


def final_counts(classified: DataFrame, keys: list[str]) -> DataFrame:
    """The last result of each window: all rows that were not dropped."""
    kept = classified.where(F.col("arrived") != DROPPED)
    return kept.groupBy(*keys, "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))


def late_rows(classified: DataFrame) -> DataFrame:
    """The side output: rows that came after their window's lateness was over."""
    return classified.where(F.col("arrived") == DROPPED)
