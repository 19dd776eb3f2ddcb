"""Tumbling, sliding and cumulating event-time windows and early results.

Windows are epoch-aligned and half-open. All counts are taken per pane first (the widest slice that
no window boundary cuts), so rows are never multiplied by the number of windows they fall in.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import duration_micros, interval, micros


def _flat(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *columns, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")
    )


def tumbling_count(df: DataFrame, ts: str, size: str, keys: list[str]) -> DataFrame:
    """Rows per key and tumbling window; batch or streaming."""
    counts = df.groupBy(F.window(ts, size), *keys).agg(F.count(F.lit(1)).alias("cnt"))
    return _flat(counts, *keys, "cnt")


def _panes(size: str, slide: str) -> str:
    return f"{gcd(duration_micros(size), duration_micros(slide)) // 1000} milliseconds"


def _pane_rows(df: DataFrame, ts: str, pane: str, keys: list[str]) -> DataFrame:
    panes = df.groupBy(F.window(ts, pane).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("cnt"))
    at = F.window_time("pane") if df.isStreaming else F.col("pane.start")
    return panes.withColumn("__at", at)


def sliding_count(df: DataFrame, ts: str, size: str, slide: str, keys: list[str]) -> DataFrame:
    """Rows per key and sliding window; batch or streaming."""
    panes = _pane_rows(df, ts, _panes(size, slide), keys)
    counts = panes.groupBy(F.window("__at", size, slide), *keys).agg(F.sum("cnt").alias("cnt"))
    return _flat(counts, *keys, "cnt")


def sliding_pv_uv(df: DataFrame, ts: str, size: str, slide: str, user: str) -> DataFrame:
    """Page views, distinct users and their ratio per sliding window.

    A user's rows shrink to one per pane, then to one per window, before distinct users are counted.
    """
    panes = _pane_rows(df, ts, _panes(size, slide), [user])
    per_user = panes.groupBy(F.window("__at", size, slide), user).agg(F.sum("cnt").alias("pv"))
    out = per_user.groupBy("window").agg(F.sum("pv").alias("pv"), F.count(user).alias("uv"))
    return _flat(out, "pv", "uv").withColumn("pv_per_uv", F.col("pv") / F.nullif("uv", F.lit(0)))


def tumbling_uv(df: DataFrame, ts: str, size: str, user: str, approximate: bool = False) -> DataFrame:
    """Distinct users per tumbling window. A stream takes the approximate form."""
    distinct = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    return _flat(df.groupBy(F.window(ts, size)).agg(distinct.alias("uv")), "uv")


def cumulate_count(df: DataFrame, ts: str, size: str, step: str, keys: list[str]) -> DataFrame:
    """Counts per window of ``size`` that are reported at every ``step`` and grow up to its end.

    A report appears from the first step that holds a row of the key on.
    """
    if duration_micros(size) % duration_micros(step):
        raise ValueError("the size must be a multiple of the step")
    panes = _pane_rows(df, ts, step, keys)
    window = F.window("__at", size)
    placed = panes.select(*keys, "cnt", F.col("pane.end").alias("__end"), window.alias("window"))
    grown = placed.select(
        *keys,
        "cnt",
        F.col("window.start").alias("window_start"),
        F.explode(F.sequence(F.col("__end"), F.col("window.end"), interval(step))).alias("window_end"),
    )
    return grown.groupBy(*keys, "window_start", "window_end").agg(F.sum("cnt").alias("cnt"))


def early_firing(df: DataFrame, ts: str, size: str, every: str, keys: list[str]) -> DataFrame:
    """Partial counts at each tick of a tumbling window, and the full count at its last millisecond.

    Ticks lie at start, start + every, ...; a tick counts the rows up to and including it. A key's
    first report is at the first tick not before its first row.
    """
    width, period = duration_micros(size), duration_micros(every)
    ticks = -(-width // period)
    offset = F.pmod(micros(F.col(ts)), F.lit(width))
    slot = F.least(F.ceil(offset / F.lit(period)), F.lit(ticks)).cast("int")
    slots = df.groupBy(F.window(ts, size), *keys, slot.alias("slot")).agg(F.count(F.lit(1)).alias("cnt"))
    spread = slots.withColumn("slot", F.explode(F.sequence("slot", F.lit(ticks))))
    fired = spread.groupBy("window", *keys, "slot").agg(F.sum("cnt").alias("cnt"))
    tick = F.col("window.start") + F.col("slot") * interval(every)
    last = F.col("window.end") - interval("1 millisecond")
    at = F.when(F.col("slot") < ticks, tick).otherwise(last)
    return _flat(fired.withColumn("fired_at", at), *keys, "fired_at", "cnt")
