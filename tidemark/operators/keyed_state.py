"""Timers, periodic totals and expiring counts per key, computed on stored rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import duration_micros, interval, micros
from tidemark.plans.scans import extend, highest, lowest, running, total
from tidemark.plans.skew import hot_keys, mark_hot, segmented
from tidemark.session import ensure_checkpoint_dir


def event_timers(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """(key, kind, at): each row, and the timer it sets ``delay`` later; equal timers fire once.

    The end of the input fires all timers that are still pending.
    """
    rows = df.select(key, F.lit("row").alias("kind"), F.col(ts).alias("at"))
    timers = df.select(key, F.lit("timer").alias("kind"), (F.col(ts) + interval(delay)).alias("at"))
    return rows.unionByName(timers.distinct())


def ttl_count(df: DataFrame, key: str, ts: str, tie: str, ttl: str) -> DataFrame:
    """Rows of the key so far, where a pause of ``ttl`` or more forgets the earlier ones."""
    order = [ts, tie]
    cut = segmented(df, [key], order)
    placed = extend(
        cut, [key], order, __nth=total(F.lit(1)), __last=highest(F.col(ts), before=True)
    )
    gap = F.col("__last").isNull() | (F.col(ts) >= F.col("__last") + interval(ttl))
    started = highest(F.when(gap, F.col("__nth")))
    runs = extend(placed, [key], order, __from=started).plain()
    counted = runs.withColumn("cnt", F.col("__nth") - F.col("__from") + 1)
    return counted.drop("__nth", "__last", "__from")


def periodic_totals(df: DataFrame, key: str, ts: str, period: str) -> DataFrame:
    """(key, fire_at, total): a key's row count, reported ``period`` after the row that asked for it.

    The first row asks for a report; after a report the next row asks again. Rows up to and including
    the report's time count, and the count is never reset. ``fire_at`` is in epoch microseconds. Rows without a
    key or a time ask for nothing and are not counted.

    Where a report starts depends on the one before, which no window frame expresses. Keys of bounded
    size are walked in time order by the task that sorted them; the steps of hot keys are linked by
    pointer jumping over all their rows in parallel.
    """
    spans = duration_micros(period)
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    times = df.where(known).select(key, micros(F.col(ts)).alias("at"))
    hot = hot_keys(times, [key])
    if not hot:
        return _walked(times, key, spans)
    marked = mark_hot(times, [key], hot, "__hot")
    cold = _walked(marked.where(~F.col("__hot")).drop("__hot"), key, spans)
    return cold.unionByName(_jumped(marked.where("__hot").drop("__hot"), key, spans))


def _walk(key: str, period: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, fire_at, seen = None, None, 0
        for batch in batches:
            keys, at = batch[key].to_numpy(), batch["at"].to_numpy()
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            out = []
            for low, high in zip([0, *edges], [*edges, len(keys)]):
                if current is None or keys[low] != current:
                    if fire_at is not None:
                        out.append((current, fire_at, seen))
                    current, fire_at, seen = keys[low], None, 0
                while low < high:
                    if fire_at is None:
                        fire_at = int(at[low]) + period
                    end = low + int(np.searchsorted(at[low:high], fire_at, side="right"))
                    seen += end - low
                    low = end
                    if low < high:
                        out.append((current, fire_at, seen))
                        fire_at = None
            if out:
                yield pd.DataFrame(out, columns=[key, "fire_at", "total"])
        if fire_at is not None:
            yield pd.DataFrame([(current, fire_at, seen)], columns=[key, "fire_at", "total"])

    return run


def _walked(times: DataFrame, key: str, period: int) -> DataFrame:
    kind = times.schema[key].dataType.simpleString()
    ordered = times.repartition(key).sortWithinPartitions(key, "at")
    return ordered.mapInPandas(_walk(key, period), f"{key} {kind}, fire_at bigint, total bigint")


def _jumped(times: DataFrame, key: str, period: int) -> DataFrame:
    """Reports of hot keys: link each time to the one that asks next, then follow by doubling.

    Level k links a time to the one 2^k steps later. Such a link is only followed from the first time
    or from a time that 2^k steps lead to, and chains that meet stay together, so each level mostly is
    much smaller than the one before. Joins are on (key, time), which spreads a hot key.
    """
    ensure_checkpoint_dir(times.sparkSession)
    points = times.groupBy(key, "at").agg(F.count(F.lit(1)).alias("n"))
    data = points.withColumn("probe", F.lit(0)).withColumn("origin", F.lit(None).cast("bigint"))
    probes = points.select(
        key,
        (F.col("at") + period).alias("at"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(1).alias("probe"),
        F.col("at").alias("origin"),
    )
    # A probe stands at its report's time, after the rows of that time.
    line = data.unionByName(probes)
    order = ["at", "probe"]
    counted = extend(segmented(line, [key], order), [key], order, total=total(F.col("n")))
    later = lowest(F.when(F.col("probe") == 0, F.col("at")), before=True)
    linked = extend(counted, [key], order, reverse=True, next=later).plain()
    links = (
        linked.where(F.col("probe") == 1)
        .select(key, F.col("origin").alias("at"), "next", "total")
        .checkpoint()
    )
    starts = links.groupBy(key).agg(F.min("at").alias("at")).checkpoint()
    levels = [links.select(key, "at", "next").where(F.col("next").isNotNull())]
    while True:
        one = levels[-1]
        ends = one.select(key, F.col("next").alias("at")).unionByName(starts).distinct()
        second = one.select(key, F.col("at").alias("mid"), F.col("next").alias("last"))
        two = (
            ends.join(one, [key, "at"])
            .withColumnRenamed("next", "mid")
            .join(second, [key, "mid"])
            .select(key, "at", F.col("last").alias("next"))
            .checkpoint()
        )
        if two.isEmpty():
            break
        levels.append(two)
    chain = starts
    for level in reversed(levels):
        landed = chain.join(level, [key, "at"]).select(key, F.col("next").alias("at"))
        chain = chain.unionByName(landed).checkpoint()
    return chain.join(links, [key, "at"]).select(
        key, (F.col("at") + period).alias("fire_at"), "total"
    )


def buffered(df: DataFrame, arrival: list[str], size: int = 10) -> DataFrame:
    """Rows in arrival order dealt into full buffers of ``size``; rows still waiting are left out.

    Adds ``batch_id`` and ``position`` (both from 0).
    """
    placed = running(df, [], arrival, __nth=total(F.lit(1)))
    flushed = df.agg((F.floor(F.count(F.lit(1)) / F.lit(size)) * size).alias("n")).scalar()
    return (
        placed.where(F.col("__nth") <= flushed)
        .withColumn("batch_id", F.floor((F.col("__nth") - 1) / F.lit(size)))
        .withColumn("position", (F.col("__nth") - 1) % size)
        .drop("__nth")
    )
