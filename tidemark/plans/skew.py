"""Finding hot keys and cutting them into ordered segments.

A key may hold a large share of all rows. An operator that needs the rows of a key in order cannot
simply hash on the key then: one task would get them all. Here the heavy keys are found first, and only
those are cut, along the order column, into segments of about ``spark.tidemark.segmentRows`` rows.

Both steps look at a random share of the key and order columns. That decides only where rows are
processed, never which rows or what result: a key that is missed is at most a little above the limit,
and an uneven cut gives an uneven task. Cut points are quantiles, so dense stretches of time get more
cuts.

There is no limit to the number of hot keys or of segments. A key with more than ``COARSE`` segments is cut twice: into
``COARSE`` stretches first, and each of those by a sample of its own, so no task orders more than the sample of one
stretch. Up to ``CONSTANTS`` keys and cut points are constants of the plan; beyond that they are a table in the
shared folder, which is joined like any other. Either way they are fixed once: every part of the plan, and every
retried task, sees the same segments.
"""

from __future__ import annotations

from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

SEGMENT_ROWS = 1_000_000
COARSE = 1_024
CONSTANTS = 10_000
SAMPLES_PER_SEGMENT = 100

SEGMENT = "__segment"
CUTS = "__cuts"
HOT = "__hot"
ROWS = "__rows"


class Segments(NamedTuple):
    """A frame, and how many segments its hot keys have in all.

    With no hot keys the count is 0 and the frame is as it was; otherwise it has a ``SEGMENT`` column,
    numbered along the order, with 0 for cold keys. Numbers are below ``top``; some may have no rows.
    """

    frame: DataFrame
    count: int
    top: int = 0

    def plain(self) -> DataFrame:
        """The frame without the segment columns."""
        return self.frame.drop(SEGMENT, HOT) if self.count else self.frame


class HotKeys(NamedTuple):
    """Keys (as ``__key_<name>``) with their number of rows in ``ROWS``: a fixed table, how many, and the most rows and all rows of them."""

    frame: DataFrame
    count: int
    largest: int = 0
    rows: int = 0

    def __bool__(self) -> bool:
        return self.count > 0


def segment_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.tidemark.segmentRows", str(SEGMENT_ROWS)))


def fixed(df: DataFrame, about: int) -> DataFrame:
    """``df`` as constants of the plan, to be broadcast, if it holds about ``about`` small values; else as a table in the shared folder."""
    if about <= CONSTANTS:
        return F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in df.collect()], df.schema))
    path = scratch_path(df.sparkSession, "cuts")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, keys: list[str], rows: int | None = None, exact: bool = False) -> HotKeys:
    """Keys with more than ``rows`` rows, with their (estimated) counts.

    Streams have none: their micro-batches bound what a key can send to one task at a time.
    """
    limit = rows or segment_rows(df.sparkSession)
    share = min(1.0, 2 * SAMPLES_PER_SEGMENT / limit)
    looked_at = df.select(*[F.col(k).alias(f"__key_{k}") for k in keys])
    if df.isStreaming:
        return HotKeys(df, 0)
    if keys and not exact and share < 1:
        looked_at = looked_at.where(F.rand(11) < share)
        number = F.ceil(F.count(F.lit(1)) / F.lit(share))
    else:
        number = F.count(F.lit(1))
    counts = looked_at.groupBy(*looked_at.columns).agg(number.cast("bigint").alias(ROWS)).where(F.col(ROWS) > limit)
    few = counts.orderBy(F.desc(ROWS)).limit(CONSTANTS + 1).collect()
    if len(few) <= CONSTANTS:
        sizes = [r[ROWS] for r in few]
        table = df.sparkSession.createDataFrame([tuple(r) for r in few], counts.schema)
        return HotKeys(F.broadcast(table), len(few), max(sizes, default=0), sum(sizes))
    table = fixed(counts, CONSTANTS + 1)
    found = table.agg(F.count(F.lit(1)), F.max(ROWS), F.sum(ROWS)).first()
    return HotKeys(table, *found)


def same_key(keys: list[str]) -> Column:
    """Null-safe equality between key columns and those of HotKeys."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    return condition


def mark_hot(df: DataFrame, keys: list[str], hot: HotKeys, name: str) -> DataFrame:
    """Add a boolean column telling whether the row's key is hot."""
    joined = df.join(hot.frame.drop(ROWS).withColumn(name, F.lit(True)), same_key(keys), "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(False))).drop(*[f"__key_{k}" for k in keys])


def order_value(df: DataFrame, order: list[str]) -> Column:
    """The order columns as one comparable value that survives a trip to the driver."""
    zoned = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    parts = [F.unix_micros(c) if c in zoned else F.col(c) for c in order]
    return parts[0] if len(parts) == 1 else F.struct(*[p.alias(c) for p, c in zip(parts, order)])


def segmented(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None = None) -> Segments:
    """``df`` with hot keys cut along ``order``. ``hot`` saves the search where they are known already.

    Cuts are made in the full order, so even rows that share one time can be parted.
    """
    hot = hot_keys(df, keys) if hot is None else hot
    if not hot:
        return Segments(df, 0)
    target = segment_rows(df.sparkSession)
    parts = F.ceil(F.col(ROWS) / target).cast("int")
    names = [f"__key_{k}" for k in keys]
    joins_on = same_key(keys)

    def beside(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        """``rows`` with what ``table`` holds of their key; an order over everything has one key, without columns to join on."""
        if not keys:
            return rows.withColumns({c: table.select(c).scalar() for c in table.columns})
        return rows.join(table, joins_on, how).drop(*names)

    known = hot.frame.select(*names, F.least(parts, F.lit(COARSE)).alias("__parts"), F.col(ROWS).alias("__of"))
    segments = ceil(hot.rows / target) + hot.count
    value = order_value(df, order)

    def cut_points(values: DataFrame, groups: list[str], parts: str, about: int) -> DataFrame:
        """(groups, CUTS): the quantiles of a sample of each group."""
        share = F.least(F.lit(1.0), SAMPLES_PER_SEGMENT * F.col(parts) / F.col("__of"))
        sample = values.where(F.rand(13) < share).groupBy(*groups, parts)
        ordered = sample.agg(F.sort_array(F.collect_list("__value")).alias("__sample"))
        size = F.size("__sample").cast("bigint")
        at = F.sequence(F.lit(1), F.col(parts) - 1)
        picked = F.transform(at, lambda i: F.get("__sample", F.floor(i * size / F.col(parts)).cast("int")))
        found = ordered.where(F.col(parts) > 1).select(*groups, F.array_distinct(picked).alias(CUTS))
        return fixed(found, about)

    def placed(rows: DataFrame, value: Column, most: int) -> Column:
        """A binary search, written as a fold: how many cut points are <= the value."""
        powers = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length() + 1))])
        found = F.aggregate(powers, F.lit(0), lambda at, p: F.when(F.get(F.col(CUTS), at + p - 1) <= value, at + p).otherwise(at))
        return F.when(F.col(CUTS).isNull(), F.lit(0)).otherwise(found).cast("bigint")

    def of_keys(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[c for c in rows.columns if c not in keys])

    values = of_keys(beside(df.select(*keys, value.alias("__value")), known))
    coarse = cut_points(values, names, "__parts", min(segments, hot.count * COARSE))
    if keys:
        named = coarse.withColumnsRenamed({n: f"{n}_" for n in names})
        same = F.lit(True)
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"{n}_"))
        coarse = hot.frame.select(*names).join(named, same, "left").select(*names, CUTS, F.lit(True).alias(HOT))
    cut = beside(df, coarse, "left")
    if not keys:
        cut = cut.withColumn(HOT, F.lit(True))
    most = min(ceil(hot.largest / target), COARSE)
    frame = cut.withColumns({SEGMENT: placed(cut, value, most), HOT: F.coalesce(HOT, F.lit(False))}).drop(CUTS)
    stride = ceil(hot.largest / target / COARSE)
    if stride <= 1:
        return Segments(frame, segments, most + 1)
    # Each stretch of a key that has too many segments is cut by a sample of its own.
    fine = F.ceil(F.ceil(F.col(ROWS) / target) / COARSE).cast("int")
    long = hot.frame.select(*names, fine.alias("__fine"), F.ceil(F.col(ROWS) / COARSE).alias("__of")).where("__fine > 1")
    inside = of_keys(beside(frame.where(HOT).select(*keys, SEGMENT, value.alias("__value")), long))
    second = cut_points(inside, [*names, SEGMENT], "__fine", segments).withColumnRenamed(SEGMENT, "__stretch")
    cut = frame.join(second, joins_on & (F.col(SEGMENT) == F.col("__stretch")), "left").drop(*names, "__stretch")
    number = F.col(SEGMENT) * (stride + 1) + placed(cut, value, stride)
    return Segments(cut.withColumn(SEGMENT, number).drop(CUTS), segments, (most + 1) * (stride + 1))
