"""Running aggregates and neighbours in key order, safe for hot keys.

``running`` and ``neighbours`` give what window functions over ``partitionBy(keys).orderBy(order)``
give. If no key is hot, that window is what runs. Otherwise rows are hashed on (key, segment): the
window runs inside each segment, and what comes before a segment is added from a small table with
one row per segment of a hot key. ``extend`` and ``look_back`` do the same on rows that are cut
already: several of them, in either direction, share one shuffle of the rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.skew import HOT, SEGMENT, HotKeys, Segments, segmented

LOCAL_ROW = "__row"
CARRIED = "__carried"


class Running(NamedTuple):
    """One running aggregate: its kind, its input, and whether the current row is left out."""

    kind: str
    column: Column
    before: bool


def total(column: Column, before: bool = False) -> Running:
    return Running("sum", column, before)


def highest(column: Column, before: bool = False) -> Running:
    return Running("max", column, before)


def lowest(column: Column, before: bool = False) -> Running:
    return Running("min", column, before)


AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, earlier: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(earlier, F.lit(0)) + F.coalesce(local, F.lit(0))
    return F.greatest(earlier, local) if kind == "max" else F.least(earlier, local)


def _window(partition: list[str], order: list[str], reverse: bool) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(*[F.desc(c) if reverse else F.asc(c) for c in order])


def _local(spec: Running, ordered: WindowSpec) -> Column:
    last = -1 if spec.before else Window.currentRow
    value = AGGREGATE[spec.kind](spec.column).over(ordered.rowsBetween(Window.unboundedPreceding, last))
    return F.coalesce(value, F.lit(0)) if spec.kind == "sum" else value


#: A carried table is broadcast up to that many rows of fixed width (some 100 bytes each), or a hundredth of them of any width.
BROADCAST_ROWS = 100_000


def _fixed_width(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_fixed_width(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType))


def attach(rows: DataFrame, carry: DataFrame, keys: list[str], segments: Segments) -> DataFrame:
    """Join the per-segment table back; it is broadcast while its size is known to be small."""
    renamed = carry.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        F.col(SEGMENT).alias("__at"),
        *[c for c in carry.columns if c not in keys and c != SEGMENT],
    )
    condition = F.col(SEGMENT) == F.col("__at")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    if segments.count <= (BROADCAST_ROWS if _fixed_width(carry.schema) else BROADCAST_ROWS // 100):
        renamed = F.broadcast(renamed)
    return rows.join(renamed, condition, "left").drop("__at", *[f"__key_{k}" for k in keys])


def extend(
    segments: Segments, keys: list[str], order: list[str], reverse: bool = False, **columns: Running
) -> Segments:
    """Add running aggregates per key in the given order (descending if ``reverse``).

    ``order`` is what the segments are cut on; it must be a total order within a key.
    """
    rows = segments.frame
    if not segments.count:
        ordered = _window(keys, order, reverse)
        return Segments(rows.withColumns({n: _local(s, ordered) for n, s in columns.items()}), 0)
    ordered = _window([*keys, SEGMENT], order, reverse)
    local = rows.withColumns({n: _local(s, ordered) for n, s in columns.items()})
    sums = (
        rows.where(HOT)
        .groupBy(*keys, SEGMENT)
        .agg(*[AGGREGATE[s.kind](s.column).alias(f"__sum_{n}") for n, s in columns.items()])
    )
    earlier = _window(keys, [SEGMENT], reverse).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        *keys,
        SEGMENT,
        *[AGGREGATE[s.kind](f"__sum_{n}").over(earlier).alias(f"__carry_{n}") for n, s in columns.items()],
    )
    combined = {n: _combine(s.kind, F.col(f"__carry_{n}"), F.col(n)) for n, s in columns.items()}
    joined = attach(local, carry, keys, segments).withColumns(combined)
    return segments._replace(frame=joined.drop(*[f"__carry_{n}" for n in columns]))


def look_back(
    segments: Segments,
    keys: list[str],
    order: list[str],
    columns: dict[str, tuple[Column, int]],
    reverse: bool = False,
) -> Segments:
    """Add ``name -> value of the row that is ``offset`` rows earlier`` (later if ``reverse``)."""
    if not columns:
        return segments
    rows = segments.frame
    ordered = _window([*keys, SEGMENT] if segments.count else keys, order, reverse)
    lags = {n: F.lag(c, k).over(ordered) for n, (c, k) in columns.items()}
    if not segments.count:
        return Segments(rows.withColumns(lags), 0)
    depth = max(k for _, k in columns.values())
    item = F.struct(*[c.alias(n) for n, (c, _) in columns.items()])
    # The last `depth` rows of every segment, then those of the `depth` segments before it.
    from_end = F.row_number().over(_window([*keys, SEGMENT], order, not reverse))
    tails = (
        rows.where(HOT)
        .select(*keys, SEGMENT, item.alias("__item"), from_end.alias("__back"))
        .where(F.col("__back") <= depth)
        .groupBy(*keys, SEGMENT)
        .agg(F.sort_array(F.collect_list(F.struct("__back", "__item")), asc=False).alias("__tail"))
    )
    earlier = _window(keys, [SEGMENT], reverse).rowsBetween(-depth, -1)
    carry = tails.select(
        *keys, SEGMENT, F.flatten(F.collect_list("__tail").over(earlier)).alias(CARRIED)
    )
    local = rows.withColumns({LOCAL_ROW: F.row_number().over(ordered), **lags})
    place = {n: F.size(CARRIED) - (F.lit(k + 1) - F.col(LOCAL_ROW)) for n, (_, k) in columns.items()}
    picked = {
        n: F.when(F.col(LOCAL_ROW) > k, F.col(n)).otherwise(F.get(F.col(CARRIED), place[n])["__item"][n])
        for n, (_, k) in columns.items()
    }
    joined = attach(local, carry, keys, segments).withColumns(picked)
    return segments._replace(frame=joined.drop(LOCAL_ROW, CARRIED))


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    reverse: bool = False,
    hot: HotKeys | None = None,
    **columns: Running,
) -> DataFrame:
    """``extend`` on rows that are not cut yet. ``hot`` names the hot keys if they are known."""
    return extend(segmented(df, keys, order, hot), keys, order, reverse, **columns).plain()


def neighbours(
    df: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[Column, int]], reverse: bool = False
) -> DataFrame:
    """``look_back`` on rows that are not cut yet."""
    return look_back(segmented(df, keys, order), keys, order, columns, reverse).plain()
