"""Composition along the segments of a key: what an order-dependent step needs to know of everything before it.

A step whose effect over a stretch of rows can be written as a value with an associative ``combine`` (a map from state
to state, a table of costs between states) does not have to walk a key from its first row. Each segment gives its
value; here the values are composed along the segments, ``FAN`` at a time, level by level, so a key with any number
of segments is never one task's work; then each segment knows what comes before it and runs on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values composed by one task in one step.
FAN = 256

AT, VALUE, BLOCK, BEFORE = "__at", "__value", "__block", "__before"


def _listed(level: DataFrame, keys: list[str], fan: int, forward: bool) -> DataFrame:
    """A row for each block of ``fan`` neighbours of a key, with their values in order."""
    blocks = level.groupBy(*keys, F.floor(F.col(AT) / fan).alias(BLOCK))
    return blocks.agg(F.sort_array(F.collect_list(F.struct(AT, VALUE)), asc=forward).alias("__list"))


def composed(
    parts: DataFrame,
    keys: list[str],
    at: str,
    value: str,
    combine: Callable[[Column, Column], Column],
    start: Column,
    most: int,
    reverse: bool = False,
    fan: int = FAN,
) -> DataFrame:
    """(keys, ``at``, ``__before``): the values of the segments before each one, composed; ``start`` for the first.

    ``parts`` has a row for each segment: its keys (nulls are a key like any other), its number ``at`` from 0 up,
    unique in a key but not necessarily gapless, and its value. ``combine(so_far, next)`` is associative and ``start`` its
    neutral element. With ``reverse`` the segments after each one are composed, from the last backwards.
    ``most`` is at least the highest number plus one. ``parts`` is read once for each level, so cut it first.
    """
    if fan < 2:
        raise ValueError("fan is at least 2")
    level = parts.select(*keys, F.col(at).cast("bigint").alias(AT), F.col(value).alias(VALUE))
    levels = [_listed(level, keys, fan, not reverse)]
    while most > fan:
        most = ceil(most / fan)
        whole = F.aggregate("__list", start, lambda so_far, x: combine(so_far, x[VALUE]))
        level = levels[-1].select(*keys, F.col(BLOCK).alias(AT), whole.alias(VALUE))
        levels.append(_listed(level, keys, fan, not reverse))
    entering = levels[-1].withColumn(BEFORE, start)
    for lower in [*reversed(levels[:-1]), None]:
        steps = F.aggregate(
            "__list",
            F.array(F.col(BEFORE)),
            lambda so_far, x: F.concat(so_far, F.array(combine(F.element_at(so_far, -1), x[VALUE]))),
        )
        pairs = F.arrays_zip(F.col("__list").getField(AT).alias(AT), F.slice(steps, 1, F.size("__list")).alias(BEFORE))
        each = entering.select(*keys, F.explode(pairs).alias("__pair")).select(*keys, f"__pair.{AT}", f"__pair.{BEFORE}")
        if lower is None:
            return each.withColumnRenamed(AT, at)
        named = each.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col(AT).alias("__of"), BEFORE)
        same = F.col(BLOCK) == F.col("__of")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
        entering = lower.join(named, same).drop("__of", *[f"__key_{k}" for k in keys])
    raise AssertionError("unreachable")


def then(first: Column, second: Column) -> Column:
    """Maps of states 0, 1, ... to states, as arrays: ``first`` and after it ``second``."""
    return F.transform(first, lambda state: F.get(second, state.cast("int")))
