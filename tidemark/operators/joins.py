"""Joins of two event frames.

No join here forces a physical form: sort-merge with adaptive skew splitting is left to Spark. Where a
time range limits the pairs and keys are large, rows also meet on time slots, so that the range, not
the key alone, decides which rows are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import duration_micros, interval, micros, window_start
from tidemark.plans.scans import extend, highest, lowest, neighbours, running, total
from tidemark.plans.skew import segmented


def _labelled(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def _same(key: str) -> Column:
    return F.col(f"left_{key}") == F.col(f"right_{key}")


def _merge_key(joined: DataFrame, key: str) -> DataFrame:
    return joined.withColumnRenamed(f"left_{key}", key).drop(f"right_{key}")


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str) -> DataFrame:
    """Pairs with the same key in the same tumbling window; columns become left_*, right_*.

    The window is part of the join key, so a hot key is spread over its windows. Batch or streaming.
    """
    l = _windowed(_labelled(left, "left"), f"left_{ts}", size, "__window")
    r = _windowed(_labelled(right, "right"), f"right_{ts}", size, "__right_window")
    joined = l.join(r, _same(key) & (F.col("__window") == F.col("__right_window")))
    placed = joined.withColumn("window_start", F.col("__window.start"))
    return _merge_key(placed.drop("__window", "__right_window"), key)


def _windowed(df: DataFrame, ts: str, size: str, name: str) -> DataFrame:
    out = df.withColumn(name, F.window(ts, size))
    if df.isStreaming:
        # A stream may have one watermarked column: the window keeps the mark, the time loses it.
        out = out.withColumn(ts, F.timestamp_micros(F.unix_micros(ts)))
    return out


def regular_join(left: DataFrame, right: DataFrame, key: str, arrival: str) -> DataFrame:
    """All pairs with the same key, whenever they came; ``last`` names the side that came later."""
    joined = _labelled(left, "left").join(_labelled(right, "right"), _same(key))
    later = F.when(F.col(f"left_{arrival}") < F.col(f"right_{arrival}"), "right").otherwise("left")
    return _merge_key(joined.withColumn("last", later), key)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, before: str, after: str
) -> DataFrame:
    """Pairs with the same key and right.ts in [left.ts - before, left.ts + after], both inclusive.

    Stored rows also meet on time slots as wide as the interval: a left row goes to the slots its interval
    touches (two, or one), a right row to its own. Each pair is still found once, rows far apart are never
    compared, and a hot key is spread out. Streams join on the key, as a slot would hide the time bound of state.
    """
    lt, rt = F.col(f"left_{ts}"), F.col(f"right_{ts}")
    near = (rt >= lt - interval(before)) & (rt <= lt + interval(after))
    l, r = _labelled(left, "left"), _labelled(right, "right")
    if left.isStreaming or right.isStreaming:
        return _merge_key(l.join(r, _same(key) & near), key)
    width = F.lit(max(duration_micros(before) + duration_micros(after), 1))
    low = F.floor((micros(lt) - F.lit(duration_micros(before))) / width)
    high = F.floor((micros(lt) + F.lit(duration_micros(after))) / width)
    l = l.withColumn("__slot", F.explode(F.sequence(low, high)))
    r = r.withColumn("__at", F.floor(micros(rt) / width))
    joined = l.join(r, _same(key) & (F.col("__slot") == F.col("__at")) & near)
    return _merge_key(joined.drop("__slot", "__at"), key)


def reconcile(left: DataFrame, right: DataFrame, key: str, ts: str, within: str) -> DataFrame:
    """(key, left_ts, right_ts, status): pairs at most ``within`` apart, and each row without one.

    Stored rows first learn, from the nearest other-side rows before and after them, whether a partner exists;
    those without are reported and the rest take the interval join, so no key is one task's work. Streams take a
    full outer join. A row without a key or a time has no partner.
    """
    l, r = left.select(key, ts), right.select(key, ts)
    if l.isStreaming or r.isStreaming:
        return _outer(l, r, key, ts, within)
    tagged = l.withColumn("side", F.lit("left")).unionByName(r.withColumn("side", F.lit("right")))
    on_left, on_right = (F.when(F.col("side") == s, F.col(ts)) for s in ("left", "right"))
    order = [ts, "side"]
    behind = extend(
        segmented(tagged, [key], order), [key], order, __l0=highest(on_left), __r0=highest(on_right)
    )
    around = extend(behind, [key], order, reverse=True, __l1=lowest(on_left), __r1=lowest(on_right))
    is_left = F.col("side") == "left"
    back = F.when(is_left, F.col("__r0")).otherwise(F.col("__l0"))
    ahead = F.when(is_left, F.col("__r1")).otherwise(F.col("__l1"))
    close = (back >= F.col(ts) - interval(within), ahead <= F.col(ts) + interval(within))
    met = F.coalesce(close[0], F.lit(False)) | F.coalesce(close[1], F.lit(False))
    # A row without a key meets no other.
    judged = around.plain().select(key, ts, "side", (met & F.col(key).isNotNull() & F.col(ts).isNotNull()).alias("__met"))
    missed = judged.where(~F.col("__met")).select(
        key,
        F.when(is_left, F.col(ts)).alias("left_ts"),
        F.when(~is_left, F.col(ts)).alias("right_ts"),
        F.when(is_left, "missing_right").otherwise("missing_left").alias("status"),
    )
    met_left, met_right = (
        judged.where(F.col("__met") & (F.col("side") == s)).select(key, ts) for s in ("left", "right")
    )
    pairs = interval_join(met_left, met_right, key, ts, within, within).select(
        key,
        F.col(f"left_{ts}").alias("left_ts"),
        F.col(f"right_{ts}").alias("right_ts"),
        F.lit("matched").alias("status"),
    )
    return missed.unionByName(pairs)


def _outer(l: DataFrame, r: DataFrame, key: str, ts: str, within: str) -> DataFrame:
    lt, rt = F.col(f"left_{ts}"), F.col(f"right_{ts}")
    near = (rt >= lt - interval(within)) & (rt <= lt + interval(within))
    there = F.lit(True)
    joined = (
        _labelled(l, "left")
        .withColumn("__left", there)
        .join(_labelled(r, "right").withColumn("__right", there), _same(key) & near, "full_outer")
    )
    status = (
        F.when(F.col("__right").isNull(), "missing_right").when(F.col("__left").isNull(), "missing_left").otherwise("matched")
    )
    return joined.select(
        F.coalesce(f"left_{key}", f"right_{key}").alias(key),
        lt.alias("left_ts"),
        rt.alias("right_ts"),
        status.alias("status"),
    )


def window_cogroup_items(
    left: DataFrame, right: DataFrame, key: str, ts: str, size: str, item: str, tie: str | None = None
) -> DataFrame:
    """(key, window_start, side, position, item): both sides' items per key and tumbling window.

    ``side`` is left or right, ``position`` counts a side's items of a window from 0 in the order of time. One
    row per item, so a window of any size is spread over tasks and nothing depends on a limit.
    """
    both, group, order = _both_sides(left, right, key, ts, size, item, tie)
    placed = running(both, group, order, __nth=total(F.lit(1)))
    side = F.when(F.col("__side") == 0, "left").otherwise("right")
    return placed.select(key, "window_start", side.alias("side"), (F.col("__nth") - 1).cast("long").alias("position"), item)


def _both_sides(left, right, key, ts, size, item, tie):
    order = [ts] + ([tie] if tie else [])
    columns = list(dict.fromkeys([key, item, *order]))
    both = left.select(*columns).withColumn("__side", F.lit(0)).unionByName(
        right.select(*columns).withColumn("__side", F.lit(1))
    )
    return both.withColumn("window_start", window_start(F.col(ts), size)), [key, "window_start", "__side"], order


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    size: str,
    item: str,
    tie: str | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Both sides' items per key and tumbling window, ordered by time, as two arrays.

    A step over ``window_cogroup_items`` for windows that fit a row. With ``chunk_rows`` a longer side is given
    in several rows numbered by ``chunk``, of that many items each; chunks of the two sides have nothing to do with each
    other. Without it there is one row, chunk 0, whatever the session's settings. A side without rows has an empty array.
    """
    both, group, order = _both_sides(left, right, key, ts, size, item, tie)
    if chunk_rows:
        placed = running(both, group, order, __nth=total(F.lit(1)))
        both = placed.withColumn("chunk", F.floor((F.col("__nth") - 1) / F.lit(chunk_rows)))
    else:
        both = both.withColumn("chunk", F.lit(0).cast("bigint"))
    entry = F.struct(*dict.fromkeys([*order, item]))

    def items(side: int) -> Column:
        listed = F.sort_array(F.collect_list(F.when(F.col("__side") == side, entry)))
        return F.transform(listed, lambda e: e[item])

    return both.groupBy(key, "window_start", "chunk").agg(
        items(0).alias("left_items"), items(1).alias("right_items")
    )


def sequence_rules(
    actions: DataFrame,
    rules: DataFrame,
    key: str,
    arrival: str,
    action: str,
    mode: str = "all",
    rule_arrival: str | None = None,
) -> DataFrame:
    """Rows whose previous and current action of the key match a rule (action1, action2).

    ``mode="latest"`` keeps only the rule that arrived last. How the rules reach the rows is left to Spark, which
    knows their size when it joins.
    """
    if mode == "latest":
        rules = rules.agg(
            F.max_by(F.struct("action1", "action2"), rule_arrival).alias("rule")
        ).select("rule.action1", "rule.action2")
    elif mode != "all":
        raise ValueError("mode is 'all' or 'latest'")
    rules = rules.select("action1", "action2").distinct()
    steps = neighbours(
        actions.select(key, arrival, action), [key], [arrival], {"action1": (F.col(action), 1)}
    ).withColumnRenamed(action, "action2")
    return steps.join(rules, ["action1", "action2"])


def rules_in_force(
    actions: DataFrame, rules: DataFrame, key: str, arrival: str, action: str, rule_arrival: str, rule_id: str | None = None
) -> DataFrame:
    """Actions that, with the key's action before them, match the rule in force when they arrive.

    In force is the rule (action1, action2) that arrived last at or before the action, for all keys alike; before the
    first one nothing matches. Rules and actions become one order, along which the newest rule is carried as a
    running value, so no action is joined with the rules it could have met. Of rules that arrive together the one with the
    larger actions counts. Rules without an arrival are never in force; rows without a key are a key's like any other.
    """
    steps = neighbours(
        actions.select(key, arrival, action), [key], [arrival], {"action1": (F.col(action), 1)}
    ).withColumnRenamed(action, "action2")
    met = steps.where(F.col("action1").isNotNull() & F.col("action2").isNotNull() & F.col(arrival).isNotNull())
    parts = [F.col(rule_arrival).alias("at"), "action1", "action2", *([F.col(rule_id).alias("id")] if rule_id else [])]
    told = rules.where(F.col(rule_arrival).isNotNull()).select(
        F.col(rule_arrival).alias("__arrived"), F.lit(0).alias("__side"), F.struct(*parts).alias("__rule")
    )
    asked = met.select(F.col(arrival).alias("__arrived"), F.lit(1).alias("__side"), key, "action1", "action2")
    both = asked.unionByName(told, allowMissingColumns=True)
    carried = running(both, [], ["__arrived", "__side"], __force=highest(F.col("__rule")))
    held = (F.col("__side") == 1) & (F.col("__force.action1") == F.col("action1")) & (F.col("__force.action2") == F.col("action2"))
    names = [F.col("__force.at").alias(f"rule_{rule_arrival}")] + ([F.col("__force.id").alias(f"rule_{rule_id}")] if rule_id else [])
    return carried.where(held).select(key, F.col("__arrived").alias(arrival), "action1", "action2", *names)
