"""Event patterns per key, matched in event-time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import interval
from tidemark.plans.scans import extend, highest, look_back, lowest, neighbours, running, total
from tidemark.plans.skew import segmented

STEP_NAMES = ["first", "second", "third", "fourth", "fifth", "sixth"]


def _step_column(i: int) -> str:
    return f"{STEP_NAMES[i] if i < len(STEP_NAMES) else f'step_{i + 1}'}_ts"


def strict_sequence(
    df: DataFrame, key: str, order: list[str], steps: list[Column], ts: str
) -> DataFrame:
    """Rows that meet the steps' conditions one directly after the other; matches may overlap.

    Gives the key and one event time per step, named first_ts to sixth_ts, then step_7_ts and so on.
    """
    last = len(steps) - 1
    back = {}
    for i, condition in enumerate(steps[:-1]):
        back[f"__ok{i}"] = (condition, last - i)
        back[f"__ts{i}"] = (F.col(ts), last - i)
    seen = neighbours(df, [key], order, back)
    met = steps[-1]
    for i in range(last):
        met = met & F.col(f"__ok{i}")
    times = [F.col(f"__ts{i}").alias(_step_column(i)) for i in range(last)]
    return seen.where(met).select(key, *times, F.col(ts).alias(_step_column(last)))


def repeated(df: DataFrame, key: str, order: list[str], condition: Column, times: int, ts: str) -> DataFrame:
    """Rows that end a run of at least ``times`` rows meeting the condition.

    The row itself meets it, and the last row before it that does not is ``times`` rows back or more:
    the run is measured by position, so ``times`` may be any number.
    """
    cut = segmented(df, [key], order)
    placed = extend(cut, [key], order, __nth=total(F.lit(1)))
    broken = F.when(condition, F.lit(None)).otherwise(F.col("__nth"))
    runs = extend(placed, [key], order, __broken=highest(broken))
    length = F.col("__nth") - F.coalesce("__broken", F.lit(0))
    first = look_back(runs, [key], order, {"first_ts": (F.col(ts), times - 1)}).plain()
    return first.where(condition & (length >= times)).select(
        key, "first_ts", F.col(ts).alias("last_ts")
    )


def followed_by(
    df: DataFrame, key: str, order: list[str], begin: Column, end: Column, ts: str, within: str
) -> DataFrame:
    """Each ``begin`` row with the next ``end`` row of its key, other rows between them allowed.

    ``status`` is matched if that row comes less than ``within`` later, else timeout.
    """
    following = lowest(F.when(end, F.col(ts)), before=True)
    ahead = running(df, [key], order, reverse=True, __next=following).where(begin)
    in_time = F.col("__next") < F.col(ts) + interval(within)
    return ahead.select(
        key,
        *[c for c in order if c != ts],
        F.col(ts).alias("begin_ts"),
        F.when(in_time, F.col("__next")).alias("end_ts"),
        F.when(in_time, F.lit("matched")).otherwise(F.lit("timeout")).alias("status"),
    )


def alerts_by_arrival(df: DataFrame, key: str, arrival: str, failed: Column, times: int = 3) -> DataFrame:
    """A machine fed in arrival order: alerts at each failure from the ``times``-th in a row on.

    Any other row sets it back to its start.
    """
    back = {f"__f{i}": (failed, i) for i in range(1, times)}
    seen = neighbours(df, [key], [arrival], back)
    met = failed
    for column in back:
        met = met & F.col(column)
    return seen.where(met).drop(*back)
