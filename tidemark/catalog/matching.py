"""Event-pattern queries; an error event plays the failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import machine, patterns


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")


@query(
    "pattern_strict",
    """
    SELECT user_id, ts AS first_ts, lead(ts) OVER w AS second_ts, lead(ts, 2) OVER w AS third_ts
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    QUALIFY event_type = 'error' AND lead(event_type) OVER w = 'error'
        AND lead(event_type, 2) OVER w = 'error'
    """,
)
def pattern_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return patterns.strict_sequence(
        _events(spark, sf_dir), "user_id", ["ts", "event_id"], [failed, failed, failed], "ts"
    )


@query(
    "pattern_times",
    """
    SELECT user_id, ts AS first_ts, lead(ts, 2) OVER w AS last_ts
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    QUALIFY event_type = 'error' AND lead(event_type) OVER w = 'error'
        AND lead(event_type, 2) OVER w = 'error'
    """,
)
def pattern_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return patterns.repeated(_events(spark, sf_dir), "user_id", ["ts", "event_id"], failed, 3, "ts")


FOLLOWED_SQL = """
    WITH ahead AS (
      SELECT user_id, event_id, event_type, ts AS begin_ts,
             min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
               PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts
      FROM events)
"""


def _followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.followed_by(
        _events(spark, sf_dir),
        "user_id",
        ["ts", "event_id"],
        F.col("event_type") == "signup",
        F.col("event_type") == "purchase",
        "ts",
        "6 hours",
    )


@query(
    "pattern_within",
    f"""
    {FOLLOWED_SQL}
    SELECT user_id, event_id, begin_ts, next_ts AS end_ts FROM ahead
    WHERE event_type = 'signup' AND next_ts < begin_ts + INTERVAL 6 HOUR
    """,
)
def pattern_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = _followed(spark, sf_dir).where(F.col("status") == "matched")
    return matched.select("user_id", "event_id", "begin_ts", "end_ts")


@query(
    "pattern_timeout",
    f"""
    {FOLLOWED_SQL}
    SELECT user_id, event_id, begin_ts FROM ahead
    WHERE event_type = 'signup' AND coalesce(next_ts >= begin_ts + INTERVAL 6 HOUR, true)
    """,
)
def pattern_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed_out = _followed(spark, sf_dir).where(F.col("status") == "timeout")
    return timed_out.select("user_id", "event_id", "begin_ts")


@query(
    "state_machine",
    """
    SELECT event_id, user_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
    QUALIFY event_type = 'error' AND lag(event_type) OVER w = 'error'
        AND lag(event_type, 2) OVER w = 'error'
    """,
)
def state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    alerts = patterns.alerts_by_arrival(_events(spark, sf_dir), "user_id", "event_id", failed)
    return alerts.select("event_id", "user_id")


#: A buyer's way: (state, event) -> (next state, whether to alert). Any other event leads back to idle.
WAY = {
    ("idle", "view"): ("looked", False),
    ("looked", "view"): ("looked", False),
    ("looked", "click"): ("chosen", False),
    ("looked", "error"): ("failed", False),
    ("chosen", "click"): ("chosen", False),
    ("chosen", "view"): ("looked", False),
    ("chosen", "purchase"): ("bought", True),
    ("chosen", "error"): ("failed", True),
    ("failed", "error"): ("failed", True),
    ("failed", "view"): ("looked", False),
    ("bought", "purchase"): ("bought", True),
    ("bought", "view"): ("looked", False),
}
WAY_ROWS = ", ".join(f"('{s}', '{e}', '{n}', {str(a).lower()})" for (s, e), (n, a) in WAY.items())


@query(
    "state_machine_table",
    f"""
    WITH RECURSIVE way(state, symbol, next, alert) AS (VALUES {WAY_ROWS}),
    placed AS (
      SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i
      FROM events),
    walk AS (
      SELECT event_id, user_id, i, coalesce(next, 'idle') AS state, coalesce(alert, false) AS alert
      FROM placed LEFT JOIN way ON way.state = 'idle' AND symbol = event_type WHERE i = 1
      UNION ALL
      SELECT p.event_id, p.user_id, p.i, coalesce(next, 'idle'), coalesce(way.alert, false)
      FROM walk w JOIN placed p ON p.user_id IS NOT DISTINCT FROM w.user_id AND p.i = w.i + 1
      LEFT JOIN way ON way.state = w.state AND symbol = p.event_type)
    SELECT event_id, user_id, state, alert FROM walk
    """,
)
def state_machine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ran = machine.run_machine(_events(spark, sf_dir), "user_id", ["ts", "event_id"], "event_type", WAY, "idle")
    return ran.select("event_id", "user_id", "state", "alert")
