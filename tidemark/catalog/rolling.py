"""Grouped and rolling aggregates, ranking, and per-key state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import keyed_state, rolling, topn


@query("sql_group_count", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def sql_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT user_id, count(1) AS cnt FROM {events} GROUP BY user_id",
        events=table(spark, sf_dir, "events"),
    )


@query(
    "rolling_count",
    """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS cnt FROM events
    """,
)
def rolling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return rolling.rolling_count(events, "user_id", "event_id")


@query(
    "rolling_max",
    """
    SELECT event_id, user_id, first_value(event_type) OVER w AS event_type, max(value) OVER w AS value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
    """,
)
def rolling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return rolling.rolling_max(events, "user_id", "event_id", "value", ["event_type"])


@query(
    "rolling_max_by",
    """
    WITH best AS (
      SELECT event_id, user_id,
             max({'v': value, 'e': -event_id, 't': event_type})
               OVER (PARTITION BY user_id ORDER BY event_id) AS b
      FROM events)
    SELECT event_id, user_id, b.t AS event_type, b.v AS value FROM best
    """,
)
def rolling_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return rolling.rolling_max_by(events, "user_id", "event_id", "value", ["event_type"])


@query(
    "most_active_user",
    """
    WITH counted AS (
      SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS cnt
      FROM events),
    best AS (
      SELECT event_id, max({'c': cnt, 'e': event_id, 'u': user_id}) OVER (ORDER BY event_id) AS b
      FROM counted)
    SELECT event_id, b.u AS active_user_id, b.c AS active_cnt FROM best
    """,
)
def most_active_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.most_active(table(spark, sf_dir, "events"), "user_id", "event_id")


@query(
    "final_most_active_user",
    """
    SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id
    ORDER BY cnt DESC, max(event_id) DESC LIMIT 1
    """,
)
def final_most_active_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.final_most_active(table(spark, sf_dir, "events"), "user_id", "event_id")


@query(
    "every_nth_average",
    """
    SELECT * FROM (
      SELECT user_id, event_id, count(*) OVER w AS cnt,
             CAST(sum(epoch_us(ts) // 1000) OVER w // count(*) OVER w AS BIGINT) AS avg_millis
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    WHERE cnt % 5 = 0
    """,
)
def every_nth_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.every_nth_average(table(spark, sf_dir, "events"), "user_id", "event_id", "ts")


@query(
    "topn_global",
    """
    SELECT user_id, cnt, row_number() OVER (ORDER BY cnt DESC, user_id) AS row_num FROM (
      SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id
      ORDER BY cnt DESC, user_id LIMIT 2)
    """,
)
def topn_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    counts = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return topn.top_n(counts, "user_id", 2)


EVENT_TIMERS_SQL = """
SELECT user_id, 'row' AS kind, ts AS "at" FROM events
UNION ALL
SELECT DISTINCT user_id, 'timer', ts + INTERVAL 1 HOUR FROM events
"""


@query(
    "event_timers",
    EVENT_TIMERS_SQL,
)
def event_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_state.event_timers(table(spark, sf_dir, "events"), "user_id", "ts", "1 hour")


@query(
    "periodic_totals",
    """
    WITH RECURSIVE asked(user_id, t) AS (
      SELECT user_id, min(ts) FROM events GROUP BY user_id
      UNION ALL
      SELECT a.user_id, min(e.ts) FROM asked a JOIN events e
        ON e.user_id = a.user_id AND e.ts > a.t + INTERVAL 6 HOUR
      GROUP BY a.user_id)
    SELECT a.user_id, epoch_us(a.t + INTERVAL 6 HOUR) AS fire_at, count(*) AS total
    FROM asked a JOIN events e ON e.user_id = a.user_id AND e.ts <= a.t + INTERVAL 6 HOUR
    GROUP BY a.user_id, a.t
    """,
)
def periodic_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_state.periodic_totals(table(spark, sf_dir, "events"), "user_id", "ts", "6 hours")


@query(
    "ttl_count",
    """
    WITH gaps AS (
      SELECT event_id, user_id, ts,
             coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                        + INTERVAL 6 HOUR, true) AS fresh
      FROM events),
    runs AS (
      SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
      FROM gaps)
    SELECT event_id, user_id, ts,
           count(*) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS cnt
    FROM runs
    """,
)
def ttl_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return keyed_state.ttl_count(events, "user_id", "ts", "event_id", "6 hours")


@query(
    "changelog_retract",
    """
    WITH counted AS (
      SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS cnt FROM events)
    SELECT event_id, user_id, CASE WHEN cnt = 1 THEN '+I' ELSE '+U' END AS kind, cnt FROM counted
    UNION ALL
    SELECT event_id, user_id, '-U', cnt - 1 FROM counted WHERE cnt > 1
    """,
)
def changelog_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.count_changelog(table(spark, sf_dir, "events"), "user_id", "event_id")


@query(
    "changelog_histogram",
    """
    SELECT cnt, count(*) AS keys FROM (SELECT count(*) AS cnt FROM events GROUP BY user_id) GROUP BY cnt
    """,
)
def changelog_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate over the changelog of another: users by their count of events."""
    changes = rolling.count_changelog(table(spark, sf_dir, "events"), "user_id", "event_id")
    return rolling.keys_per_count(changes)
