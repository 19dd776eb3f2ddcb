"""Queries that join or co-group two inputs.

Pairs are taken between orders and their line items: each line item has one order, so the number of
pairs grows with the tables and not with the square of a key's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import joins


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("ts"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linenumber").alias("line"),
    )


@query(
    "window_join",
    """
    SELECT o_orderkey AS orderkey, o_orderdate AS left_ts, l_shipdate AS right_ts,
           l_linenumber AS right_line,
           make_timestamp(epoch_us(o_orderdate) - epoch_us(o_orderdate) % (86400000000 * 365)) AS window_start
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      AND epoch_us(o_orderdate) // (86400000000 * 365) = epoch_us(l_shipdate) // (86400000000 * 365)
    """,
)
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.window_join(_orders(spark, sf_dir), _items(spark, sf_dir), "orderkey", "ts", "365 days")


@query(
    "interval_join",
    """
    SELECT o_orderkey AS orderkey, o_orderdate AS left_ts, l_shipdate AS right_ts, l_linenumber AS right_line
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 90 DAY
    """,
)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.interval_join(
        _orders(spark, sf_dir), _items(spark, sf_dir), "orderkey", "ts", "30 days", "90 days"
    )


@query(
    "reconcile",
    """
    WITH shipped AS (SELECT l_orderkey, min(l_shipdate) AS ts FROM lineitem GROUP BY l_orderkey)
    SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, o_orderdate AS left_ts, ts AS right_ts,
           CASE WHEN ts IS NULL THEN 'missing_right' WHEN o_orderdate IS NULL THEN 'missing_left'
                ELSE 'matched' END AS status
    FROM orders FULL JOIN shipped ON o_orderkey = l_orderkey
      AND ts BETWEEN o_orderdate - INTERVAL 180 DAY AND o_orderdate + INTERVAL 180 DAY
    """,
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = _items(spark, sf_dir).groupBy("orderkey").agg(F.min("ts").alias("ts"))
    return joins.reconcile(_orders(spark, sf_dir), shipped, "orderkey", "ts", "180 days")


@query(
    "regular_join",
    """
    SELECT o_orderkey AS orderkey, o_orderdate AS left_ts, l_shipdate AS right_ts,
           l_linenumber AS right_line,
           CASE WHEN o_orderdate < l_shipdate THEN 'right' ELSE 'left' END AS last
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def regular_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.regular_join(_orders(spark, sf_dir), _items(spark, sf_dir), "orderkey", "ts")


@query(
    "window_cogroup",
    """
    WITH placed AS (
      SELECT user_id, event_id, ts, event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
             (row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 6 HOUR, ts), event_type
                                 ORDER BY ts, event_id) - 1) // 100000 AS chunk
      FROM events WHERE event_type IN ('click', 'purchase'))
    SELECT user_id, window_start, chunk,
           coalesce(string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id)
                      FILTER (event_type = 'click'), '') AS clicks,
           coalesce(string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id)
                      FILTER (event_type = 'purchase'), '') AS purchases
    FROM placed GROUP BY user_id, window_start, chunk
    """,
)
def window_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = events.where(F.col("event_type") == "click")
    purchases = events.where(F.col("event_type") == "purchase")
    grouped = joins.window_cogroup(
        clicks, purchases, "user_id", "ts", "6 hours", "event_id", tie="event_id", chunk_rows=100_000
    )
    return grouped.select(
        "user_id",
        "window_start",
        "chunk",
        F.array_join(F.col("left_items").cast("array<string>"), ",").alias("clicks"),
        F.array_join(F.col("right_items").cast("array<string>"), ",").alias("purchases"),
    )


@query(
    "sequence_rules",
    """
    WITH steps AS (
      SELECT user_id, event_id, event_type AS action2,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS action1
      FROM events)
    SELECT * FROM steps
    WHERE (action1, action2) IN (('signup', 'click'), ('click', 'purchase'))
    """,
)
def sequence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES ('signup', 'click'), ('click', 'purchase') AS r(action1, action2)")
    events = table(spark, sf_dir, "events")
    return joins.sequence_rules(events, rules, "user_id", "event_id", "event_type")


@query(
    "rules_in_force",
    """
    WITH steps AS (
      SELECT user_id, event_id, event_type AS action2,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS action1
      FROM events WHERE event_type <> 'signup'),
    rules AS (
      SELECT event_id AS rule_event_id,
             CASE event_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'view' END AS first,
             CASE event_id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'purchase' ELSE 'error' END AS second
      FROM events WHERE event_type = 'signup')
    SELECT user_id, event_id, action1, action2, rule_event_id
    FROM steps ASOF JOIN rules ON event_id >= rule_event_id
    WHERE action1 = first AND action2 = second
    """,
)
def rules_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signup replaces the rule that the other events are held against from then on."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    turn = F.pmod("event_id", F.lit(3))
    rules = events.where(F.col("event_type") == "signup").select(
        "event_id",
        F.when(turn == 1, "click").otherwise("view").alias("action1"),
        F.when(turn == 0, "click").when(turn == 1, "purchase").otherwise("error").alias("action2"),
    )
    actions = events.where(F.col("event_type") != "signup")
    return joins.rules_in_force(actions, rules, "user_id", "event_id", "event_type", "event_id")


@query(
    "window_cogroup_items",
    """
    SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
           CASE event_type WHEN 'click' THEN 'left' ELSE 'right' END AS side,
           row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 6 HOUR, ts), event_type
                              ORDER BY ts, event_id) - 1 AS position,
           event_id
    FROM events WHERE event_type IN ('click', 'purchase')
    """,
)
def window_cogroup_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks, purchases = (events.where(F.col("event_type") == kind) for kind in ("click", "purchase"))
    return joins.window_cogroup_items(clicks, purchases, "user_id", "ts", "6 hours", "event_id", tie="event_id")
