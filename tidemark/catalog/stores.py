"""Queries that shape rows for keyed stores and buffers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import keyed_state
from tidemark.sinks import shapes


@query(
    "latest_per_key",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.latest_per_key(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@query(
    "json_documents",
    """
    SELECT event_id, '{"' || CAST(user_id AS VARCHAR) || '":"' || event_type || '"}' AS document FROM events
    """,
)
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    document = shapes.json_document(F.col("user_id").cast("string"), F.col("event_type"))
    return events.select("event_id", document.alias("document"))


@query(
    "cell_upsert",
    """
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS rowkey, 'info' AS family, event_type AS qualifier,
           '1' AS value
    FROM events
    """,
)
def cell_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return shapes.cells(events, F.col("user_id").cast("string"), "info", F.col("event_type"))


BUFFERED_SQL = """
WITH placed AS (
  SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 AS nth,
         count(*) OVER () AS n
  FROM events)
SELECT event_id, user_id, nth // 10 AS batch_id, nth % 10 AS position FROM placed
WHERE nth < n // 10 * 10
"""


@query(
    "buffered_batches",
    BUFFERED_SQL,
)
def buffered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return keyed_state.buffered(events, ["event_id"], 10)
