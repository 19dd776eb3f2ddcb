"""Projection, filter, routing, partitioning and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.functions.aggregates import register_sql_functions, weighted_average
from tidemark.functions.strings import string_hash
from tidemark.functions.times import (
    format_time,
    millis,
    millis_timestamp,
    parse_millis,
    seconds_timestamp,
)
from tidemark.operators import partitioning, transforms


@query(
    "word_count",
    """
    SELECT word, count(*) AS cnt FROM (
      SELECT unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
                         ELSE string_split(rtrim(text, ' '), ' ') END) AS word
      FROM documents)
    GROUP BY word
    """,
)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.word_count(table(spark, sf_dir, "documents"), "text")


@query(
    "project_filter",
    "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'",
)
def project_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type") == "click").select("event_id", "user_id", "event_type")


@query(
    "sql_select",
    "SELECT event_type AS url, user_id AS usr, ts FROM events WHERE event_type = 'purchase'",
)
def sql_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT event_type AS url, user_id AS usr, ts FROM {events} WHERE event_type = 'purchase'",
        events=table(spark, sf_dir, "events"),
    )


@query(
    "flat_map_fields",
    """
    SELECT event_id, CAST(user_id AS VARCHAR) AS field FROM events
      WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT event_id, CAST(epoch_us(ts) // 1000 AS VARCHAR) FROM events WHERE event_type = 'purchase'
    """,
)
def flat_map_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    cases = [
        (F.col("event_type") == "click", [user]),
        (
            F.col("event_type") == "purchase",
            [user, F.col("event_type"), millis(F.col("ts")).cast("string")],
        ),
    ]
    return transforms.flat_map(table(spark, sf_dir, "events"), cases, "field", ["event_id"])


@query(
    "conditional_emit",
    """
    SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'
    """,
)
def conditional_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return transforms.emit_times(events, times)


@query("string_length", "SELECT page_id, CAST(length(url) AS INTEGER) AS url_length FROM pages")
def string_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.length("url").alias("url_length"))


@query(
    "side_output_split",
    """
    SELECT 'main' AS tag, event_id, concat_ws(',', user_id, event_type) AS value FROM events
    UNION ALL SELECT 'errors', event_id, concat_ws(':', event_type, user_id) FROM events
      WHERE event_type = 'error'
    """,
)
def side_output_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct("event_id", F.concat_ws(",", "user_id", "event_type").alias("value"))
    error = F.struct("event_id", F.concat_ws(":", "event_type", "user_id").alias("value"))
    outputs = {"main": (F.lit(True), body), "errors": (F.col("event_type") == "error", error)}
    tagged = transforms.tagged_outputs(table(spark, sf_dir, "events"), outputs, value="body")
    return tagged.select("tag", "body.event_id", "body.value")


@query(
    "computed_event_time",
    """
    SELECT event_id, (epoch_us(ts) // 1000) AS millis, date_trunc('second', ts) AS et,
           CAST(make_timestamp((epoch_us(ts) // 1000) * 1000) AS TIMESTAMP) AS rowtime
    FROM events
    """,
)
def computed_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", millis(F.col("ts")).alias("millis"))
    return events.withColumns(
        {"et": seconds_timestamp(F.col("millis")), "rowtime": millis_timestamp(F.col("millis"))}
    )


@query(
    "time_format",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
           epoch_us(date_trunc('second', ts) - INTERVAL 8 HOUR) // 1000 AS millis_at_8
    FROM events
    """,
)
def time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "events").select("event_id", format_time(F.col("ts")).alias("text"))
    return text.withColumn("millis_at_8", parse_millis(F.col("text")))


@query(
    "partition_custom",
    "SELECT event_id, CAST(event_id % 16 AS INTEGER) AS partition FROM events",
)
def partition_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id")
    placed = partitioning.by_partition_number(events, 16, F.pmod("event_id", F.lit(16)))
    return partitioning.with_partition(placed)


@query(
    "partition_spread",
    """
    SELECT kind, count(*) AS rows, CAST(16 AS BIGINT) AS partitions, true AS even
    FROM events, (VALUES ('round_robin'), ('shuffled')) AS k(kind) GROUP BY kind
    """,
)
def partition_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are kept and no partition has over twice the mean, dealt in turn or at random."""
    events = table(spark, sf_dir, "events").select("event_id")
    kinds = {
        "round_robin": partitioning.round_robin(events, 16),
        "shuffled": partitioning.shuffled(events, 16),
    }
    out = None
    for kind, spread in kinds.items():
        sizes = partitioning.partition_sizes(spread)
        row = sizes.agg(
            F.lit(kind).alias("kind"),
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("partitions"),
            (F.max("rows") <= 2 * F.avg("rows")).alias("even"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "partition_replicate",
    """
    SELECT CAST(r AS INTEGER) AS replica, count(*) AS rows, CAST(sum(event_id) AS DECIMAL(38,0))::VARCHAR AS id_sum
    FROM events, range(4) AS t(r) GROUP BY r
    """,
)
def partition_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id")
    id_sum = F.sum(F.col("event_id").cast("decimal(20,0)")).cast("string")
    return (
        partitioning.replicated(events, 4)
        .groupBy("replica")
        .agg(F.count(F.lit(1)).alias("rows"), id_sum.alias("id_sum"))
    )


@query(
    "string_hash",
    """
    WITH folded AS (
      SELECT page_id, url, list_reduce(
        list_prepend(CAST(0 AS BIGINT), list_transform(
          string_split(url, ''), lambda c: CAST(unicode(c) AS BIGINT))),
        lambda h, c: (h * 31 + c) % 4294967296) AS h
      FROM pages)
    SELECT page_id, url, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS hash
    FROM folded
    """,
)
def string_hash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", string_hash(F.col("url")).alias("hash"))


@query(
    "sql_string_hash",
    """
    WITH kinds AS (SELECT DISTINCT event_type FROM events),
    folded AS (
      SELECT event_type, list_reduce(
        list_prepend(CAST(0 AS BIGINT), list_transform(
          string_split(event_type, ''), lambda c: CAST(unicode(c) AS BIGINT))),
        lambda h, c: (h * 31 + c) % 4294967296) AS h
      FROM kinds)
    SELECT event_id, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS hash
    FROM events JOIN folded USING (event_type)
    """,
)
def sql_string_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hash called as a registered function from SQL."""
    register_sql_functions(spark)
    return spark.sql(
        "SELECT event_id, string_hash(event_type) AS hash FROM {events}",
        events=table(spark, sf_dir, "events"),
    )


LATERAL_SQL = """
    SELECT page_id, word, CAST(length(word) AS INTEGER) AS length FROM (
      SELECT page_id, unnest(CASE WHEN url <> '' AND rtrim(url, '?') = '' THEN CAST([] AS VARCHAR[])
                                  ELSE string_split(rtrim(url, '?'), '?') END) AS word
      FROM pages)
"""


@query("lateral_split", LATERAL_SQL)
def lateral_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.lateral_split(table(spark, sf_dir, "pages"), "url", "?", ["page_id"])


@query("sql_lateral_split", LATERAL_SQL)
def sql_lateral_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pieces through a registered table function and a lateral join."""
    register_sql_functions(spark)
    return spark.sql(
        "SELECT page_id, t.word, t.length FROM {pages}, LATERAL split_words(url, '?') AS t",
        pages=table(spark, sf_dir, "pages"),
    )


@query(
    "weighted_average",
    """
    SELECT l_suppkey, CAST(sum(CAST(l_partkey AS HUGEINT) * CAST(l_quantity AS BIGINT))
             // nullif(sum(CAST(l_quantity AS BIGINT)), 0) AS BIGINT) AS avg_partkey
    FROM lineitem GROUP BY l_suppkey
    """,
)
def weighted_average_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = weighted_average(F.col("l_partkey"), F.col("l_quantity").cast("bigint"))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(average.alias("avg_partkey"))
