"""Window, early-result, watermark and late-data queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.functions.aggregates import register_sql_functions
from tidemark.functions.times import interval
from tidemark.operators import late, topn, windows

SLIDES_SQL = """
    slides AS (
      SELECT *, unnest([time_bucket(INTERVAL 1 HOUR, ts),
                        time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS window_start
      FROM events)
"""


@query(
    "tumbling_count",
    """
    SELECT event_type, count(*) AS cnt, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
    FROM events GROUP BY ALL
    """,
)
def tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_count(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"])


@query(
    "tumble_sql",
    """
    SELECT user_id AS usr, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS end_t, count(*) AS cnt
    FROM events GROUP BY ALL
    """,
)
def tumble_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """
        SELECT user_id AS usr, window.end AS end_t, count(1) AS cnt
        FROM {events} GROUP BY user_id, window(ts, '1 hour')
        """,
        events=table(spark, sf_dir, "events"),
    )


@query(
    "sliding_count",
    f"""
    WITH {SLIDES_SQL}
    SELECT event_type, count(*) AS cnt, window_start, window_start + INTERVAL 2 HOUR AS window_end
    FROM slides GROUP BY ALL
    """,
)
def sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windows.sliding_count(events, "ts", "2 hours", "1 hour", ["event_type"])


@query(
    "sliding_pv_uv",
    f"""
    WITH {SLIDES_SQL}
    SELECT count(*) AS pv, count(DISTINCT user_id) AS uv,
           count(*) / CAST(count(DISTINCT user_id) AS DOUBLE) AS pv_per_uv,
           window_start, window_start + INTERVAL 2 HOUR AS window_end
    FROM slides GROUP BY window_start
    """,
)
def sliding_pv_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_pv_uv(table(spark, sf_dir, "events"), "ts", "2 hours", "1 hour", "user_id")


@query(
    "tumbling_uv",
    """
    SELECT count(DISTINCT user_id) AS uv, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
    FROM events GROUP BY window_start, window_end
    """,
)
def tumbling_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_uv(table(spark, sf_dir, "events"), "ts", "1 hour", "user_id")


CUMULATE_SQL = """
    WITH steps AS (
      SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
             unnest(generate_series(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR,
                                    time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR,
                                    INTERVAL 1 HOUR)) AS window_end
      FROM events)
    SELECT event_type, window_start, window_end, count(*) AS cnt FROM steps GROUP BY ALL
    """


@query("cumulate_window", CUMULATE_SQL)
def cumulate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windows.cumulate_count(events, "ts", "6 hours", "1 hour", ["event_type"])


@query("sql_cumulate_window", CUMULATE_SQL)
def sql_cumulate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report in SQL, through a registered table function."""
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT event_type, w.window_start, w.window_end, count(1) AS cnt
        FROM {events}, LATERAL cumulate_windows(ts, INTERVAL '1' HOUR, INTERVAL '6' HOUR) AS w
        GROUP BY event_type, w.window_start, w.window_end
        """,
        events=table(spark, sf_dir, "events"),
    )


@query(
    "early_firing",
    """
    WITH placed AS (
      SELECT event_type, ts, time_bucket(INTERVAL 6 HOUR, ts) AS window_start FROM events),
    ticks AS (
      SELECT DISTINCT event_type, window_start,
             unnest(generate_series(window_start, window_start + INTERVAL 5 HOUR, INTERVAL 1 HOUR)) AS fired_at
      FROM placed),
    early AS (
      SELECT t.event_type, fired_at, count(*) AS cnt, t.window_start
      FROM ticks t JOIN placed p
        ON p.event_type = t.event_type AND p.window_start = t.window_start AND p.ts <= t.fired_at
      GROUP BY ALL),
    final AS (
      SELECT event_type, window_start + INTERVAL 6 HOUR - INTERVAL 1 MILLISECOND AS fired_at,
             count(*) AS cnt, window_start
      FROM placed GROUP BY event_type, window_start)
    SELECT *, window_start + INTERVAL 6 HOUR AS window_end
    FROM (SELECT * FROM early UNION ALL SELECT * FROM final)
    """,
)
def early_firing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windows.early_firing(events, "ts", "6 hours", "1 hour", ["event_type"])


@query(
    "window_topn",
    """
    WITH counts AS (
      SELECT user_id, count(*) AS cnt, time_bucket(INTERVAL 1 HOUR, ts) AS window_start
      FROM events GROUP BY ALL)
    SELECT user_id, cnt, window_start, window_start + INTERVAL 1 HOUR AS window_end,
           row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS row_num
    FROM counts QUALIFY row_num <= 2
    """,
)
def window_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.window_top_n(table(spark, sf_dir, "events"), "ts", "1 hour", "user_id", 2)


@query(
    "window_topn_sliding",
    f"""
    WITH {SLIDES_SQL},
    counts AS (SELECT event_type, count(*) AS cnt, window_start FROM slides GROUP BY ALL)
    SELECT event_type, cnt, window_start, window_start + INTERVAL 2 HOUR AS window_end,
           row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS row_num
    FROM counts QUALIFY row_num <= 2
    """,
)
def window_topn_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return topn.window_top_n(events, "ts", "2 hours", "event_type", 2, slide="1 hour")


@query(
    "top2_per_window",
    """
    WITH counts AS (
      SELECT user_id, count(*) AS cnt, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
      FROM events GROUP BY ALL)
    SELECT window_end, cnt AS value,
           row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, user_id) AS rank
    FROM counts QUALIFY rank <= 2
    """,
)
def top2_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windows.tumbling_count(table(spark, sf_dir, "events"), "ts", "1 hour", ["user_id"])
    return topn.top_values_per_window(counts, 2)


# The tables' event time rises with event_id, so rows are made to arrive late: by
# (event_id * 37) % 7 hours.
ARRIVED_SQL = "ts + to_hours(CAST((event_id * 37) % 7 AS INTEGER))"
WATERMARK_SQL = f"""
    traced AS (
      SELECT event_id, event_type, ts,
             max(ts) OVER (ORDER BY {ARRIVED_SQL}, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 2 HOUR - INTERVAL 1 MILLISECOND AS watermark,
             {ARRIVED_SQL} AS arrived_at
      FROM events)
"""


def classified_sql(lateness: str) -> str:
    return f"""
    {WATERMARK_SQL},
    placed AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM traced),
    classified AS (
      SELECT *, window_start + INTERVAL 1 HOUR AS window_end,
             CASE WHEN window_start + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND + {lateness} <= watermark
                  THEN 'dropped'
                  WHEN window_start + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND <= watermark THEN 'late'
                  ELSE 'on_time' END AS arrived
      FROM placed)
    """


def arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.pmod(F.col("event_id") * 37, F.lit(7)) * interval("1 hour")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return events.withColumn("arrived_at", F.col("ts") + delay)


ARRIVAL = ["arrived_at", "event_id"]


@query("watermark_trace", f"WITH {WATERMARK_SQL} SELECT event_id, ts, watermark FROM traced")
def watermark_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    traced = late.watermark_trace(arriving(spark, sf_dir), "ts", ARRIVAL, "2 hours")
    return traced.select("event_id", "ts", "watermark")


LATE_REFIRE_SQL = f"""
WITH {classified_sql("INTERVAL 1 HOUR")},
first AS (
  SELECT event_type, window_start, window_end, count(*) AS cnt FROM classified
  WHERE arrived = 'on_time' GROUP BY ALL),
again AS (
  SELECT event_type, window_start, window_end, event_id AS refired_by, arrived,
         count(*) OVER (PARTITION BY event_type, window_start ORDER BY arrived_at, event_id) AS cnt
  FROM classified WHERE arrived <> 'dropped')
SELECT event_type, window_start, window_end, CAST(-1 AS BIGINT) AS refired_by, cnt FROM first
UNION ALL
SELECT event_type, window_start, window_end, refired_by, cnt FROM again WHERE arrived = 'late'
"""


@query(
    "late_refire",
    LATE_REFIRE_SQL,
)
def late_refire(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = late.classify_late(arriving(spark, sf_dir), "ts", ARRIVAL, "1 hour", "2 hours", "1 hour")
    results = late.refired_counts(rows, ["event_type"], ARRIVAL)
    return results.withColumn("refired_by", F.coalesce("refired_by", F.lit(-1)))


@query(
    "late_side_output",
    f"""
    WITH {classified_sql("INTERVAL 1 HOUR")}
    SELECT event_id, event_type, ts FROM classified WHERE arrived = 'dropped'
    """,
)
def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = late.classify_late(arriving(spark, sf_dir), "ts", ARRIVAL, "1 hour", "2 hours", "1 hour")
    return late.late_rows(rows).select("event_id", "event_type", "ts")


@query(
    "late_dropped",
    f"""
    WITH {classified_sql("INTERVAL 0 HOUR")}
    SELECT event_type, window_start, window_end, count(*) AS cnt FROM classified
    WHERE arrived <> 'dropped' GROUP BY ALL
    """,
)
def late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = late.classify_late(arriving(spark, sf_dir), "ts", ARRIVAL, "1 hour", "2 hours", "0 hours")
    return late.final_counts(rows, ["event_type"])


@query(
    "union_watermark",
    f"""
    WITH arriving AS (
      SELECT event_id, event_type AS stream, ts, {ARRIVED_SQL} AS arrived_at FROM events
      WHERE event_type IN ('click', 'error')),
    seen AS (
      SELECT event_id, stream, ts, max(ts) FILTER (stream = 'click') OVER w AS a,
             max(ts) FILTER (stream = 'error') OVER w AS b
      FROM arriving WINDOW w AS (ORDER BY arrived_at, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, stream, ts,
           CASE WHEN a IS NOT NULL AND b IS NOT NULL
                THEN least(a, b) - INTERVAL 2 HOUR - INTERVAL 1 MILLISECOND END AS watermark
    FROM seen
    """,
)
def union_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arriving(spark, sf_dir)
    inputs = {kind: rows.where(F.col("event_type") == kind) for kind in ("click", "error")}
    out = late.union_watermark(inputs, "ts", ARRIVAL, "2 hours")
    return out.select("event_id", "stream", "ts", "watermark")
