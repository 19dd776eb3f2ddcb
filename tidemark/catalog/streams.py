"""Queries that run as streams over the stored tables, and file output read back.

Each stream reads its table in bounded micro-batches and runs to the end of what is there. Those that take a
watermark or an arrival order get the table in parts along it and start again from their checkpoint for each part; the
others do not depend on the order in which files are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.catalog.registry import query, table
from tidemark.catalog.rolling import EVENT_TIMERS_SQL
from tidemark.catalog.stores import BUFFERED_SQL
from tidemark.catalog.windows import ARRIVAL, LATE_REFIRE_SQL, arriving
from tidemark.functions.times import interval, micros
from tidemark.operators import topn, windows
from tidemark.session import scratch_path
from tidemark.sinks import writers
from tidemark.sources import files
from tidemark.sources.declared import CsvTable
from tidemark.streaming import jobs
from tidemark.streaming.rounds import due_timers, parts_along, run_rounds


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, since a stream takes a plain path only for a folder and the table may be one file.
    return files.parquet_stream(spark, f"{sf_dir}/events.parque[t]")


@query("file_sink_roundtrip", "SELECT event_id, user_id, event_type, ts FROM events")
def file_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as lines of text by a stream, then read and parsed."""
    columns = [F.col(c) for c in ("event_id", "user_id", "event_type", "ts")]
    lines = _events(spark, sf_dir).select(writers.text_line(*columns).alias("value"))
    path = scratch_path(spark, "lines")
    writers.run_to_end(writers.text_files(lines, path, scratch_path(spark, "lines-checkpoint")))
    fields = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "ts": "timestamp_ntz"}
    return files.parse_delimited(files.text_lines(spark, path), fields, keep_bad=True)


@query("stream_group_count", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def stream_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count per user kept as a changelog; the last change of each user is the result."""
    counts = _events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return writers.last_update(writers.collect_updates(counts, "group-count"), ["user_id"], "cnt")


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windows.tumbling_count(events, "ts", "1 hour", ["event_type"])
    updates = writers.collect_updates(counts, "hourly")
    last = writers.last_update(updates, ["event_type", "window_start", "window_end"], "cnt")
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return last.withColumns(bounds)


HOURLY_SQL = """
SELECT event_type, count(*) AS cnt, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
FROM events GROUP BY ALL
"""


@query("stream_tumbling_count", HOURLY_SQL)
def stream_tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir)


@query(
    "stream_window_topn",
    """
    WITH counts AS (
      SELECT event_type, count(*) AS cnt, time_bucket(INTERVAL 1 HOUR, ts) AS window_start
      FROM events GROUP BY ALL)
    SELECT event_type, cnt, window_start, window_start + INTERVAL 1 HOUR AS window_end,
           row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS row_num
    FROM counts QUALIFY row_num <= 2
    """,
)
def stream_window_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_n_per(_hourly(spark, sf_dir), ["window_start", "window_end"], ["event_type"], 2)


CLICKS = CsvTable(
    "user_id bigint, event_type string, millis bigint",
    {"et": "timestamp_seconds(floor(millis / 1000))"},
    event_time="et",
    delay="1 second",
)


@query(
    "csv_window_topn",
    """
    WITH counts AS (
      SELECT user_id, count(*) AS cnt, time_bucket(INTERVAL 1 HOUR, ts) AS window_start
      FROM events GROUP BY ALL)
    SELECT user_id, cnt, window_start, window_start + INTERVAL 1 HOUR AS window_end,
           row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS row_num
    FROM counts QUALIFY row_num <= 2
    """,
)
def csv_window_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV with blanks after the commas, read by a declaration with computed event time."""
    path = scratch_path(spark, "clicks-csv")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    line = F.concat_ws(", ", F.col("user_id").cast("string"), "event_type", millis)
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    CLICKS.register(spark, "declared_clicks", path)
    clicks = spark.table("declared_clicks")
    best = topn.window_top_n(clicks, "et", "1 hour", "user_id", 2)
    return best.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


ROUNDS = 3


def _to_batches(spark: SparkSession, name: str, batches: writers.BatchWriter, shape: Callable[[DataFrame], DataFrame] | None = None):
    """A writer for run_rounds: the shaped stream in append mode, always with the same checkpoint."""
    checkpoint = scratch_path(spark, f"{name}-checkpoint")

    def start(stream: DataFrame) -> DataStreamWriter:
        shaped = shape(stream) if shape else stream
        return shaped.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(batches)

    return start


def _in_time(spark: SparkSession, sf_dir: str) -> tuple[list[DataFrame], DataFrame]:
    """Events in parts along their time, and a row a week after the last that moves the watermark past all of them."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    flush = events.agg((F.max("ts") + interval("7 days")).alias("ts"))
    none = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ("user_id", "event_type")]
    return parts_along(events, micros(F.col("ts")), ROUNDS), flush.select(*none, "ts").where("ts IS NOT NULL")


@query("stream_event_timers", EVENT_TIMERS_SQL)
def stream_event_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timer an hour after each event, fired by the watermark; the stream is stopped and started between the parts."""
    parts, flush = _in_time(spark, sf_dir)
    until = flush.agg(F.max("ts").cast("timestamp")).scalar()
    fired = scratch_path(spark, "timers")
    shape = lambda stream: due_timers(stream, "user_id", "ts", "1 hour", until=until)
    start = _to_batches(spark, "timers", writers.parquet_batches(fired), shape)
    run_rounds([*parts, flush], scratch_path(spark, "timers-in"), start)
    timers = spark.read.parquet(fired).select("user_id", F.lit("timer").alias("kind"), F.col("at").cast("timestamp_ntz"))
    rows = table(spark, sf_dir, "events").select("user_id", F.lit("row").alias("kind"), F.col("ts").alias("at"))
    return rows.unionByName(timers)


@query("stream_closed_windows", HOURLY_SQL)
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts, each given out once, when the watermark has passed the window's end."""
    parts, flush = _in_time(spark, sf_dir)
    until = flush.agg(F.max("ts").cast("timestamp")).scalar()

    def counts(stream: DataFrame) -> DataFrame:
        return windows.tumbling_count(files.with_rowtime(stream, "ts", "1 hour").where(F.col("ts") < until), "ts", "1 hour", ["event_type"])

    closed = scratch_path(spark, "closed")
    run_rounds([*parts, flush], scratch_path(spark, "closed-in"), _to_batches(spark, "closed", writers.parquet_batches(closed), counts))
    found = spark.read.parquet(closed).drop("batch")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_late_refire", LATE_REFIRE_SQL)
def stream_late_refire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of windows and of the late rows that change them, from a stream in the order of arrival."""
    parts = parts_along(arriving(spark, sf_dir), micros(F.col("arrived_at")), ROUNDS)
    results, dropped, state = (scratch_path(spark, f"late-{name}") for name in ("results", "dropped", "state"))
    write = jobs.late_data_batches(
        writers.parquet_batches(results), writers.parquet_batches(dropped), state, ["event_type"], "ts", ARRIVAL,
        "1 hour", "2 hours", "1 hour",
    )
    ended = run_rounds(parts, scratch_path(spark, "late-in"), _to_batches(spark, "late", write))
    last = max(p["batchId"] for p in ended[-1].recentProgress)
    rest = jobs.open_windows(spark, state, last).withColumn("refired_by", F.lit(None).cast("bigint"))
    found = spark.read.parquet(results).drop("batch").unionByName(rest)
    return found.withColumn("refired_by", F.coalesce("refired_by", F.lit(-1)))


@query("stream_buffered_batches", BUFFERED_SQL)
def stream_buffered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full buffers of ten from a stream in the order of arrival; what waits lasts over the restarts between the parts."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    out, state = (scratch_path(spark, f"buffers-{name}") for name in ("out", "state"))
    write = jobs.buffering_batches(writers.parquet_batches(out), state, ["event_id"], 10)
    parts = parts_along(events, F.col("event_id"), ROUNDS)
    run_rounds(parts, scratch_path(spark, "buffers-in"), _to_batches(spark, "buffers", write))
    flushed = spark.read.parquet(out)
    # One row for each micro-batch: the buffers that those before it filled.
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    filled = flushed.groupBy("batch").agg((F.max("batch_id") + 1).alias("__n"))
    numbered = filled.select("batch", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return flushed.join(F.broadcast(numbered), "batch").select(
        "event_id", "user_id", (F.col("batch_id") + F.col("__before")).alias("batch_id"), "position"
    )
