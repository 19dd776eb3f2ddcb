"""Named event tables for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import csv_rows, with_event_time


def csv_view(
    spark: SparkSession,
    name: str,
    path: str,
    schema: str,
    epoch_millis: str,
    event_time: str = "et",
    delay: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """Register delimited files as a SQL table with a computed event-time column.

    ``delay`` sets a watermark on it; as a stream, SQL over the name is a streaming query.
    """
    rows = with_event_time(csv_rows(spark, path, schema, stream), epoch_millis, event_time, delay)
    rows.createOrReplaceTempView(name)
    return rows
