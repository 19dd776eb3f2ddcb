"""Bounded streams in rounds: rows come part by part, and the query starts again from its checkpoint for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.functions.times import interval
from tidemark.sinks.writers import run_to_end
from tidemark.session import ROCKSDB


def parts_along(rows: DataFrame, along: Column, n: int) -> list[DataFrame]:
    """``rows`` in ``n`` parts at equal steps of a whole number, so that a part's rows all come before the next part's.

    Rows without that number come first. A part may be empty.
    """
    low, high = rows.agg(F.min(along), F.max(along)).first()
    step = ((high or 0) - (low or 0)) // n + 1
    part = F.coalesce(F.floor((along - F.lit(low or 0)) / F.lit(step)), F.lit(0))
    return [rows.where(part == i) for i in range(n)]


def run_rounds(
    parts: list[DataFrame], folder: str, start: Callable[[DataFrame], DataStreamWriter]
) -> list[StreamingQuery]:
    """Add each part to ``folder`` as files and run the stream over what is new; one ended query per round.

    ``start`` makes the writer from the stream of the folder. It names the same checkpoint every time, so each round is a
    restart: state, watermark and batch numbers go on. A part is one micro-batch, of as many files and tasks as it has.
    """
    spark = parts[0].sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = parts[0].schema
    ended = []
    for part in parts:
        part.write.mode("append").parquet(folder)
        ended.append(run_to_end(start(spark.readStream.schema(schema).parquet(folder))))
    return ended


def due_timers(
    stream: DataFrame, key: str, ts: str, delay: str, disorder: str = "0 seconds", until: Column | None = None
) -> DataFrame:
    """(key, at): the timer each row sets ``delay`` after its time, given out once the watermark has reached it.

    Equal timers of a key fire once. The watermark stands ``disorder`` behind the latest row; state holds the timers
    between it and the latest one, and is freed as they fire. Rows whose timer is later than ``until`` set none and only move the
    watermark, which lets the last row of a bounded input fire everything before it.
    """
    due = stream.select(key, (F.col(ts).cast("timestamp") + interval(delay)).alias("at")).withWatermark("at", disorder)
    if until is not None:
        due = due.where(F.col("at") <= until)
    return due.groupBy(key, "at").agg(F.count(F.lit(1)).alias("__n")).select(key, "at")
