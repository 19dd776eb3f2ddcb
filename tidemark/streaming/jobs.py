"""Stream jobs whose steps need a batch at a time: top N, buffered output, late rows.

State between micro-batches is a table with one folder per batch. Batch n reads what earlier batches left and
replaces its own folder, so a batch that is run again gives the same result. When batch n runs, batch n - 1
has ended, and folders that only it or earlier ones needed are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.times import interval, window_start
from tidemark.operators.keyed_state import buffered
from tidemark.operators.topn import top_n_per
from tidemark.plans.scans import highest, running, total
from tidemark.session import remove_folder
from tidemark.sinks.writers import BatchWriter, batch_folder


def ranked_batches(write: BatchWriter, group: list[str], key: list[str], n: int) -> BatchWriter:
    """Rank each batch of closed windows; streams cannot rank by themselves."""
    return lambda batch, batch_id: write(top_n_per(batch, group, key, n), batch_id)


def _previous(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    remove_folder(spark, batch_folder(path, batch_id - 2))
    return spark.read.schema(schema).parquet(batch_folder(path, batch_id - 1))


def buffering_batches(write: BatchWriter, state: str, arrival: list[str], size: int = 10) -> BatchWriter:
    """Pass rows on in full buffers only; the rest (fewer than ``size`` rows) waits in ``state``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        waiting = _previous(spark, state, batch_id, schema).unionByName(batch)
        full = buffered(waiting, arrival, size)
        write(full, batch_id)
        waiting_count = waiting.count() % size
        order = [F.desc(c) for c in arrival]
        rest = waiting.orderBy(*order).limit(waiting_count)
        rest.coalesce(1).write.mode("overwrite").parquet(batch_folder(state, batch_id))

    return run


def _last_of_each(rows: DataFrame, key: str, arrival: str, depth: int) -> DataFrame:
    latest = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(arrival)))
    return rows.withColumn("__back", latest).where(F.col("__back") <= depth).drop("__back")


def look_back_batches(
    apply: Callable[[DataFrame], DataFrame],
    write: BatchWriter,
    state: str,
    key: str,
    arrival: str,
    depth: int,
    compact_every: int = 16,
) -> BatchWriter:
    """Run an operator that looks at most ``depth`` rows of the key back, such as a strict pattern.

    The last ``depth`` rows of the batch's keys are put before the batch's rows. ``apply`` must
    keep the ``arrival`` column, by which results of earlier batches are left out. Unlike a stateful
    processor this splits hot keys.

    A batch adds to ``state`` only the last rows of the keys it has; every ``compact_every`` batches these
    additions are merged into a new base of all keys, and what it replaces is deleted.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        base = batch_id // compact_every * compact_every - 1
        kept = [batch_folder(f"{state}/added", i) for i in range(base + 1, batch_id)]
        if base >= 0:
            kept.append(batch_folder(f"{state}/base", base))
        known = spark.read.schema(schema).parquet(*kept) if kept else spark.createDataFrame([], schema)
        if batch_id == base + 1 and base >= 0:
            remove_folder(spark, batch_folder(f"{state}/base", base - compact_every))
            for i in range(base + 1 - compact_every, base + 1):
                remove_folder(spark, batch_folder(f"{state}/added", i))

        asked = batch.select(F.col(key).alias("__asked")).distinct()
        here = known.join(asked, F.col(key).eqNullSafe(F.col("__asked")), "left_semi")
        rows = _last_of_each(here, key, arrival, depth).unionByName(batch)
        oldest = batch.agg(F.min(arrival)).scalar()
        write(apply(rows).where(F.col(arrival) >= oldest), batch_id)
        added = _last_of_each(batch, key, arrival, depth)
        added.write.mode("overwrite").parquet(batch_folder(f"{state}/added", batch_id))
        if (batch_id + 1) % compact_every == 0:
            merged = _last_of_each(known.unionByName(batch), key, arrival, depth)
            merged.write.mode("overwrite").parquet(batch_folder(f"{state}/base", batch_id))

    return run


def late_data_batches(
    results: BatchWriter,
    dropped: BatchWriter,
    state: str,
    keys: list[str],
    ts: str,
    arrival: list[str],
    window: str,
    delay: str,
    lateness: str,
) -> BatchWriter:
    """Window counts with allowed lateness and a side output, row by row as in arrival order.

    ``state`` keeps the highest event time and the open windows' counts. A result is written when the
    watermark passes a window's end, and again for each late row accepted after that.
    """
    gap = f"{state}/open"
    high = f"{state}/seen"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fields = {f.name: f.dataType.simpleString() for f in batch.schema}
        key_schema = ", ".join(f"`{k}` {fields[k]}" for k in keys)
        open_schema = f"{key_schema}, window_start timestamp_ntz, window_end timestamp_ntz, cnt bigint, fired boolean"
        opened = _previous(spark, gap, batch_id, open_schema)
        seen = _previous(spark, high, batch_id, "seen timestamp_ntz").agg(F.max("seen")).scalar()
        rows = batch.withColumn(ts, F.col(ts).cast("timestamp_ntz"))

        def mark(highest_ts: Column) -> Column:
            return highest_ts - interval(delay) - interval("1 millisecond")

        last = F.col("window_end") - interval("1 millisecond")
        over = last + interval(lateness)
        placed = (
            running(rows, [], arrival, __max=highest(F.col(ts), before=True))
            .withColumn("__mark", mark(F.greatest(F.col("__max"), seen)))
            .withColumn("window_start", window_start(F.col(ts), window))
            .withColumn("window_end", F.col("window_start") + interval(window))
            .withColumn("__out", F.coalesce(over <= F.col("__mark"), F.lit(False)))
            .withColumn("__late", F.coalesce(last <= F.col("__mark"), F.lit(False)))
            .persist()
        )
        dropped(placed.where("__out").select(*batch.columns), batch_id)

        group = [*keys, "window_start", "window_end"]
        kept = placed.where(~F.col("__out"))
        on_time = kept.where(~F.col("__late")).groupBy(*group).agg(F.count(F.lit(1)).alias("__new"))
        before = (
            opened.join(on_time, group, "full_outer")
            .withColumn("cnt", F.coalesce("cnt", F.lit(0)) + F.coalesce("__new", F.lit(0)))
            .withColumn("fired", F.coalesce("fired", F.lit(False)))
            .drop("__new")
        )
        late = running(kept.where("__late").select(*group, *arrival), group, arrival, __nth=total(F.lit(1)))
        again = late.join(before.select(*group, "cnt"), group, "left").select(
            *group, F.col(arrival[-1]).alias("refired_by"), (F.coalesce("cnt", F.lit(0)) + F.col("__nth")).alias("cnt")
        )
        extra = late.groupBy(*group).agg(F.count(F.lit(1)).alias("__more"))
        now_seen = F.greatest(placed.agg(F.max(ts)).scalar(), seen)
        passed = F.coalesce(last <= mark(now_seen), F.lit(False))
        first = before.where(~F.col("fired") & passed & (F.col("cnt") > 0)).select(
            *group, F.lit(None).cast(fields[arrival[-1]]).alias("refired_by"), "cnt"
        )
        results(first.unionByName(again), batch_id)

        after = (
            before.join(extra, group, "full_outer")
            .withColumn("cnt", F.coalesce("cnt", F.lit(0)) + F.coalesce("__more", F.lit(0)))
            .withColumn("fired", F.coalesce("fired", F.lit(False)) | passed)
            .where(~F.coalesce(over <= mark(now_seen), F.lit(False)))
            .select(*group, "cnt", "fired")
        )
        after.write.mode("overwrite").parquet(batch_folder(gap, batch_id))
        spark.range(1).select(now_seen.alias("seen")).write.mode("overwrite").parquet(batch_folder(high, batch_id))
        placed.unpersist()

    return run


def open_windows(spark: SparkSession, state: str, batch_id: int) -> DataFrame:
    """Windows that had not fired after a batch: what the end of a bounded input would emit."""
    return spark.read.parquet(batch_folder(f"{state}/open", batch_id)).where(~F.col("fired")).drop("fired")
