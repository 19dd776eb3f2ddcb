"""What the operators share: cutting lineage, gapless ranks, batches of texts inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

ROW = "__row"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans made inside hand tasks batches of at most that many rows; texts and sets can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame, rows: int = 1_000, distinct: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: later steps neither recompute nor lose them.

    Unlike after a checkpoint, the optimizer knows the table's true size. A checkpoint keeps the estimate of its plan, and
    over rounds of joins such estimates are multiplied until planning itself does not end. ``rows``: see batch_rows. ``distinct``: most values are, so no
    dictionaries of them are tried.
    """
    path = scratch_path(df.sparkSession, "cut")
    with batch_rows(df.sparkSession, rows):
        df.write.option("parquet.enable.dictionary", not distinct).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, __row): the two columns an operator reads and a number that tells repeated rows apart.

    A null text is empty. Other columns, whatever their names, are not carried. ``__row`` is only stable
    until the next shuffle is recomputed, so whoever relies on it cuts the lineage right after the first pass.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias(ROW),
    )


def ranked(df: DataFrame, groups: list[str], order: list[str], out: str, rows_per_bucket: int = 20_000) -> DataFrame:
    """``out``: ranks 0, 1, ... without gaps inside each group, in an arbitrary but fixed order.

    ``df`` is cut and ``order`` identifies a row. A group of any size is ranked by many tasks: rows are
    dealt to buckets by a hash, ranked there, and moved up by the rows of the buckets before.
    """
    buckets = max(1, ceil(df.count() / rows_per_bucket))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*groups, "__bucket")
        .agg(F.count("*").alias("__n"))
        .withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    inside = Window.partitionBy(*groups, "__bucket").orderBy(*order)
    return (
        dealt.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(offsets, [*groups, "__bucket"])
        .withColumn(out, F.col("__rank") + F.col("__offset"))
        .drop("__bucket", "__rank", "__offset")
    )


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def freeing(task: Task) -> Task:
    """The task, returning to the system at its end what it has freed: workers are reused, and their peaks would add up."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim:
            trim(0)

    return run


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4_000_000) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, UTF-8 texts) of slices of about ``max_bytes``; a longer text is a slice alone."""
    values = batch.column(column).cast(pa.large_binary())
    first, size, held = 0, 0, []
    for i, value in enumerate(values):
        raw = value.as_py() or b""
        if held and size + len(raw) > max_bytes:
            yield first, i, held
            first, size, held = i, 0, []
        held.append(raw)
        size += len(raw)
    if held:
        yield first, first + len(held), held


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def hash_sample(rows: DataFrame, about: int, key: str = "doc_id") -> DataFrame:
    """About ``about`` of the rows, those whose key hashes lowest; the same rows in every run, all if there are fewer."""
    n = rows.count()
    if n <= about:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1_000_000_000)) < int(1_000_000_000 * about / n))
