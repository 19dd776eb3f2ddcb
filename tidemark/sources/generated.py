"""Generated rows: clicks, random integers, and numbers placed by parity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.partitioning import by_partition_number

# The users and pages that generated clicks draw from.
USERS = ["Mary", "Alice", "Bob", "Cary"]
URLS = ["./home", "./cart", "./fav", "./prod?id=1", "./prod?id=2"]


def _pick(values: list[str], number: str, seed: int) -> Column:
    """A value chosen by a hash of the row number, so a retried task repeats its choice."""
    index = F.pmod(F.xxhash64(F.col(number), F.lit(seed)), F.lit(len(values))).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _clicks(numbered: DataFrame, number: str, ts: str, seed: int) -> DataFrame:
    return numbered.select(
        _pick(USERS, number, seed).alias("user"),
        _pick(URLS, number, seed + 1).alias("url"),
        F.col(ts).alias("ts"),
    )


def click_stream(spark: SparkSession, rows_per_second: int = 1, seed: int = 1) -> DataFrame:
    """Endless random clicks stamped with the wall clock."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return _clicks(rate, "value", "timestamp", seed)


def clicks(spark: SparkSession, rows: int, start_millis: int = 0, seed: int = 1) -> DataFrame:
    """The same as a table: one click per second from ``start_millis`` on."""
    ts = F.timestamp_millis(F.lit(start_millis) + F.col("id") * 1000)
    return _clicks(spark.range(rows).withColumn("ts", ts), "id", "ts", seed)


def random_ints(spark: SparkSession, rows: int, partitions: int = 2, seed: int = 1) -> DataFrame:
    """Random integers made by parallel tasks."""
    value = F.xxhash64(F.col("id"), F.lit(seed)).bitwiseAND(F.lit(0xFFFFFFFF))
    signed = F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)
    return spark.range(0, rows, 1, partitions).select(signed.cast("int").alias("value"))


def by_parity(spark: SparkSession, rows: int = 8) -> DataFrame:
    """1..rows, even numbers in partition 0 and odd ones in partition 1."""
    numbers = spark.range(1, rows + 1).select(F.col("id").alias("value"))
    return by_partition_number(numbers, 2, F.col("value") % 2)
