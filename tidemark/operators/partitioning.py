"""User-visible distribution of rows over partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Equal keys in one partition."""
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def shuffled(df: DataFrame, partitions: int) -> DataFrame:
    """Rows at random partitions (a seeded draw, so that a retried task repeats it)."""
    return df.repartition(partitions, F.rand(17))


def round_robin(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt out evenly."""
    return df.repartition(partitions)


def rescaled(df: DataFrame, partitions: int, widen: bool = False) -> DataFrame:
    """At most ``partitions`` partitions, without a shuffle; exactly that many by a shuffle if ``widen``."""
    return df.repartition(partitions) if widen else df.coalesce(partitions)


def replicated(df: DataFrame, copies: int, name: str = "replica") -> DataFrame:
    """Every row ``copies`` times, numbered from 0; made in place, without a join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def by_partition_number(df: DataFrame, partitions: int, number: Column) -> DataFrame:
    """Each row in exactly the partition whose number is given."""
    return df.repartitionById(partitions, number.cast("int"))


def with_partition(df: DataFrame, name: str = "partition") -> DataFrame:
    """The number of the partition each row is in."""
    return df.withColumn(name, F.spark_partition_id())


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return with_partition(df).groupBy("partition").agg(F.count(F.lit(1)).alias("rows"))
