"""Rows as keyed stores take them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, value: str, arrival: str) -> DataFrame:
    """The value that arrived last per key: what a hash of key -> value holds in the end."""
    return df.groupBy(key).agg(F.max_by(value, arrival).alias(value))


def json_document(field: Column, value: Column) -> Column:
    """``{"<field>": "<value>"}`` with the field named by the row."""
    return F.to_json(F.create_map(field, value))


def cells(df: DataFrame, rowkey: Column, family: str, qualifier: Column, value: str = "1") -> DataFrame:
    """Cells of a wide-column table; putting a cell twice leaves one."""
    cell = df.select(
        rowkey.alias("rowkey"), F.lit(family).alias("family"), qualifier.alias("qualifier"), F.lit(value).alias("value")
    )
    return cell.dropDuplicates(["rowkey", "family", "qualifier"])
