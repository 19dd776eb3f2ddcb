"""The named queries over the test tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog import matching, multi, rolling, rows, stores, streams, windows
from tidemark.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "matching", "multi", "rolling", "rows", "stores", "streams", "windows"]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](spark, sf_dir)


Query = Callable[[SparkSession, str], DataFrame]
