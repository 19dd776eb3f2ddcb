"""Tables declared once and read as stored rows or as a stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import csv_rows


@dataclass(frozen=True)
class CsvTable:
    """Comma-separated files with declared columns, columns computed from them, and event time.

    ``columns`` is a schema in SQL's words (``"user string, ts bigint"``); ``computed`` maps names to SQL expressions over the columns
    and the computed ones before them. ``event_time`` names the column that carries the watermark, ``delay`` how far it stays behind.
    Blanks around fields are ignored; a field that cannot be read is null.
    """

    columns: str
    computed: dict[str, str] = field(default_factory=dict)
    event_time: str | None = None
    delay: str = "0 seconds"

    def _read(self, spark: SparkSession, path: str, stream: bool) -> DataFrame:
        rows = csv_rows(spark, path, self.columns, stream)
        for name, expression in self.computed.items():
            rows = rows.withColumn(name, F.expr(expression))
        return rows

    def stored(self, spark: SparkSession, path: str) -> DataFrame:
        """All rows that are there. A watermark has no meaning for them: every row is on time."""
        return self._read(spark, path, False)

    def stream(self, spark: SparkSession, path: str) -> DataFrame:
        """Rows of the files as they appear, with the declared watermark."""
        rows = self._read(spark, path, True)
        return rows.withWatermark(self.event_time, self.delay) if self.event_time else rows

    def register(self, spark: SparkSession, name: str, path: str, stream: bool = False) -> DataFrame:
        """The table under a name for SQL; over a stream such SQL is a streaming query."""
        rows = self.stream(spark, path) if stream else self.stored(spark, path)
        rows.createOrReplaceTempView(name)
        return rows
