"""Text, delimited and columnar files, as tables or as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.strings import to_long
from tidemark.functions.times import seconds_timestamp


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.text(path)


def text_line_stream(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """Lines of files as they appear in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def csv_rows(spark: SparkSession, path: str, schema: str, stream: bool = False) -> DataFrame:
    """Comma-separated rows of a declared schema; blanks around fields are ignored."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).csv(path, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def parquet_stream(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """A parquet table as a stream, at most ``files_per_batch`` files per micro-batch."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def parse_delimited(
    lines: DataFrame, fields: dict[str, str], line: str = "value", keep_bad: bool = False
) -> DataFrame:
    """Lines to typed columns: split at commas, trimmed, cast. ``fields`` maps names to SQL types.

    A field that cannot be read is null; its row is dropped unless ``keep_bad``. Works on streams.
    """
    pieces = F.split(F.col(line), ",")

    def field(i: int, kind: str) -> Column:
        raw = F.trim(F.get(pieces, i))
        return to_long(raw) if kind == "bigint" else raw.try_cast(kind)

    rows = lines.select(*[field(i, kind).alias(name) for i, (name, kind) in enumerate(fields.items())])
    return rows if keep_bad else rows.dropna(how="any")


def with_event_time(df: DataFrame, epoch_millis: str, name: str = "et", delay: str | None = None) -> DataFrame:
    """Add event time at whole seconds, with a watermark if ``delay`` is given."""
    out = df.withColumn(name, seconds_timestamp(F.col(epoch_millis)).cast("timestamp"))
    return out.withWatermark(name, delay) if delay else out


def with_rowtime(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """The event-time column as a zoned timestamp with a watermark, as streams require it."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
