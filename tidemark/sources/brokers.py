"""Line streams from sockets and message brokers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def address(host: str | None = None, port: str | int | None = None) -> tuple[str, int]:
    """Host and port of a line stream, with defaults; a bad port is refused."""
    number = int(port) if port is not None else 7777
    if not 0 < number < 65536:
        raise ValueError(f"port out of range: {number}")
    return host or "localhost", number


def socket_lines(spark: SparkSession, host: str | None = None, port: str | int | None = None) -> DataFrame:
    """Lines from a socket. Any frame with a ``value`` column can take its place."""
    name, number = address(host, port)
    return spark.readStream.format("socket").option("host", name).option("port", number).load()


def kafka_source_options(servers: str, topic: str, group: str, starting: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": starting,
    }


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Message values as strings. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**options)
    return reader.load().selectExpr("CAST(value AS STRING) AS value")
