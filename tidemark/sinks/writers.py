"""Writers for files, brokers, databases, tables and keyed stores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.session import ROCKSDB, scratch_path

BatchWriter = Callable[[DataFrame, int], None]


def console(stream: DataFrame, label: str, mode: str = "append") -> DataStreamWriter:
    """Print rows of a stream; the query carries the label."""
    return stream.writeStream.format("console").outputMode(mode).queryName(label)


def text_line(*columns: Column) -> Column:
    """A record as one line of comma-separated fields; a null field is empty."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def text_files(
    lines: DataFrame, path: str, checkpoint: str, roll_every: str = "15 minutes", rows_per_file: int = 10_000_000
) -> DataStreamWriter:
    """Exactly-once text files: a new file per trigger, and after ``rows_per_file`` rows."""
    return (
        lines.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .trigger(processingTime=roll_every)
    )


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that is there now, in bounded micro-batches, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka(stream: DataFrame, value: Column, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Send each row as a message. Needs the Kafka connector on the class path."""
    rows = stream.select(value.cast("string").alias("value"))
    return rows.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, batch_rows: int = 1000, connections: int = 16
) -> dict[str, str]:
    """Batched inserts of ``batch_rows`` rows over at most ``connections`` connections."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }


def jdbc_batches(options: dict[str, str], retries: int = 5) -> BatchWriter:
    """A ``foreachBatch`` writer that appends to a database table; a failed batch is tried again.

    Delivery is at least once: the table's own key must absorb a repeated batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(retries + 1):
            try:
                batch.write.format("jdbc").options(**options).mode("append").save()
                return
            except Exception:
                if attempt == retries:
                    raise

    return write


def insert_into(df: DataFrame, table: str) -> None:
    """Append a result to a registered table, matching columns by name."""
    names = df.sparkSession.table(table).columns
    df.select(*names).write.insertInto(table)


class Client(Protocol):
    """What a keyed store's client must offer."""

    def put(self, row: Row) -> None: ...

    def close(self) -> None: ...


def put_rows(df: DataFrame, connect: Callable[[], Client]) -> None:
    """Put every row through a client; each partition opens one and closes it."""

    def write(rows: Iterator[Row]) -> None:
        client = connect()
        try:
            for row in rows:
                client.put(row)
        finally:
            client.close()

    df.foreachPartition(write)


def store_batches(shape: Callable[[DataFrame], DataFrame], connect: Callable[[], Client]) -> BatchWriter:
    """A ``foreachBatch`` writer: shape the batch, then put it into a keyed store.

    Puts are idempotent, so a repeated batch leaves the store as it was.
    """
    return lambda batch, batch_id: put_rows(shape(batch), connect)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def parquet_batches(path: str) -> BatchWriter:
    """A ``foreachBatch`` writer with one folder per batch; a repeated batch replaces its folder."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))


def collect_updates(stream: DataFrame, name: str, mode: str = "update", **options: Any) -> DataFrame:
    """Run a stream to its end into batch folders; the rows come back with their ``batch``.

    State is kept in RocksDB, so that it may outgrow the executors' memory.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    path = scratch_path(spark, name)
    writer = (
        stream.writeStream.outputMode(mode)
        .options(**options)
        .option("checkpointLocation", scratch_path(spark, f"{name}-checkpoint"))
        .foreachBatch(parquet_batches(path))
    )
    run_to_end(writer)
    return spark.read.parquet(path)


def last_update(updates: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The newest value of each key among a changelog's batches."""
    return updates.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))
