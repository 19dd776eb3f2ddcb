import json
import os

import pytest
from conftest import rows
from fixtures import EVENT, EVENTS8, ms, numbered
from pyspark.sql import functions as F

from tidemark.operators.transforms import word_count
from tidemark.sinks import shapes, writers
from tidemark.sources import brokers, files, generated
from tidemark.sources.views import csv_view


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))
    return str(path)


def test_text_source_as_table_and_stream(spark, tmp_path):
    write(tmp_path / "in" / "a.txt", ["hello world", "hello spark"])
    table = word_count(files.text_lines(spark, str(tmp_path / "in")), "value")
    assert rows(table) == [("hello", 2), ("spark", 1), ("world", 1)]
    stream = word_count(files.text_line_stream(spark, str(tmp_path / "in")), "value")
    updates = writers.collect_updates(stream, "words")
    assert rows(writers.last_update(updates, ["word"], "cnt")) == rows(table)


def test_csv_with_computed_event_time(spark, tmp_path):
    path = write(tmp_path / "clicks.csv", ["Mary, ./home, 1999", "Bob, ./cart, 2000"])
    df = files.csv_rows(spark, path, "user string, url string, ts bigint")
    out = files.with_event_time(df, "ts")
    assert rows(out, "user", "url", ms("et")) == [("Bob", "./cart", 2000), ("Mary", "./home", 1000)]
    stream = files.csv_rows(spark, str(tmp_path), "user string, url string, ts bigint", stream=True)
    assert files.with_event_time(stream, "ts", delay="1 second").isStreaming


def test_parse_delimited(spark):
    lines = spark.createDataFrame([(" Mary , ./home,1000",), ("Bob,./cart,2000L",), ("bad",), ("x,y,z",)], "value string")
    fields = {"user": "string", "url": "string", "ts": "bigint"}
    assert rows(files.parse_delimited(lines, fields)) == [("Bob", "./cart", 2000), ("Mary", "./home", 1000)]
    assert files.parse_delimited(lines, fields, keep_bad=True).count() == 4


def test_broker_options():
    assert brokers.kafka_source_options("h:9092", "clicks", "g") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "clicks", "kafka.group.id": "g", "startingOffsets": "latest",
    }
    assert writers.kafka_sink_options("h:9092", "clicks")["topic"] == "clicks"
    assert brokers.address() == ("localhost", 7777) and brokers.address("h", "80") == ("h", 80)
    with pytest.raises(ValueError):
        brokers.address("h", 0)


def test_generated_rows(spark):
    clicks = generated.clicks(spark, 200)
    assert {r.user for r in clicks.collect()} == set(generated.USERS)
    assert {r.url for r in clicks.collect()} == set(generated.URLS)
    assert rows(clicks) == rows(generated.clicks(spark, 200))
    ints = generated.random_ints(spark, 100)
    assert ints.rdd.getNumPartitions() == 2 and ints.distinct().count() == 100
    assert min(r.value for r in ints.collect()) < 0
    placed = generated.by_parity(spark).withColumn("p", F.spark_partition_id())
    assert rows(placed) == [(v, v % 2) for v in range(1, 9)]
    assert generated.click_stream(spark).columns == ["user", "url", "ts"]


def test_text_file_sink(spark, tmp_path):
    events = numbered(spark, EVENTS8, EVENT)
    events.write.parquet(str(tmp_path / "in"))
    stream = files.parquet_stream(spark, str(tmp_path / "in"))
    lines = stream.select(writers.text_line(F.col("user"), F.col("url"), F.col("ms")).alias("value"))
    sink = writers.text_files(lines, str(tmp_path / "out"), str(tmp_path / "ckpt"), rows_per_file=3)
    writers.run_to_end(sink)
    writers.run_to_end(sink)  # a restart on the same checkpoint adds nothing
    back = files.parse_delimited(files.text_lines(spark, str(tmp_path / "out")), {"user": "string", "url": "string", "ms": "bigint"})
    assert rows(back) == rows(events.drop("arrival"))


def test_insert_into_table(spark, tmp_path):
    spark.sql(f"CREATE TABLE results (cnt BIGINT, user STRING) USING parquet LOCATION '{tmp_path}/t'")
    try:
        counts = numbered(spark, EVENTS8, EVENT).groupBy("user").agg(F.count("*").alias("cnt"))
        writers.insert_into(counts, "results")
        assert rows(spark.table("results"), "user", "cnt") == [("Alice", 2), ("Bob", 5), ("Mary", 1)]
    finally:
        spark.sql("DROP TABLE results")


def test_keyed_store_sink(spark, tmp_path):
    class FileClient:
        """Keeps puts in one file per key, as a keyed store would."""

        def __init__(self, folder):
            self.folder, self.closed = folder, False
            os.makedirs(folder, exist_ok=True)

        def put(self, row):
            with open(os.path.join(self.folder, row.user), "w") as f:
                json.dump(row.asDict(), f)

        def close(self):
            open(os.path.join(self.folder, f".closed-{os.getpid()}"), "w").close()

    folder = str(tmp_path / "store")
    numbered(spark, EVENTS8, EVENT).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = files.parquet_stream(spark, str(tmp_path / "in"))
    shape = lambda batch: shapes.latest_per_key(batch, "user", "url", "arrival")
    sink = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(
        writers.store_batches(shape, lambda: FileClient(folder))
    )
    writers.run_to_end(sink)
    stored = {n: json.load(open(os.path.join(folder, n)))["url"] for n in os.listdir(folder) if n[0] != "."}
    assert stored == {"Mary": "./home", "Bob": "./prod?id=3", "Alice": "./prod?id=200"}
    assert any(n.startswith(".closed") for n in os.listdir(folder))


class FailingWriter:
    """Stands in for a batch's writer; the first saves fail."""

    def __init__(self, failures):
        self.failures, self.saves, self.seen = failures, 0, {}
        self.write = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def mode(self, mode):
        self.seen["mode"] = mode
        return self

    def save(self):
        self.saves += 1
        if self.saves <= self.failures:
            raise RuntimeError("no connection")


def test_jdbc_batches_retry():
    options = writers.jdbc_options("jdbc:x:y", "clicks", "u", "p", "d.Driver")
    assert options["batchsize"] == "1000"
    batch = FailingWriter(5)
    writers.jdbc_batches(options)(batch, 0)
    assert batch.saves == 6 and batch.seen["mode"] == "append" and batch.seen["dbtable"] == "clicks"
    with pytest.raises(RuntimeError):
        writers.jdbc_batches(options, retries=2)(FailingWriter(5), 0)


def test_sql_over_a_csv_view(spark, tmp_path):
    lines = [f"{u}, ./home, {i * 1000}" for i, u in enumerate(["Mary"] * 3 + ["Alice"] + ["Bob"] * 8)]
    path = write(tmp_path / "clicks.csv", lines)
    csv_view(spark, "click_table", path, "user string, url string, ts bigint", "ts")
    top = spark.sql("""
        SELECT user, cnt, row_num FROM (
          SELECT *, row_number() OVER (ORDER BY cnt DESC) AS row_num
          FROM (SELECT user, count(url) AS cnt FROM click_table GROUP BY user))
        WHERE row_num <= 2
    """)
    assert rows(top) == [("Bob", 8, 1), ("Mary", 3, 2)]
    hourly = spark.sql("SELECT user, count(1) AS c FROM click_table GROUP BY user, window(et, '5 seconds')")
    assert rows(hourly) == [("Alice", 1), ("Bob", 1), ("Bob", 2), ("Bob", 5), ("Mary", 3)]


def test_declared_table(spark, tmp_path):
    """One declaration for stored rows and for a stream, with computed event time and a watermark."""
    from tidemark.sources.declared import CsvTable

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("Mary, ./home, 1999\nBob,./cart,  61000\nbad line\n")
    clicks = CsvTable("user string, url string, ms bigint", {"et": "timestamp_seconds(floor(ms / 1000))", "late": "et < timestamp'1970-01-01 00:01:00'"}, "et", "1 second")
    path = str(tmp_path / "in")
    stored = clicks.register(spark, "declared", path)
    assert [tuple(r) for r in spark.sql("SELECT user, url, unix_millis(et), late FROM declared ORDER BY ms NULLS LAST").collect()] == [
        ("Mary", "./home", 1000, True), ("Bob", "./cart", 61000, False), ("bad line", None, None, None)
    ]
    streamed = clicks.stream(spark, path)
    assert streamed.isStreaming and streamed.schema.simpleString() == stored.schema.simpleString()
    assert "EventTimeWatermark" in streamed._jdf.queryExecution().analyzed().toString()
