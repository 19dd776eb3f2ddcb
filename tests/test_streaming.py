"""Streams against the batch answers; replays put one small file per micro-batch."""

import os
import time

import pytest
from conftest import rows
from fixtures import EVENTS8, LATE, LOGINS, MIN, at, ms, numbered
from pyspark.sql import functions as F

from tidemark.operators import joins, late, patterns, windows
from tidemark.sinks import writers
from tidemark.sources import files
from tidemark.streaming import jobs, processors, rounds


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def replay(tmp_path, data, name="replay", per_file=1):
    """CSV files in the order of their modification times, each with a few numbered rows."""
    folder = tmp_path / name
    folder.mkdir()
    base = time.time() - 10_000
    for i in range(0, len(data), per_file):
        path = folder / f"{i:05d}.csv"
        path.write_text("".join(f"{i + j + 1},{','.join(str(v) for v in r)}\n" for j, r in enumerate(data[i : i + per_file])))
        os.utime(path, (base + i, base + i))
    return str(folder)


def stream_of(spark, folder, schema, files_per_batch=1):
    reader = spark.readStream.schema(f"arrival bigint, {schema}").option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def run(stream, name, tmp_path, mode="append"):
    out = str(tmp_path / f"{name}-out")
    sink = stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / f"{name}-ckpt"))
    writers.run_to_end(sink.foreachBatch(writers.parquet_batches(out)))
    return stream.sparkSession.read.parquet(out)


def with_time(stream, delay="0 seconds"):
    return stream.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)


FAR = 10_000_000


def test_sliding_windows_close_by_watermark(spark, tmp_path):
    data = [("a", 1000), ("b", 2000), ("a", 7000), ("a", 12_000), ("b", 31_000)]
    folder = replay(tmp_path, [*data, ("end", FAR)], per_file=2)
    stream = with_time(stream_of(spark, folder, "k string, ms bigint"), "20 seconds")
    counted = run(windows.sliding_count(stream, "ts", "10 seconds", "5 seconds", ["k"]), "slide", tmp_path)
    table = at(numbered(spark, data, "k string, ms bigint"))
    expected = windows.sliding_count(table, "ts", "10 seconds", "5 seconds", ["k"])
    assert rows(counted, "k", ms("window_start"), "cnt") == rows(expected, "k", ms("window_start"), "cnt")


def test_stream_top_n(spark, tmp_path):
    data = [("a", 1000), ("b", 2000), ("a", 3000), ("c", 3500), ("c", 4000), ("c", 4500)]
    folder = replay(tmp_path, [*data, ("end", FAR), ("end", FAR + 1)])
    stream = with_time(stream_of(spark, folder, "k string, ms bigint"))
    counts = windows.tumbling_count(stream, "ts", "5 seconds", ["k"])
    out = str(tmp_path / "out")
    ranked = jobs.ranked_batches(writers.parquet_batches(out), ["window_start", "window_end"], ["k"], 2)
    writers.run_to_end(counts.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(ranked))
    assert rows(spark.read.parquet(out), "row_num", "k", "cnt") == [(1, "c", 3), (2, "a", 2)]


def test_stream_joins(spark, tmp_path):
    left = [("a", 1000), ("b", 1000), ("b", 2000), ("a", 5000)]
    right = [("a", 3000), ("b", 4000), ("a", 6000), ("c", 6000)]
    def sides(tag):
        for name, data in (("l", left), ("r", right)):
            folder = replay(tmp_path, data, f"{tag}-{name}", per_file=2)
            yield with_time(stream_of(spark, folder, "k string, ms bigint", 2), "1 hour").select("k", "ts")
    pairs = lambda df: rows(df, "k", ms("left_ts"), ms("right_ts"))
    l, r = sides("w")
    out = run(joins.window_join(l, r, "k", "ts", "5 seconds"), "window", tmp_path)
    assert pairs(out) == [("a", 1000, 3000), ("a", 5000, 6000), ("b", 1000, 4000), ("b", 2000, 4000)]
    l, r = sides("i")
    out = run(joins.interval_join(l, r, "k", "ts", "1 second", "2 seconds"), "interval", tmp_path)
    assert pairs(out) == [("a", 1000, 3000), ("a", 5000, 6000), ("b", 2000, 4000)]


def test_stream_reconcile_reports_misses_after_the_watermark(spark, tmp_path):
    left = [("o1", 1000), ("o2", 2000), ("end", FAR), ("end2", FAR + 1)]
    right = [("o1", 3000), ("o3", 4000), ("end", FAR), ("end2", FAR + 1)]
    sides = []
    for name, data in (("l", left), ("r", right)):
        folder = replay(tmp_path, data, name, per_file=2)
        sides.append(with_time(stream_of(spark, folder, "k string, ms bigint"), "1 second").select("k", "ts"))
    out = run(joins.reconcile(*sides, "k", "ts", "5 seconds"), "bill", tmp_path)
    assert rows(out.where("k like 'o%'"), "k", "status") == [
        ("o1", "matched"), ("o2", "missing_right"), ("o3", "missing_left"),
    ]


def test_buffered_output_survives_a_restart(spark, tmp_path):
    folder = replay(tmp_path, [(i,) for i in range(25)], per_file=4)
    out, state, ckpt = (str(tmp_path / n) for n in ("out", "state", "ckpt"))
    late_files = sorted(os.listdir(folder))[3:]
    held = tmp_path / "held"
    held.mkdir()
    for name in late_files:
        os.rename(os.path.join(folder, name), held / name)

    def go():
        stream = stream_of(spark, folder, "v int")
        write = jobs.buffering_batches(writers.parquet_batches(out), state, ["arrival"], 10)
        writers.run_to_end(stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(write))

    go()
    assert spark.read.parquet(out).count() == 10
    for name in late_files:
        os.rename(held / name, os.path.join(folder, name))
    go()
    assert rows(spark.read.parquet(out), "v") == [(i,) for i in range(20)]


@pytest.mark.parametrize("per_file", [1, 5])
def test_late_data_job_equals_the_trace(spark, tmp_path, per_file):
    folder = replay(tmp_path, LATE, per_file=per_file)
    results, dropped, state = (str(tmp_path / n) for n in ("results", "dropped", "state"))
    stream = stream_of(spark, folder, "url string, ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    write = jobs.late_data_batches(
        writers.parquet_batches(results), writers.parquet_batches(dropped), state, ["url"], "ts", ["arrival"],
        "10 seconds", "2 seconds", "60 seconds",
    )
    query = writers.run_to_end(stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(write))
    last = query.lastProgress["batchId"]
    emitted = spark.read.parquet(results).drop("batch")
    rest = jobs.open_windows(spark, state, last).withColumn("refired_by", F.lit(None).cast("bigint"))
    table = late.classify_late(at(numbered(spark, LATE, "url string, ms bigint")), "ts", ["arrival"], "10 seconds", "2 seconds", "60 seconds")
    expected = late.refired_counts(table, ["url"], ["arrival"])
    columns = ("url", "window_start", "refired_by", "cnt")
    assert rows(emitted.unionByName(rest), *columns) == rows(expected, *columns)
    assert rows(spark.read.parquet(dropped), "arrival") == [(12,)]


def test_periodic_totals_processor(spark, tmp_path):
    data = [("u", t * 1000) for t in (1, 5, 11, 12, 30)] + [("end", FAR), ("end", FAR + 1), ("end", FAR + 2)]
    stream = with_time(stream_of(spark, replay(tmp_path, data), "k string, ms bigint"))
    out = processors.with_state(
        stream, "k", processors.PeriodicTotals("k", "ms", 10_000), "k string, fire_at bigint, total bigint", "EventTime"
    )
    got = rows(run(out, "periodic", tmp_path).where("k = 'u'"), "fire_at", "total")
    assert got == [(11_000, 3), (22_000, 4), (40_000, 5)]


def test_window_count_and_timer_processors(spark, tmp_path):
    data = [("a", 1000), ("b", 2000), ("a", 7000), ("a", 12_000), ("end", FAR), ("end", FAR + 1)]
    folder = replay(tmp_path, data, per_file=2)
    stream = with_time(stream_of(spark, folder, "k string, ms bigint"), "20 seconds")
    counts = processors.with_state(
        stream, "k", processors.WindowCounts("k", "ms", 10_000), "k string, window_start bigint, cnt bigint", "EventTime"
    )
    assert rows(run(counts, "fake", tmp_path).where("k <> 'end'"), "k", "window_start", "cnt") == [
        ("a", 0, 2), ("a", 10_000, 1), ("b", 0, 1),
    ]
    stream = with_time(stream_of(spark, folder, "k string, ms bigint"), "20 seconds")
    timers = processors.with_state(
        stream, "k", processors.EventTimers("k", "ms", 10_000), "k string, kind string, at bigint", "EventTime"
    )
    fired = run(timers, "timers", tmp_path).where("k <> 'end' AND kind = 'timer'")
    assert rows(fired, "k", "at") == [("a", 11_000), ("a", 17_000), ("a", 22_000), ("b", 12_000)]


def test_table_machine_processor(spark, tmp_path):
    data = [(u, kind) for u, kind, _ in LOGINS] + [("user_1", "fail"), ("user_1", "other"), ("user_1", "fail")]
    stream = stream_of(spark, replay(tmp_path, data, per_file=3), "k string, kind string")
    machine = processors.TableMachine("k", "arrival", "kind", "initial", processors.FAILURE_TABLE)
    out = processors.with_state(stream, "k", machine, "k string, arrival bigint")
    assert rows(run(out, "machine", tmp_path), "k", "arrival") == [("user_1", 4), ("user_1", 8), ("user_2", 6)]


def test_expiring_count_processor(spark, tmp_path):
    stream = stream_of(spark, replay(tmp_path, [("a",), ("a",), ("b",)], per_file=3), "k string")
    out = processors.with_state(
        stream, "k", processors.ExpiringCount("k", 60_000), "k string, cnt bigint", "ProcessingTime", "update"
    )
    query = (
        out.writeStream.outputMode("update")
        .option("checkpointLocation", str(tmp_path / "c"))
        .foreachBatch(writers.parquet_batches(str(tmp_path / "o")))
        .start()
    )
    try:  # expiry runs on the wall clock, so such a query never ends by itself
        deadline = time.time() + 60
        found = []
        while time.time() < deadline and not found:
            time.sleep(0.5)
            if os.path.exists(tmp_path / "o" / "batch=0" / "_SUCCESS"):
                found = rows(spark.read.parquet(str(tmp_path / "o" / "batch=0")), "k", "cnt")
        assert found == [("a", 2), ("b", 1)]
    finally:
        query.stop()


def test_console_and_rolling_count_stream(spark, tmp_path):
    stream = stream_of(spark, replay(tmp_path, EVENTS8, per_file=3), "user string, url string, ms bigint")
    counts = stream.groupBy("user").agg(F.count("*").alias("cnt"))
    updates = run(counts, "roll", tmp_path, "update")
    assert rows(writers.last_update(updates, ["user"], "cnt")) == [("Alice", 2), ("Bob", 5), ("Mary", 1)]
    query = writers.run_to_end(writers.console(stream.select("user"), "label"))
    assert query.exception() is None


def test_union_watermark_is_the_lowest(spark, tmp_path):
    """A window closes only once both inputs are past it."""
    ahead = [("a", 1000), ("a", FAR), ("a", FAR + 1)]
    behind = [("b", 1500), ("b", 2000), ("b", 2500)]
    parts = []
    for name, data in (("ahead", ahead), ("behind", behind)):
        stream = with_time(stream_of(spark, replay(tmp_path, data, name), "k string, ms bigint"))
        parts.append(stream.select("k", "ts"))
    counts = windows.tumbling_count(parts[0].unionByName(parts[1]), "ts", "1 second", ["k"])
    closed = run(counts, "union", tmp_path)
    assert rows(closed, "k", ms("window_start"), "cnt") == [("a", 1000, 1), ("b", 1000, 1)]


def test_rule_matching_on_a_stream(spark, tmp_path):
    data = [("Alice", "login"), ("Alice", "pay"), ("Bob", "login"), ("Bob", "buy"), ("Alice", "buy")]
    stream = stream_of(spark, replay(tmp_path, data, per_file=2), "u string, a string")
    pairs = processors.with_state(
        stream, "u", processors.PreviousValue("u", "arrival", "a"), "u string, arrival bigint, action1 string, action2 string"
    )
    rules = spark.createDataFrame([("login", "pay"), ("login", "buy")], "action1 string, action2 string")
    out = run(pairs.join(F.broadcast(rules), ["action1", "action2"]), "rules", tmp_path)
    assert rows(out, "arrival", "u", "action1", "action2") == [(2, "Alice", "login", "pay"), (4, "Bob", "login", "buy")]


def test_followed_by_on_a_stream(spark, tmp_path):
    data = [("o1", "create", 1000), ("o2", "create", 2000), ("o1", "modify", 10_000), ("o1", "pay", 60_000),
            ("o3", "pay", 24 * MIN), ("o3", "create", 10 * MIN), ("o4", "create", 30 * MIN), ("o4", "pay", 45 * MIN)]
    data += [("end", "x", FAR), ("end", "x", FAR + 1), ("end", "x", FAR + 2), ("end", "x", FAR + 3)]
    stream = with_time(stream_of(spark, replay(tmp_path, data, per_file=2), "o string, kind string, ms bigint"), "15 minutes")
    out = processors.with_state(
        stream, "o", processors.FollowedBy("o", "ms", "arrival", "kind", "create", "pay", 15 * MIN),
        "o string, begin_ms bigint, end_ms bigint, status string", "EventTime",
    )
    assert rows(run(out, "followed", tmp_path), "o", "end_ms", "status") == [
        ("o1", 60_000, "matched"), ("o2", None, "timeout"), ("o3", 24 * MIN, "matched"), ("o4", None, "timeout"),
    ]


def test_followed_by_at_one_time_equals_the_stored_form(spark, tmp_path):
    """Begin and end at one millisecond, in both orders, several of each, and at the very end of the time allowed."""
    data = [("a", "create", 1000), ("a", "pay", 1000), ("b", "pay", 2000), ("b", "create", 2000), ("c", "create", 3000),
            ("c", "pay", 3000), ("c", "create", 3000), ("c", "pay", 9000), ("d", "create", 4000), ("d", "create", 4000),
            ("d", "pay", 14_000), ("d", "create", 14_000), ("e", "pay", 5000), ("e", "create", 5000), ("e", "pay", 5000),
            ("e", "create", 5000), ("e", "pay", 14_999), ("d", "pay", 14_000)]
    schema = "o string, kind string, ms bigint"
    folder = replay(tmp_path, [*data, ("end", "x", FAR), ("end", "x", FAR + 1)], per_file=len(data) + 1)
    stream = with_time(stream_of(spark, folder, schema), "1 minute")
    step = processors.FollowedBy("o", "ms", "arrival", "kind", "create", "pay", 10_000)
    out = processors.with_state(stream, "o", step, "o string, begin_ms bigint, end_ms bigint, status string", "EventTime")
    stored = patterns.followed_by(
        at(numbered(spark, data, schema)), "o", ["ts", "arrival"], F.col("kind") == "create", F.col("kind") == "pay", "ts", "10 seconds"
    )
    expected = rows(stored, "o", ms("begin_ts"), ms("end_ts"), "status")
    assert ("a", 1000, 1000, "matched") in expected and ("b", 2000, None, "timeout") in expected and len(expected) == 9
    assert rows(run(out, "one-time", tmp_path), "o", "begin_ms", "end_ms", "status") == expected


def test_regular_join_on_a_stream(spark, tmp_path):
    sides = []
    for name, data in (("l", [("a", 1000), ("b", 2000)]), ("r", [("a", 3000), ("b", 4000), ("a", 5000)])):
        stream = stream_of(spark, replay(tmp_path, data, name), "k string, ms bigint")
        sides.append(stream.withColumn("ts", F.timestamp_millis("ms")).select("k", "ts"))
    out = run(joins.regular_join(*sides, "k", "ts"), "regular", tmp_path)
    assert rows(out, "k", ms("left_ts"), ms("right_ts"), "last") == [
        ("a", 1000, 3000, "right"), ("a", 1000, 5000, "right"), ("b", 2000, 4000, "right"),
    ]


@pytest.mark.parametrize("segment_rows", ["1000000", "2"])
def test_look_back_job_keeps_the_last_rows(spark, tmp_path, segment_rows):
    kinds = ["fail", "fail", "ok", "fail", "fail", "fail", "fail", "fail", "ok", "fail", "fail", "fail"]
    data = [("ab"[i % 2], kind) for i, kind in enumerate(k for k in kinds for _ in "ab")]
    stream = stream_of(spark, replay(tmp_path, data, per_file=5), "k string, kind string")
    alerts = lambda rows: patterns.alerts_by_arrival(rows, "k", "arrival", F.col("kind") == "fail")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = jobs.look_back_batches(alerts, writers.parquet_batches(out), state, "k", "arrival", 2)
    spark.conf.set("spark.tidemark.segmentRows", segment_rows)
    try:
        writers.run_to_end(stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(write))
    finally:
        spark.conf.unset("spark.tidemark.segmentRows")
    expected = rows(alerts(numbered(spark, data, "k string, kind string")), "k", "arrival")
    assert len(expected) == 8 and rows(spark.read.parquet(out), "k", "arrival") == expected


def test_look_back_state_grows_with_the_batch_only(spark, tmp_path):
    """20 batches over many keys: what a batch adds and the number of folders stay as they are; results are right."""
    data = [(i + 1, f"k{i * 7 % 40}" if i % 9 else None, "fail" if i % 5 else "ok") for i in range(200)]
    alerts = lambda rows: patterns.alerts_by_arrival(rows, "k", "arrival", F.col("kind") == "fail")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = jobs.look_back_batches(alerts, writers.parquet_batches(out), state, "k", "arrival", 2, compact_every=4)
    whole = spark.createDataFrame(data, "arrival bigint, k string, kind string")
    kept = []
    for n in range(20):
        batch = whole.where(F.col("arrival").between(10 * n + 1, 10 * n + 10))
        for _ in range(2 if n in (4, 7) else 1):  # a batch that is run again
            write(batch, n)
        added = spark.read.parquet(f"{state}/added/batch={n}").count()
        assert added <= 10
        kept.append(sum(len(os.listdir(tmp_path / "state" / kind)) for kind in ("added", "base") if (tmp_path / "state" / kind).exists()))
    assert max(kept[4:]) <= 6 and kept[4:8] == kept[8:12] == kept[16:]
    expected = rows(alerts(whole), "k", "arrival")
    assert len(expected) > 20 and rows(spark.read.parquet(out), "k", "arrival") == expected


def test_timers_free_their_state(spark, tmp_path):
    """Rounds with a restart each; the last row moves the watermark past all timers and nothing stays behind."""
    data = [(k, t) for t in range(12) for k in "ab"]
    frame = spark.createDataFrame(data, "k string, t bigint").select("k", F.timestamp_seconds("t").alias("ts"))
    end = spark.createDataFrame([(None, 1000)], "k string, t bigint").select("k", F.timestamp_seconds("t").alias("ts"))
    parts = rounds.parts_along(frame, F.unix_micros("ts"), 3)
    until, out, ckpt = F.timestamp_seconds(F.lit(500)), str(tmp_path / "out"), str(tmp_path / "c")

    def start(stream):
        due = rounds.due_timers(stream, "k", "ts", "5 seconds", until=until)
        return due.writeStream.option("checkpointLocation", ckpt).foreachBatch(writers.parquet_batches(out))

    ended = rounds.run_rounds([*parts, end], str(tmp_path / "in"), start)
    assert [p.count() for p in parts] == [8, 8, 8] and len(ended) == 4
    fired = spark.read.parquet(out)
    assert rows(fired, "k", ms("at")) == sorted((k, (t + 5) * 1000) for k, t in data)
    assert fired.where("batch < 4").count() > 0
    assert ended[-1].lastProgress["stateOperators"][0]["numRowsTotal"] == 0
