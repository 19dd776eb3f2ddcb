from conftest import rows
from fixtures import EVENT, EVENTS3, EVENTS8, at, ms, numbered
from pyspark.sql import functions as F

from tidemark.functions.aggregates import register_sql_functions, weighted_average
from tidemark.functions.strings import split_words, string_hash, to_long
from tidemark.functions.times import format_time, millis_timestamp, parse_millis, seconds_timestamp
from tidemark.operators import partitioning, transforms
from tidemark.sinks.shapes import cells, json_document, latest_per_key


def test_word_count(spark):
    lines = spark.createDataFrame([("hello world",), ("hello spark",), ("hello java",)], "value string")
    assert rows(transforms.word_count(lines, "value")) == [("hello", 3), ("java", 1), ("spark", 1), ("world", 1)]


def test_split_drops_empty_pieces_at_the_end_only(spark):
    df = spark.createDataFrame([("a?b?",), ("?a",), ("",), ("??",), ("a??b",), (None,)], "s string")
    found = {r.s: r.p for r in df.select("s", split_words(F.col("s"), "?").alias("p")).collect()}
    assert found == {"a?b?": ["a", "b"], "?a": ["", "a"], "": [""], "??": [], "a??b": ["a", "", "b"], None: None}


def test_flat_map_and_filter(spark):
    events = numbered(spark, EVENTS3, EVENT)
    cases = [
        (F.col("user") == "Bob", [F.col("user")]),
        (F.col("user") == "Alice", [F.col("user"), F.col("url"), F.col("ms").cast("string")]),
    ]
    out = transforms.flat_map(events, cases, "field", ["arrival"])
    assert rows(out) == sorted([(2, "Bob"), (3, "Alice"), (3, "./prod?id=100"), (3, "3000")])
    assert rows(events.where(F.col("user") == "Bob"), "user") == [("Bob",)]
    assert [r[0] for r in rows(events, "arrival", F.length("url").alias("n"))] == [1, 2, 3]
    assert [r[1] for r in rows(events, "arrival", F.length("url").alias("n"))] == [6, 6, 13]


def test_emit_times(spark):
    events = numbered(spark, EVENTS3, EVENT)
    times = F.when(F.col("user") == "Mary", 1).when(F.col("user") == "Bob", 2)
    assert rows(transforms.emit_times(events, times), "user") == [("Bob",), ("Bob",), ("Mary",)]


def test_side_outputs(spark):
    events = numbered(spark, EVENTS3, EVENT)
    main, side = transforms.split_outputs(
        events, {"mary": (F.col("user") == "Mary", [F.col("url")]), "bob": (F.col("user") == "Bob", [F.col("ms")])}
    )
    assert main.count() == 3
    assert rows(side["mary"]) == [("./home",)] and rows(side["bob"]) == [(2000,)]
    tagged = transforms.tagged_outputs(
        events, {"main": (F.lit(True), F.col("user")), "mary": (F.col("user") == "Mary", F.col("url"))}
    )
    assert rows(tagged) == [("main", "Alice"), ("main", "Bob"), ("main", "Mary"), ("mary", "./home")]


def test_string_hash(spark):
    known = {
        "Alice": 63350368, "Mary": 2390779, "./prod?id=100": -855647850, "": 0,
        "polygenelubricants": -2147483648, "\U0001f600": 1772899,
    }
    df = spark.createDataFrame([(s,) for s in known], "s string")
    assert {r.s: r.h for r in df.select("s", string_hash(F.col("s")).alias("h")).collect()} == known
    register_sql_functions(spark)
    got = spark.sql("SELECT s, string_hash(s) AS h FROM {df}", df=df).collect()
    assert {r.s: r.h for r in got} == known


def test_sql_table_function(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([("x", "a?bc?"), ("y", "??")], "k string, s string")
    out = spark.sql("SELECT k, t.word, t.length FROM {df}, LATERAL split_words(s, '?') AS t", df=df)
    assert rows(out) == [("x", "a", 1), ("x", "bc", 2)]
    assert rows(transforms.lateral_split(df, "s", "?", ["k"])) == [("x", "a", 1), ("x", "bc", 2)]


def test_weighted_average(spark):
    df = spark.createDataFrame([("a", 10, 1), ("a", 21, 2), ("b", 5, 0)], "k string, v bigint, w bigint")
    out = df.groupBy("k").agg(weighted_average(F.col("v"), F.col("w")).alias("m"))
    assert rows(out) == [("a", 17), ("b", None)]
    big = spark.range(4).select(F.lit(4_000_000_000).alias("v"), F.lit(2_000_000_000).alias("w"))
    assert big.agg(weighted_average(F.col("v"), F.col("w")).alias("m")).first().m == 4_000_000_000


def test_times(spark):
    df = spark.createDataFrame([(1527816283000,), (1999,)], "ms bigint")
    text = df.select(format_time(millis_timestamp(F.col("ms"))).alias("t"))
    assert rows(text) == [("1970-01-01 00:00:01",), ("2018-06-01 01:24:43",)]
    assert rows(df.select(seconds_timestamp(F.col("ms")).alias("t")), ms("t")) == [(1000,), (1527816283000,)]
    parsed = spark.range(1).select(parse_millis(F.lit("2018-06-01 09:24:43")).alias("p"))
    assert rows(parsed) == [(1527816283000,)]


def test_to_long(spark):
    df = spark.createDataFrame([(" 12 ",), ("1000L",), ("x",)], "s string")
    assert [r.v for r in df.select(to_long(F.col("s")).alias("v")).collect()] == [12, 1000, None]


def test_partitioning(spark):
    numbers = spark.range(1, 9).select(F.col("id").alias("v"))
    placed = partitioning.with_partition(partitioning.by_partition_number(numbers, 2, F.col("v") % 2))
    assert rows(placed) == [(v, v % 2) for v in range(1, 9)]
    assert partitioning.rescaled(spark.range(0, 100, 1, 8), 2).rdd.getNumPartitions() == 2
    assert partitioning.rescaled(spark.range(0, 100, 1, 2), 5, widen=True).rdd.getNumPartitions() == 5
    sizes = rows(partitioning.partition_sizes(partitioning.round_robin(spark.range(1000), 4)))
    assert [p for p, _ in sizes] == [0, 1, 2, 3] and max(n for _, n in sizes) - min(n for _, n in sizes) <= 8
    assert partitioning.replicated(numbers, 3).groupBy("v").count().where("count = 3").count() == 8
    keyed = partitioning.with_partition(partitioning.by_key(numbers.withColumn("k", F.col("v") % 3), "k", partitions=4))
    assert keyed.select("k", "partition").distinct().count() == 3
    assert partitioning.shuffled(numbers, 3).count() == 8


def test_store_shapes(spark):
    events = numbered(spark, EVENTS8, EVENT)
    assert rows(latest_per_key(events, "user", "url", "arrival")) == [
        ("Alice", "./prod?id=200"), ("Bob", "./prod?id=3"), ("Mary", "./home"),
    ]
    doc = events.where("arrival = 1").select(json_document(F.col("user"), F.col("url")).alias("d"))
    assert rows(doc) == [('{"Mary":"./home"}',)]
    words = spark.createDataFrame([("hello",), ("world",), ("hello",)], "w string")
    assert rows(cells(words, F.lit("rowkey"), "info", F.col("w"))) == [
        ("rowkey", "info", "hello", "1"), ("rowkey", "info", "world", "1"),
    ]
