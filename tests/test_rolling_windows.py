import random

import pytest
from conftest import rows
from fixtures import EVENT, EVENTS6, HOURS, LATE, MIN, at, ms, numbered
from pyspark.sql import functions as F

from tidemark.operators import late, rolling, topn, windows


@pytest.fixture(params=[None, "2"])
def cut(spark, request):
    """Run a test with plain windows and with every key cut into segments of two rows."""
    if request.param:
        spark.conf.set("spark.tidemark.segmentRows", request.param)
    yield
    spark.conf.unset("spark.tidemark.segmentRows")


def test_rolling_on_six_events(spark, cut):
    events = numbered(spark, EVENTS6, EVENT)
    assert rows(rolling.rolling_count(events, "user", "arrival"), "arrival", "user", "cnt") == [
        (1, "Mary", 1), (2, "Bob", 1), (3, "Alice", 1), (4, "Bob", 2), (5, "Bob", 3), (6, "Alice", 2),
    ]
    assert rows(rolling.rolling_max(events, "user", "arrival", "ms", ["url"]), "arrival", "url", "ms") == [
        (1, "./home", 1000), (2, "./cart", 2000), (3, "./prod?id=100", 3000),
        (4, "./cart", 3300), (5, "./cart", 3500), (6, "./prod?id=100", 3200),
    ]
    assert rows(rolling.rolling_max_by(events, "user", "arrival", "ms", ["url"]), "arrival", "url", "ms") == [
        (1, "./home", 1000), (2, "./cart", 2000), (3, "./prod?id=100", 3000),
        (4, "./prod?id=1", 3300), (5, "./home", 3500), (6, "./prod?id=200", 3200),
    ]
    assert rows(rolling.most_active(events, "user", "arrival")) == [
        (1, "Mary", 1), (2, "Bob", 1), (3, "Alice", 1), (4, "Bob", 2), (5, "Bob", 3), (6, "Bob", 3),
    ]
    assert rows(rolling.final_most_active(events, "user", "arrival")) == [("Bob", 3)]
    assert rows(rolling.rolling_sum(events, "user", "arrival", "ms"), "arrival", "total")[5] == (6, 6200)


def test_rolling_max_by_keeps_the_first_on_a_tie(spark, cut):
    df = numbered(spark, [("a", "x", 5), ("a", "y", 5), ("a", "z", 4)], EVENT)
    assert [r[1] for r in rows(rolling.rolling_max_by(df, "user", "arrival", "ms", ["url"]), "arrival", "url")] == ["x"] * 3


def test_every_nth_average(spark, cut):
    df = at(numbered(spark, [("a", 1000 * i) for i in range(1, 12)], "user string, ms bigint"))
    out = rolling.every_nth_average(df, "user", "arrival", "ts")
    assert rows(out) == [("a", 5, 5, 3000), ("a", 10, 10, 5500)]


def test_tumble_cumulate_topn_on_hours(spark):
    df = at(numbered(spark, HOURS, "user string, ms bigint"))
    counts = windows.tumbling_count(df, "ts", "1 hour", ["user"])
    assert rows(counts, "user", ms("window_end"), "cnt") == [
        ("Alice", 60 * MIN, 3), ("Bob", 60 * MIN, 1), ("Bob", 120 * MIN, 1), ("Cary", 120 * MIN, 2),
    ]
    grown = windows.cumulate_count(df, "ts", "1 hour", "30 minutes", ["user"])
    assert rows(grown, "user", ms("window_end"), "cnt") == [
        ("Alice", 30 * MIN, 2), ("Alice", 60 * MIN, 3), ("Bob", 30 * MIN, 1), ("Bob", 60 * MIN, 1),
        ("Bob", 90 * MIN, 1), ("Bob", 120 * MIN, 1), ("Cary", 120 * MIN, 2),
    ]
    top = topn.window_top_n(df, "ts", "1 hour", "user", 2)
    assert rows(top, ms("window_end"), "row_num", "user", "cnt") == [
        (60 * MIN, 1, "Alice", 3), (60 * MIN, 2, "Bob", 1), (120 * MIN, 1, "Cary", 2), (120 * MIN, 2, "Bob", 1),
    ]


def test_global_topn(spark):
    clicks = [("Mary",)] * 3 + [("Alice",)] + [("Bob",)] * 8
    counts = spark.createDataFrame(clicks, "user string").groupBy("user").agg(F.count("*").alias("cnt"))
    assert rows(topn.top_n(counts, "user", 2), "row_num", "user", "cnt") == [(1, "Bob", 8), (2, "Mary", 3)]


def test_top_values(spark):
    data = [(1, "a", 3), (1, "b", 1), (1, "c", 5), (2, "a", 7)]
    counts = spark.createDataFrame(data, "window_end int, url string, cnt bigint")
    assert rows(topn.top_values_per_window(counts), "window_end", "value", "rank") == [(1, 3, 2), (1, 5, 1), (2, 7, 1)]


def test_early_firing(spark):
    df = at(numbered(spark, [("u", 500), ("u", 1000), ("u", 2500), ("u", 9500), ("v", 9500)], "url string, ms bigint"))
    out = rows(windows.early_firing(df, "ts", "10 seconds", "1 second", ["url"]), "url", ms("fired_at"), "cnt")
    expected = [("u", 1000, 2), ("u", 2000, 2)] + [("u", t, 3) for t in range(3000, 10000, 1000)]
    assert out == expected + [("u", 9999, 4), ("v", 9999, 1)]


def test_random_windows(spark):
    r = random.Random(1)
    df = at(numbered(spark, [(r.choice("abc"), r.randrange(100_000)) for _ in range(300)], "k string, ms bigint"))
    sliding = windows.sliding_count(df, "ts", "10 seconds", "2 seconds", ["k"])
    assert sliding.agg(F.sum("cnt")).first()[0] == 300 * 5
    tumbled = windows.tumbling_count(df, "ts", "10 seconds", ["k"])
    last = windows.cumulate_count(df, "ts", "10 seconds", "2 seconds", ["k"]).where(
        F.col("window_end") == F.col("window_start") + F.expr("INTERVAL 10 SECONDS")
    )
    assert rows(last, "k", "window_start", "cnt") == rows(tumbled, "k", "window_start", "cnt")
    uneven = windows.sliding_count(df, "ts", "5 seconds", "2 seconds", ["k"])
    direct = df.groupBy("k", F.window("ts", "5 seconds", "2 seconds").alias("w")).agg(F.count("*").alias("cnt"))
    assert rows(uneven, "k", "window_start", "cnt") == rows(direct, "k", "w.start", "cnt")
    pv = windows.sliding_pv_uv(df, "ts", "10 seconds", "2 seconds", "k")
    assert pv.agg(F.sum("pv")).first()[0] == 1500 and pv.agg(F.max("uv")).first()[0] <= 3
    exact, near = (windows.tumbling_uv(df, "ts", "10 seconds", "k", a) for a in (False, True))
    assert rows(exact, "window_start", "uv") == rows(near, "window_start", "uv")


def late_rows(spark):
    return at(numbered(spark, LATE, "url string, ms bigint"))


def test_late_data_trace(spark, cut):
    df = late.classify_late(late_rows(spark), "ts", ["arrival"], "10 seconds", "2 seconds", "60 seconds")
    marks = [None, -1001, -1, 7999, 7999, 9999, 12999, 12999, 12999, 67999, 67999, 69999]
    kinds = ["on_time"] * 6 + ["late", "late", "on_time", "late", "on_time", "dropped"]
    got = rows(df, "arrival", ms("watermark"), "arrived")
    assert got == [(i + 1, m, k) for i, (m, k) in enumerate(zip(marks, kinds))]
    results = rows(late.refired_counts(df, ["url"], ["arrival"]), "url", ms("window_start"), "refired_by", "cnt")
    home = [r[2:] for r in results if r[:2] == ("./home", 0)]
    assert sorted(home, key=lambda r: r[1]) == [(None, 3), (7, 4), (8, 5), (10, 6)]
    assert rows(late.late_rows(df), "arrival") == [(12,)]
    assert ("./home", 0, 6) in rows(late.final_counts(df, ["url"]), "url", ms("window_start"), "cnt")


def test_without_lateness_a_late_row_changes_nothing(spark, cut):
    data = [("Alice", t) for t in (1000, 2000, 10000, 8000, 15000, 9000)]
    df = at(numbered(spark, data, "user string, ms bigint"))
    judged = late.classify_late(df, "ts", ["arrival"], "10 seconds", "5 seconds", "0 seconds")
    assert rows(late.final_counts(judged, ["user"]), ms("window_start"), "cnt") == [(0, 3), (10000, 2)]
    assert rows(late.late_rows(judged), "arrival") == [(6,)]


def test_union_watermark(spark, cut):
    df = at(numbered(spark, [("a", 5000), ("b", 1000), ("a", 7000), ("b", 9000), ("b", 2000)], "s string, ms bigint"))
    parts = {s: df.where(F.col("s") == s).drop("s") for s in "ab"}
    out = late.union_watermark(parts, "ts", ["arrival"], "0 seconds")
    assert rows(out, "arrival", ms("watermark")) == [(1, None), (2, None), (3, 999), (4, 999), (5, 6999)]


def test_random_late_rows_are_partitioned(spark, cut):
    r = random.Random(2)
    data = [(r.choice("ab"), max(0, 1000 * i - r.randrange(40_000))) for i in range(80)]
    df = at(numbered(spark, data, "k string, ms bigint"))
    judged = late.classify_late(df, "ts", ["arrival"], "10 seconds", "3 seconds", "10 seconds")
    seen, expected = None, []
    for i, (_, t) in enumerate(data):
        end = t // 10_000 * 10_000 + 10_000
        mark = None if seen is None else seen - 3001
        kind = "on_time" if mark is None or end - 1 > mark else "late" if end - 1 + 10_000 > mark else "dropped"
        expected.append((i + 1, kind))
        seen = t if seen is None else max(seen, t)
    assert rows(judged, "arrival", "arrived") == expected
    assert {k for _, k in expected} == {"on_time", "late", "dropped"}
