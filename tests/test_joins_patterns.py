import random

import pytest
from conftest import rows
from fixtures import LOGINS, MIN, at, ms, numbered
from pyspark.sql import functions as F

from tidemark.functions.aggregates import weighted_average
from tidemark.operators import joins, keyed_state, patterns


@pytest.fixture(params=[None, "2"])
def cut(spark, request):
    if request.param:
        spark.conf.set("spark.tidemark.segmentRows", request.param)
    yield
    spark.conf.unset("spark.tidemark.segmentRows")


def keyed(spark, data):
    return at(spark.createDataFrame(data, "k string, ms bigint")).drop("ms")


def pairs(df):
    return rows(df, "k", ms("left_ts"), ms("right_ts"))


def test_window_join(spark):
    left = keyed(spark, [("a", 1000), ("b", 1000), ("b", 2000), ("a", 5000)])
    right = keyed(spark, [("a", 3000), ("b", 4000), ("a", 6000)])
    assert pairs(joins.window_join(left, right, "k", "ts", "5 seconds")) == [
        ("a", 1000, 3000), ("a", 5000, 6000), ("b", 1000, 4000), ("b", 2000, 4000),
    ]


@pytest.mark.parametrize("chunk", [None, 1])
def test_window_cogroup(spark, chunk):
    left = keyed(spark, [("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000)])
    right = keyed(spark, [("a", 3000), ("b", 3000), ("a", 4000), ("a", 6000), ("b", 4000)])
    out = joins.window_cogroup(left, right, "k", "ts", "5 seconds", "ts", chunk_rows=chunk)
    found = {}
    for k, start, _, l, r in rows(out, "k", ms("window_start"), "chunk", "left_items", "right_items"):
        a, b = found.setdefault((k, start), ([], []))
        a += [t.second for t in l]
        b += [t.second for t in r]
    assert found == {("a", 0): ([1, 2], [3, 4]), ("b", 0): ([1, 2], [3, 4]), ("a", 5000): ([], [6])}


def test_interval_join(spark):
    left = keyed(spark, [("o2", 5000), ("o3", 20000), ("o4", 20000)])
    right = keyed(spark, [("o2", 3000), ("o2", 15000), ("o2", 15001), ("o3", 23000), ("o3", 30000),
                          ("o4", 15000), ("o4", 15001), ("o4", 14999), ("o3", 30001)])
    assert pairs(joins.interval_join(left, right, "k", "ts", "5 seconds", "10 seconds")) == [
        ("o2", 5000, 3000), ("o2", 5000, 15000), ("o3", 20000, 23000), ("o3", 20000, 30000),
        ("o4", 20000, 15000), ("o4", 20000, 15001),
    ]


def random_sides(spark, seed):
    r = random.Random(seed)
    make = lambda n: [(r.choice(["hot", "hot", "x", None, f"c{r.randrange(9)}"]), r.randrange(100_000)) for _ in range(n)]
    return make(120), make(150)


def test_interval_join_random(spark):
    l, r = random_sides(spark, 4)
    expected = sorted((k, a, b) for k, a in l for j, b in r if j == k and k is not None and a - 2000 <= b <= a + 7000)
    assert pairs(joins.interval_join(keyed(spark, l), keyed(spark, r), "k", "ts", "2 seconds", "7 seconds")) == expected


def test_reconcile(spark, cut):
    app = keyed(spark, [("order-1", 1000), ("order-2", 2000)])
    bank = keyed(spark, [("order-1", 3000), ("order-3", 4000)])
    out = joins.reconcile(app, bank, "k", "ts", "5 seconds")
    assert rows(out, "k", "status") == [("order-1", "matched"), ("order-2", "missing_right"), ("order-3", "missing_left")]


def test_reconcile_random(spark, cut):
    l, r = random_sides(spark, 6)
    near = lambda a, b: abs(a - b) <= 3000
    same = lambda j, k: j == k and k is not None
    expected = [(k, a, b, "matched") for k, a in l for j, b in r if same(j, k) and near(a, b)]
    expected += [(k, a, None, "missing_right") for k, a in l if not any(same(j, k) and near(a, b) for j, b in r)]
    expected += [(k, None, b, "missing_left") for k, b in r if not any(same(j, k) and near(a, b) for j, a in l)]
    out = joins.reconcile(keyed(spark, l), keyed(spark, r), "k", "ts", "3 seconds")
    got = [tuple(x) for x in out.select("k", ms("left_ts"), ms("right_ts"), "status").collect()]
    key = lambda t: tuple(str(v) for v in t)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_regular_join(spark):
    left = keyed(spark, [("a", 1000), ("b", 2000)])
    right = keyed(spark, [("a", 3000), ("b", 4000), ("a", 5000)])
    assert pairs(joins.regular_join(left, right, "k", "ts")) == [("a", 1000, 3000), ("a", 1000, 5000), ("b", 2000, 4000)]
    assert {r.last for r in joins.regular_join(left, right, "k", "ts").collect()} == {"right"}


def test_sequence_rules(spark, cut):
    actions = numbered(spark, [("Alice", "login"), ("Alice", "pay"), ("Bob", "login"), ("Bob", "buy")], "u string, a string")
    rules = numbered(spark, [("login", "pay"), ("login", "buy")], "action1 string, action2 string")
    out = joins.sequence_rules(actions, rules, "u", "arrival", "a")
    assert rows(out, "u", "action1", "action2") == [("Alice", "login", "pay"), ("Bob", "login", "buy")]
    out = joins.sequence_rules(actions, rules, "u", "arrival", "a", mode="latest", rule_arrival="arrival")
    assert rows(out, "u") == [("Bob",)]


def logins(spark):
    return at(numbered(spark, LOGINS, "user string, kind string, ms bigint"))


def test_login_patterns(spark, cut):
    fail = F.col("kind") == "fail"
    strict = patterns.strict_sequence(logins(spark), "user", ["ts", "arrival"], [fail] * 3, "ts")
    assert rows(strict, "user", ms("first_ts"), ms("second_ts"), ms("third_ts")) == [("user_1", 2000, 3000, 5000)]
    times = patterns.repeated(logins(spark), "user", ["ts", "arrival"], fail, 3, "ts")
    assert rows(times, "user", ms("first_ts"), ms("last_ts")) == [("user_1", 2000, 5000)]


def test_machine_in_arrival_order(spark, cut):
    fail = F.col("kind") == "fail"
    data = [("u1", "fail"), ("u1", "fail"), ("u2", "fail"), ("u1", "fail"), ("u2", "success"), ("u2", "fail"),
            ("u2", "fail"), ("u1", "fail")]
    df = numbered(spark, data, "user string, kind string")
    assert rows(patterns.alerts_by_arrival(df, "user", "arrival", fail), "arrival") == [(4,), (8,)]


def test_paid_within(spark, cut):
    data = [("o1", "create", 1000), ("o2", "create", 2000), ("o1", "modify", 10_000), ("o1", "pay", 60_000),
            ("o3", "create", 10 * MIN), ("o3", "pay", 24 * MIN), ("o4", "create", 0), ("o4", "pay", 15 * MIN)]
    df = at(numbered(spark, data, "o string, kind string, ms bigint"))
    out = patterns.followed_by(
        df, "o", ["ts", "arrival"], F.col("kind") == "create", F.col("kind") == "pay", "ts", "15 minutes"
    )
    assert rows(out, "o", ms("end_ts"), "status") == [
        ("o1", 60_000, "matched"), ("o2", None, "timeout"), ("o3", 24 * MIN, "matched"), ("o4", None, "timeout"),
    ]


def test_timers(spark):
    df = at(spark.createDataFrame([("u", 1000), ("u", 11000), ("u", 11001), ("u", 11001)], "k string, ms bigint"))
    out = keyed_state.event_timers(df, "k", "ts", "10 seconds")
    assert rows(out.where("kind = 'timer'"), ms("at")) == [(11000,), (21000,), (21001,)]
    assert out.where("kind = 'row'").count() == 4


def test_periodic_totals(spark, cut):
    df = at(spark.createDataFrame([("u", t * 1000) for t in (1, 5, 11, 12, 30)], "k string, ms bigint"))
    out = keyed_state.periodic_totals(df, "k", "ts", "10 seconds")
    assert rows(out, (F.col("fire_at") / 1_000_000).alias("at"), "total") == [(11.0, 3), (22.0, 4), (40.0, 5)]


def test_periodic_totals_random(spark, cut):
    r = random.Random(8)
    data = [(r.choice(["hot", "hot", f"c{r.randrange(40)}"]), r.randrange(200)) for _ in range(300)]
    expected = []
    for k in {k for k, _ in data}:
        due, seen = None, 0
        for t in sorted(t for j, t in data if j == k):
            if due is not None and t > due:
                expected.append((k, due * 1_000_000, seen))
                due = None
            due = t + 7 if due is None else due
            seen += 1
        expected.append((k, due * 1_000_000, seen))
    df = at(spark.createDataFrame([(k, t * 1000) for k, t in data], "k string, ms bigint"))
    assert rows(keyed_state.periodic_totals(df, "k", "ts", "7 seconds"), "k", "fire_at", "total") == sorted(expected)


def test_ttl_count(spark, cut):
    data = [("a", t) for t in (0, 3000, 12_999, 23_000, 32_999)] + [("b", 5000)]
    df = at(numbered(spark, data, "k string, ms bigint"))
    out = keyed_state.ttl_count(df, "k", "ts", "arrival", "10 seconds")
    assert rows(out, "arrival", "cnt") == [(1, 1), (2, 2), (3, 3), (4, 1), (5, 2), (6, 1)]


def test_buffered(spark, cut):
    df = spark.range(25).withColumnRenamed("id", "arrival").repartition(3)
    assert rows(keyed_state.buffered(df, ["arrival"], 10)) == [(i, i // 10, i % 10) for i in range(20)]


def test_cogroup_does_not_depend_on_settings(spark, tiny_segments):
    side = keyed(spark, [("a", n) for n in range(40)])
    out = joins.window_cogroup(side, side, "k", "ts", "5 seconds", "ts").collect()
    assert len(out) == 1 and len(out[0]["left_items"]) == len(out[0]["right_items"]) == 40
    items = joins.window_cogroup_items(side, side.limit(3), "k", "ts", "5 seconds", "ts")
    found = rows(items, "side", "position", ms("ts"))
    assert [r for r in found if r[0] == "left"] == [("left", n, n) for n in range(40)]
    assert [r[1] for r in found if r[0] == "right"] == [0, 1, 2]


def test_reconcile_null_times_and_keys(spark):
    left = keyed(spark, [("a", 1000), (None, 1000)])
    right = keyed(spark, [("a", 2000), (None, 1000)]).unionByName(
        keyed(spark, [("a", 1)]).withColumn("ts", F.lit(None).cast("timestamp_ntz").cast(left.schema["ts"].dataType))
    )
    out = joins.reconcile(left, right, "k", "ts", "5 seconds")
    assert sorted(r["status"] for r in out.collect()) == ["matched", "missing_left", "missing_left", "missing_right"]


@pytest.mark.parametrize("n", [1, 2, 8])
def test_sequences_of_any_length(spark, tiny_segments, n):
    df = keyed(spark, [("a", t) for t in range(40)])
    out = patterns.strict_sequence(df, "k", ["ts"], [F.lit(True)] * n, "ts")
    assert out.count() == 41 - n
    assert len(out.columns) == n + 1


def test_weighted_average_of_large_products(spark):
    df = spark.sql("SELECT * FROM VALUES (4000000000L, 4000000000L), (2L, 4000000000L) AS t(v, w)")
    assert df.agg(weighted_average(F.col("v"), F.col("w")).alias("x")).first()["x"] == 2_000_000_001


def test_periodic_totals_without_times(spark, tiny_segments):
    known = [("a", t * 1000) for t in range(30)]
    odd = keyed(spark, [("a", 5)]).withColumn("ts", F.lit(None).cast(keyed(spark, [("a", 5)]).schema["ts"].dataType))
    plain_rows = rows(keyed_state.periodic_totals(keyed(spark, known), "k", "ts", "5 seconds"))
    assert rows(keyed_state.periodic_totals(keyed(spark, known).unionByName(odd), "k", "ts", "5 seconds")) == plain_rows
