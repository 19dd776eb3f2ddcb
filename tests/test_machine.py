"""Composition along segments, and table-driven machines cut and uncut."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import joins, machine, rolling
from tidemark.plans.compose import composed, then

TABLE = {
    ("idle", "a"): ("one", False), ("one", "a"): ("two", False), ("two", "a"): ("three", True),
    ("three", "a"): ("three", True), ("three", "b"): ("one", False), ("two", "b"): ("two", False),
}


def walked(data):
    """The machine by plain Python: (id, state, alert)."""
    out, state = [], {}
    for key, at, n, symbol in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        state[key], alert = TABLE.get((state.get(key, "idle"), symbol), ("idle", False))
        out.append((n, state[key], alert))
    return sorted(out)


@pytest.mark.parametrize("segment", [None, "2", "7"])
def test_machine(spark, segment):
    r = random.Random(4)
    data = [(r.choice(["hot", "hot", "hot", None, f"k{r.randrange(9)}"]), r.randrange(50), i, r.choice(["a", "a", "a", "b", "c", None])) for i in range(500)]
    df = spark.createDataFrame(r.sample(data, len(data)), "k string, at long, id long, symbol string").repartition(5)
    if segment:
        spark.conf.set("spark.tidemark.segmentRows", segment)
    try:
        ran = machine.run_machine(df, "k", ["at", "id"], "symbol", TABLE, "idle")
        assert ran.columns == ["k", "at", "id", "symbol", "state", "alert"]
        assert rows(ran, "id", "state", "alert") == walked(data)
    finally:
        spark.conf.unset("spark.tidemark.segmentRows")


def test_machine_without_rows(spark):
    none = spark.createDataFrame([], "k string, at long, symbol string")
    assert machine.run_machine(none, "k", ["at"], "symbol", TABLE, "idle").count() == 0
    with pytest.raises(ValueError):
        machine.run_machine(none.withColumn("state", F.lit(1)), "k", ["at"], "symbol", TABLE, "idle")


@pytest.mark.parametrize("fan", [2, 3, 256])
@pytest.mark.parametrize("reverse", [False, True])
def test_composed(spark, fan, reverse):
    r = random.Random(6)
    data = [(k, at, [r.randrange(3) for _ in range(3)]) for k in ("x", None, "y") for at in r.sample(range(40), 25 if k else 1)]
    df = spark.createDataFrame(data, "k string, at long, map array<long>")
    start = F.array(*[F.lit(i).cast("long") for i in range(3)])
    found = composed(df, ["k"], "at", "map", then, start, 40, reverse, fan)
    expected = []
    for k in ("x", None, "y"):
        held = [0, 1, 2]
        for _, at, m in sorted((d for d in data if d[0] == k), key=lambda d: d[1], reverse=reverse):
            expected.append((k, at, held))
            held = [m[s] for s in held]
    assert rows(found, "k", "at", "__before") == rows(spark.createDataFrame(expected, "k string, at long, b array<long>"))


@pytest.mark.parametrize("segment", [None, "3"])
def test_rules_in_force(spark, segment):
    """Rules replace each other; actions before the first one match nothing; a rule that arrives with an action holds for it."""
    actions = [("u", 1, "a"), ("u", 2, "b"), ("v", 3, "a"), ("u", 5, "a"), ("u", 6, "b"), ("v", 8, "b"), ("u", 9, "a"), ("u", 10, "c"), ("v", 11, None), (None, 12, "a"), (None, 13, "c")]
    rules = [(4, "a", "b"), (7, "b", "a"), (10, "a", "c"), (None, "a", "b")]
    if segment:
        spark.conf.set("spark.tidemark.segmentRows", segment)
    try:
        found = joins.rules_in_force(
            spark.createDataFrame(actions, "k string, at long, action string"),
            spark.createDataFrame(rules, "came long, action1 string, action2 string"),
            "k", "at", "action", "came",
        )
        assert rows(found, "k", "at", "action1", "action2", "rule_came") == rows(
            spark.createDataFrame([("u", 6, "a", "b", 4), ("u", 9, "b", "a", 7), ("u", 10, "a", "c", 10), (None, 13, "a", "c", 10)], "k string, at long, a string, b string, r long")
        )
    finally:
        spark.conf.unset("spark.tidemark.segmentRows")


def test_changelog(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3), ("x", 4)], "k string, at long")
    changes = rolling.count_changelog(df, "k", "at")
    assert rows(changes, "at", "k", "kind", "cnt") == [
        (1, "x", "+I", 1), (2, "y", "+I", 1), (3, "x", "+U", 2), (3, "x", "-U", 1), (4, "x", "+U", 3), (4, "x", "-U", 2)
    ]
    assert rows(rolling.keys_per_count(changes), "cnt", "keys") == [(1, 1), (3, 1)]
