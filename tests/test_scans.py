"""The segmented forms must equal the plain window forms, whatever the key sizes."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans.scans import extend, highest, look_back, lowest, neighbours, running, total
from tidemark.plans import skew
from tidemark.plans.skew import hot_keys, segmented


def skewed(spark, seed=3, n=400):
    r = random.Random(seed)
    data = []
    for i in range(n):
        key = r.choice(["hot", "hot", "hot", None, "warm", f"cold{r.randrange(60)}"])
        data.append((key, r.randrange(120), i, r.randrange(1000)))
    r.shuffle(data)
    return spark.createDataFrame(data, "k string, ts bigint, id bigint, v int").repartition(5)


def both(spark, build):
    spark.conf.unset("spark.tidemark.segmentRows")
    plain = rows(build())
    spark.conf.set("spark.tidemark.segmentRows", "7")
    try:
        return plain, rows(build())
    finally:
        spark.conf.unset("spark.tidemark.segmentRows")


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running(spark, keys, reverse):
    df = skewed(spark)
    plain, cut = both(
        spark,
        lambda: running(
            df, keys, ["ts", "id"], reverse,
            n=total(F.lit(1)),
            s=total(F.col("v"), before=True),
            top=highest(F.struct("v", "id")),
            low=lowest(F.col("v"), before=True),
        ),
    )
    assert plain == cut


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_neighbours(spark, keys, reverse):
    df = skewed(spark, seed=5)
    plain, cut = both(
        spark,
        lambda: neighbours(
            df, keys, ["ts", "id"], {"a": (F.col("v"), 1), "b": (F.col("id"), 3)}, reverse
        ),
    )
    assert plain == cut


def test_segments_are_bounded_and_ordered(spark, tiny_segments):
    df = spark.range(1000).select((F.col("id") * 0).alias("k"), "id")
    cut = segmented(df, ["k"], ["id"]).frame
    sizes = cut.groupBy("__segment").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    found = [tuple(r) for r in sizes.orderBy("__segment").select("n", "lo", "hi").collect()]
    assert max(n for n, _, _ in found) <= 14
    assert all(a[2] < b[1] for a, b in zip(found, found[1:]))


def test_sampled_hot_keys(spark):
    """With a real limit only a share of the rows is looked at; the result is the same."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(2000)) + 1)
    df = spark.range(300_000).select(key.alias("k"), "id")
    plain = running(df, ["k"], ["id"], n=total(F.lit(1)))
    spark.conf.set("spark.tidemark.segmentRows", "5000")
    try:
        hot = hot_keys(df, ["k"]).frame.collect()
        assert [r["__key_k"] for r in hot] == [0] and 60_000 < hot[0]["__rows"] < 150_000
        cut = segmented(df, ["k"], ["id"])
        sizes = [r["count"] for r in cut.frame.where("k = 0").groupBy("__segment").count().collect()]
        assert sum(sizes) == 100_000 and len(sizes) > 10 and max(sizes) < 15_000
        split = running(df, ["k"], ["id"], n=total(F.lit(1)))
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    finally:
        spark.conf.unset("spark.tidemark.segmentRows")


def test_scans_share_one_shuffle(spark, tiny_segments):
    """A forward scan, a backward scan and a look back over cut rows shuffle the rows once."""
    df = skewed(spark)
    cut = segmented(df, ["k"], ["ts", "id"])
    once = extend(cut, ["k"], ["ts", "id"], n=total(F.lit(1)))
    both_ways = extend(once, ["k"], ["ts", "id"], reverse=True, m=total(F.lit(1)))
    out = look_back(both_ways, ["k"], ["ts", "id"], {"p": (F.col("v"), 1)}).plain()
    per_key = {r.k: r.c for r in df.groupBy("k").agg(F.count("*").alias("c")).collect()}
    assert all(r.n + r.m == per_key[r.k] + 1 for r in out.collect())
    big = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines()
           if "Exchange hashpartitioning(k" in line and "__segment" in line]
    left_most = min(len(line) - len(line.lstrip(" :+-|")) for line in big)
    assert sum(len(line) - len(line.lstrip(" :+-|")) == left_most for line in big) == 1


def test_rows_of_one_time_are_parted(spark, tiny_segments):
    df = spark.range(300).select(F.lit("k").alias("k"), F.lit(5).alias("ts"), "id").repartition(4)
    cut = segmented(df, ["k"], ["ts", "id"])
    sizes = [r["count"] for r in cut.frame.groupBy("__segment").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 14
    counted = running(df, ["k"], ["ts", "id"], n=total(F.lit(1)))
    assert rows(counted, "id", "n") == [(i, i + 1) for i in range(300)]


def test_cuts_without_a_limit(spark, tiny_segments, monkeypatch):
    """Keys and cut points beyond what a plan holds as constants, and keys with more segments than one cut makes."""
    df = spark.range(1500).select(F.when(F.col("id") < 900, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 30).cast("string"))).alias("k"), F.col("id").alias("ts"), "id")
    spark.conf.unset("spark.tidemark.segmentRows")
    plain = rows(running(df, ["k"], ["ts", "id"], n=total(F.lit(1)), s=highest(F.struct("id", "k"), before=True)))
    every = rows(running(df, [], ["ts", "id"], reverse=True, n=total(F.lit(1))))
    spark.conf.set("spark.tidemark.segmentRows", "7")
    monkeypatch.setattr(skew, "CONSTANTS", 5)
    monkeypatch.setattr(skew, "COARSE", 8)
    cut = segmented(df, ["k"], ["ts", "id"])
    assert hot_keys(df, ["k"]).count == 31
    sizes = [tuple(r) for r in cut.frame.groupBy("k", "__segment").agg(F.count("*"), F.min("id"), F.max("id")).orderBy("k", "__segment").collect()]
    assert max(n for _, _, n, _, _ in sizes) <= 28 and max(s for _, s, *_ in sizes) < cut.top
    assert len([1 for k, *_ in sizes if k == "hot"]) > 60
    assert all(a[4] < b[3] for a, b in zip(sizes, sizes[1:]) if a[0] == b[0])
    assert rows(running(df, ["k"], ["ts", "id"], n=total(F.lit(1)), s=highest(F.struct("id", "k"), before=True))) == plain
    assert rows(running(df, [], ["ts", "id"], reverse=True, n=total(F.lit(1)))) == every
