"""Small literal inputs used across the tests. ``arrival`` is the position in the list."""

from pyspark.sql import functions as F


def numbered(spark, data, schema):
    """Rows with their position in ``arrival``."""
    rows = [(i + 1, *r) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, f"arrival bigint, {schema}")


def at(df, millis="ms", name="ts"):
    """Event time from epoch milliseconds."""
    return df.withColumn(name, F.timestamp_millis(millis).cast("timestamp_ntz"))


def ms(column):
    return F.unix_millis(F.col(column).cast("timestamp")).alias(column)


EVENTS3 = [("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000)]
EVENTS6 = EVENTS3 + [("Bob", "./prod?id=1", 3300), ("Bob", "./home", 3500), ("Alice", "./prod?id=200", 3200)]
EVENTS8 = [
    ("Mary", "./home", 1000),
    ("Bob", "./cart", 2000),
    ("Alice", "./prod?id=100", 3000),
    ("Bob", "./prod?id=1", 3300),
    ("Alice", "./prod?id=200", 3200),
    ("Bob", "./home", 3500),
    ("Bob", "./prod?id=2", 3800),
    ("Bob", "./prod?id=3", 4200),
]
EVENT = "user string, url string, ms bigint"

LATE = [
    ("./home", 1000), ("./home", 2000), ("./home", 10000), ("./home", 9000), ("./cart", 12000),
    ("./prod?id=100", 15000), ("./home", 9000), ("./home", 8000), ("./prod?id=200", 70000),
    ("./home", 8000), ("./prod?id=300", 72000), ("./home", 8000),
]

MIN = 60_000
HOURS = [
    ("Alice", 1000), ("Bob", 1000), ("Alice", 25 * MIN), ("Alice", 55 * MIN), ("Bob", 61 * MIN),
    ("Cary", 90 * MIN), ("Cary", 119 * MIN),
]

LOGINS = [
    ("user_1", "fail", 2000), ("user_1", "fail", 3000), ("user_2", "fail", 4000), ("user_1", "fail", 5000),
    ("user_2", "fail", 7000), ("user_2", "fail", 8000), ("user_2", "success", 6000),
]
