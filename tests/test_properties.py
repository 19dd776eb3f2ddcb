"""Results must not depend on how the input is spread over partitions."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (puts the package on the path)
from tidemark.catalog.registry import table
from tidemark.operators import joins, keyed_state, late, patterns, rolling, windows

SF_DIR = "/root/testdata/sf0.001"
ERROR = "event_type = 'error'"

OPERATORS = {
    "rolling_max_by": lambda e: rolling.rolling_max_by(e, "user_id", "event_id", "value", ["event_type"]),
    "most_active": lambda e: rolling.most_active(e, "user_id", "event_id"),
    "early_firing": lambda e: windows.early_firing(e, "ts", "6 hours", "1 hour", ["event_type"]),
    "watermark": lambda e: late.watermark_trace(e, "ts", ["event_id"], "1 hour"),
    "strict": lambda e: patterns.strict_sequence(e, "user_id", ["ts", "event_id"], [F.expr(ERROR), F.expr(ERROR)], "ts"),
    "followed": lambda e: patterns.followed_by(
        e, "user_id", ["ts", "event_id"], F.col("event_type") == "signup", F.expr(ERROR), "ts", "3 hours"
    ),
    "periodic": lambda e: keyed_state.periodic_totals(e, "user_id", "ts", "3 hours"),
    "buffered": lambda e: keyed_state.buffered(e.select("event_id"), ["event_id"], 7),
    "cogroup": lambda e: joins.window_cogroup(
        e.where(ERROR), e.where(f"NOT {ERROR}"), "user_id", "ts", "12 hours", "event_id", tie="event_id"
    ),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
@pytest.mark.parametrize("segment_rows", ["1000000", "50"])
def test_partitioning_does_not_matter(spark, name, segment_rows):
    events = table(spark, SF_DIR, "events")
    spark.conf.set("spark.tidemark.segmentRows", segment_rows)
    try:
        one = rows(OPERATORS[name](events.coalesce(1)))
        assert rows(OPERATORS[name](events.repartition(7, F.rand(5)))) == one
    finally:
        spark.conf.unset("spark.tidemark.segmentRows")
