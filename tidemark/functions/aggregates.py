"""Custom aggregates and their SQL registrations."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def weighted_average(value: Column, weight: Column) -> Column:
    """``sum(value * weight) div sum(weight)`` as bigint; null when the weights sum to zero.

    Products and sums are decimals, since both may leave the bigint range.
    """
    weighted = F.sum(value.cast("decimal(19,0)") * weight.cast("decimal(19,0)"))
    weights = F.sum(weight.cast("decimal(20,0)"))
    return F.call_function("div", weighted, F.nullif(weights, F.lit(0)))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the scalar and table functions callable from SQL.

    They are SQL functions, so calls are inlined into the plan and stay in the JVM.
    """
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION string_hash(s STRING) RETURNS INT RETURN
          CAST(aggregate(
            CASE WHEN s = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split(s, '') END,
            0L,
            (h, c) -> pmod(CASE
              WHEN ascii(c) > 65535 THEN (h * 31 + 55296 + (ascii(c) - 65536) div 1024) * 31
                                         + 56320 + (ascii(c) - 65536) % 1024
              ELSE h * 31 + ascii(c) END, 4294967296L),
            h -> CASE WHEN h >= 2147483648L THEN h - 4294967296L ELSE h END) AS INT)
    """)
    spark.sql(r"""
        CREATE OR REPLACE TEMPORARY FUNCTION split_words(s STRING, delimiter STRING)
          RETURNS TABLE (word STRING, length INT) RETURN
          SELECT p.word, length(p.word) FROM explode(
            CASE WHEN s <> '' AND rtrim(delimiter, s) = '' THEN CAST(array() AS ARRAY<STRING>)
                 ELSE split(rtrim(delimiter, s), concat('\\Q', delimiter, '\\E')) END) AS p(word)
    """)
    # The cumulating windows that hold a time end at its own step's end, and so on to the full window's.
    # A bare generator as the body keeps the lateral join a generator in the plan.
    t = "unix_micros(CAST(ts AS TIMESTAMP))"
    step, size = (f"(unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + {i}))" for i in ("step", "size"))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION cumulate_windows(
            ts TIMESTAMP_NTZ, step INTERVAL DAY TO SECOND, size INTERVAL DAY TO SECOND)
          RETURNS TABLE (window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ) RETURN
          SELECT w.s, w.e FROM inline(transform(
            sequence({t} - pmod({t}, {step}) + {step}, {t} - pmod({t}, {size}) + {size}, {step}),
            e -> struct(CAST(timestamp_micros({t} - pmod({t}, {size})) AS TIMESTAMP_NTZ),
                        CAST(timestamp_micros(e) AS TIMESTAMP_NTZ)))) AS w(s, e)
    """)
