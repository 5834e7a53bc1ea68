"""Domain-shaped views over the driver's tables, as Spark DataFrames and as SQL CTEs.

``matches``: one row per order — the order is the match, the smallest and largest supplier
of its line items are the two participants (an order with one supplier is a match with one
participant), the order date is the match date, the order status is the result, summed
quantity is the match time.
``long``: ``matches`` one row per participant (P1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.reshape import wide_to_long


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# Order status -> result of the first participant; order priority -> method.
STATUS_RESULT = {"F": "Win", "O": "Loss", "P": "Draw"}
PRIORITY_METHOD = {"1-URGENT": "KO/TKO", "2-HIGH": "SUB", "3-MEDIUM": "U-DEC", "4-NOT SPECIFIED": "S-DEC", "5-LOW": "DQ"}


def _case(col: str, mapping: dict, default: str) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out.otherwise(default)


def matches(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    li = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("s1"), F.max("l_suppkey").alias("s2"), F.sum("l_quantity").alias("q"))
    )
    m = o.join(li, o["o_orderkey"] == li["l_orderkey"])
    r1 = _case("o_orderstatus", STATUS_RESULT, "Draw")
    r2 = _case("o_orderstatus", {"F": "Loss", "O": "Win"}, "Draw")
    return m.select(
        F.col("o_orderkey").alias("fight_url"),
        F.col("o_custkey").alias("event_url"),
        F.col("o_orderdate").alias("event_date"),
        F.col("s1").alias("fighter1_url"),
        F.when(F.col("s1") != F.col("s2"), F.col("s2")).alias("fighter2_url"),
        r1.alias("fighter1_result"),
        r2.alias("fighter2_result"),
        F.col("q").alias("time_seconds"),
        _case("o_orderpriority", PRIORITY_METHOD, "DQ").alias("method"),
    )


def long(spark: SparkSession, d: str) -> DataFrame:
    return wide_to_long(matches(spark, d)).where(F.col("fighter_url").isNotNull())


MATCHES_SQL = """
li AS (SELECT l_orderkey, min(l_suppkey) AS s1, max(l_suppkey) AS s2, sum(l_quantity) AS q
       FROM lineitem GROUP BY l_orderkey),
m AS (SELECT o_orderkey AS fight_url, o_custkey AS event_url, o_orderdate AS event_date,
             s1 AS fighter1_url, CASE WHEN s1 <> s2 THEN s2 END AS fighter2_url,
             CASE o_orderstatus WHEN 'F' THEN 'Win' WHEN 'O' THEN 'Loss' ELSE 'Draw' END AS fighter1_result,
             CASE o_orderstatus WHEN 'F' THEN 'Loss' WHEN 'O' THEN 'Win' ELSE 'Draw' END AS fighter2_result,
             q AS time_seconds,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'KO/TKO' WHEN '2-HIGH' THEN 'SUB'
                  WHEN '3-MEDIUM' THEN 'U-DEC' WHEN '4-NOT SPECIFIED' THEN 'S-DEC' ELSE 'DQ' END AS method
      FROM orders JOIN li ON o_orderkey = l_orderkey),
lg AS (SELECT fight_url, event_url, event_date, fighter1_url AS fighter_url, fighter1_result AS result,
              time_seconds, method, 'fighter1' AS role, fighter2_url AS opp_url FROM m
       UNION ALL
       SELECT fight_url, event_url, event_date, fighter2_url, fighter2_result, time_seconds, method,
              'fighter2', fighter1_url FROM m WHERE fighter2_url IS NOT NULL)
"""
