"""Connected components by alternating star operations (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).

Each round sends, for every node, its larger neighbours (large star) and then its smaller
ones (small star) to the smallest neighbour. Edges only ever get replaced, so the table
never grows, and a long chain halves every round. A round's minima are partial
aggregations; joins back on a hub node are equi-joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u")
    kept = low.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return kept.unionAll(moved.select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its
    component. Stops when a round leaves every edge pointing from a root."""
    stars = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while True:
        # done when every larger node has one edge and no root is itself below another node
        heads = stars.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("a"))
        many = heads.where("n > 1").select(F.col("b").alias("x")).limit(1)
        below = stars.select("a").join(heads.select(F.col("b").alias("a")), "a", "left_semi").select(F.col("a").alias("x")).limit(1)
        if not many.unionAll(below).take(1):
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        stars = stored(_small_star(_large_star(stars)))
