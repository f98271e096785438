"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and one equi-join, so a node with very many edges is summed
partially before the shuffle and its join partition can be split by adaptive execution; edges
shrink towards stars in O(log^2 n) rounds. Each round is a written table: a lost executor costs no
more than its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node that ``edges`` (columns u, v of one type) touch.

    Loops and repeated edges do no harm; edges with a null end are passed over; without edges the
    result is empty.
    """
    edges = written(edges.filter("u is not null and v is not null").select("u", "v"), "components")
    alone = edges.filter("u = v").select("u")
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)).distinct(), "components")
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h"), F.sum(F.xxhash64("v", "u") % 998_244_353).alias("g")).first()
        if found == state:
            break
        state = found
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.union(roots).union(alone.join(edges, alone["u"] == edges["u"], "left_anti").select(F.col("u").alias("node"), F.col("u").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
