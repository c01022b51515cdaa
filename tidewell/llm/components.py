"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.storage import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node that has an edge to another, the least node it can reach.

    Alternating large-star and small-star steps: each node passes the least of its
    neighbours on to them until all edges point at roots. A step is an aggregate and a join;
    neighbours are never gathered in one place. Loops, repeated edges and nulls add nothing;
    no edges give no rows.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = stored(
        edges.where(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct(), "edges"
    )
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.select("u", F.col("m").alias("v")).union(moved).distinct(), "edges")
        sums = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(sums) == mark:
            break
        mark = tuple(sums)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
