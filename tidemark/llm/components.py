"""Connected components of a table of edges, by alternating large and small stars.

An edge is kept as (u, v) with u > v. A large star moves the lower end of each edge to the least neighbour of that end, so
one join of the edges with each vertex's least lower neighbour is enough; a small star gives all lower neighbours of a
vertex to the least of them. Both are a minimum aggregate and a join in which one side has a row for each vertex, so that
adaptive execution can split a hub's edges; nothing is gathered at a vertex or on the driver. The rounds grow with the
logarithm of the longest chain. Every round is a table in the shared folder, so a lost executor repeats at most one round;
a round's table is deleted when the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import discard, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """id and component (the smallest id reachable) of every vertex that has an edge to another.

    Loops, repeated and reversed edges and nulls do no harm; an empty table gives an empty result.
    """
    pairs = edges.select(F.greatest(src, dst).cast("long").alias("u"), F.least(src, dst).cast("long").alias("v")).filter("u > v AND v IS NOT NULL")
    now = written(pairs.distinct(), "edges")
    state = None
    while True:
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == state or not seen[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = seen
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        large = now.join(least.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").unionByName(low.withColumnRenamed("m", "v"))
        old, now = now, written(small.distinct(), "edges")
        discard(old)
