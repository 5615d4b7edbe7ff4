"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.store import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``edges``
    (columns ``a`` and ``b``, long).

    Every id points at the smallest id it knows; each round hooks the pointers of
    both ends of every edge to the smaller one and then replaces the edges by
    edges between pointers. Rounds grow with the logarithm of the longest path;
    each is one group-by (combined before the shuffle), a distinct and joins on ids
    that may be split when skewed; its pointers and edges are written to the shared
    checkpoint folder.
    """
    live = edges.select(F.least("a", "b").cast("long").alias("a"),
                        F.greatest("a", "b").cast("long").alias("b")).where("a is not null and b is not null")
    ids = live.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    named = cut(ids.withColumn("component", F.col("id")))
    live = cut(live.where("a < b").distinct())
    while not live.isEmpty():
        # The smallest neighbour of each pointer that still has edges.
        low = (live.select(F.col("b").alias("x"), F.col("a").alias("y"))
               .groupBy("x").agg(F.min("y").alias("low")))
        # Pointers hook to their smallest neighbour; follow one more step.
        step = low.alias("p").join(low.alias("q"), F.col("p.low") == F.col("q.x"), "left").select(
            F.col("p.x").alias("x"), F.coalesce("q.low", "p.low").alias("to"))
        step = cut(step)
        # Only planned here: the steps lie in the shared folder, one join each.
        own = step.select(F.col("x").alias("own"), F.col("to").alias("up"))
        named = named.join(own, F.col("component") == F.col("own"), "left").select(
            "id", F.coalesce("up", "component").alias("component"))
        s1, s2 = (step.select(F.col("x").alias(f"x{k}"), F.col("to").alias(f"to{k}")) for k in (1, 2))
        moved = (live.join(s1, F.col("a") == F.col("x1"), "left").join(s2, F.col("b") == F.col("x2"), "left")
                 .select(F.coalesce("to1", "a").alias("a"), F.coalesce("to2", "b").alias("b")))
        live = cut(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a < b").distinct())
    return named
