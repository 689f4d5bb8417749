"""Connected components by alternating large and small stars, as joins and aggregates.

Each round joins the edges with every node's smallest neighbour (``min`` aggregates map-side, so a hub
costs one row per task) and writes the new edges to the shared folder. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` → ``(id, component)`` for every non-minimal node of a component.

    A node that is the smallest of its component (or has no edge) is not listed: its component is
    itself. Self loops, repeated and reversed edges are fine; edges with a null end are ignored.
    """
    e = (edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(e, "cc")
    while not _stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        e = stored(small.select("u", "v").distinct(), "cc")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _stars(e: DataFrame) -> bool:
    """Every node points to exactly one smaller node, and no node is pointed to and points on."""
    ends = (e.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into"))
            .union(e.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into"))))
    bad = (ends.groupBy("x").agg(F.sum("out").alias("n"), F.max("into").alias("into"))
           .filter("n > 1 OR (n = 1 AND into = 1)"))
    return bad.isEmpty()
