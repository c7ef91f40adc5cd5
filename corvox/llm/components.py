"""Connected components over an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): for every id in edges(a long, b long), the smallest id that can be reached from it.

    Each round hooks every node to its smallest neighbour, jumps once along those links, and renames the edges by the
    result; what a node was renamed to stays joined to what that became, so no connection is lost. At least half of
    the nodes that have edges go in each round, so the rounds grow with the logarithm of the nodes. Every step is a
    join or a pre-aggregated minimum, and is written to the shared folder; hubs are split by adaptive joins. Edges may
    be repeated, in either order, and may join a node to itself. An empty table gives no rows; edges with a null end
    are left out.
    """
    pairs = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(F.col("a").cast("long"), F.col("b").cast("long"))
    spark = edges.sparkSession
    pairs = written(pairs, "edges")
    assigned = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")), "hooked")
        over = hooked.select(F.col("a").alias("up"), F.col("up").alias("upper"))
        jumped = written(hooked.join(over, "up").select(F.col("a").alias("id"), "up", "upper"), "jumped")
        if assigned is None:
            assigned = written(jumped.select("id", F.col("upper").alias("component")), "assigned")
        else:
            now = jumped.select(F.col("id").alias("component"), "upper")
            before = assigned
            assigned = written(assigned.join(now, "component", "left").select("id", F.coalesce("upper", "component").alias("component")), "assigned")
            discard(spark, before)
        ends = jumped.select(F.col("id").alias("a"), F.col("upper").alias("a2"))
        other = jumped.select(F.col("id").alias("b"), F.col("upper").alias("b2"))
        renamed = pairs.join(ends, "a").join(other, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        higher = ends.select(F.col("a").alias("a2"), F.col("a2").alias("b"))  # where each renamed-to node hooks in turn
        chained = jumped.select(F.col("upper").alias("a2")).distinct().join(higher, "a2").select(F.col("a2").alias("a"), "b")
        old, pairs = pairs, written(renamed.union(chained).where("a <> b").distinct(), "pairs")
        for done in (hooked, jumped, old):
            discard(spark, done)
        if pairs.isEmpty():
            return assigned
