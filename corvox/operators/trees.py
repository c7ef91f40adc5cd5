"""Mixture trees as tables: shares of leaves, paths, and states of data loaders walked beside them; of any depth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch


def down_the_tree(nodes: DataFrame, value: Column, combine: Callable[[Column, Column], Column]) -> DataFrame:
    """(node, value): combine() of a value from the root down to each node of nodes(node, parent, ...); roots have no parent.

    Pointer doubling: after round k each node knows the combined value of its 2**k nearest, itself included, and the
    node above these; so there are as many rounds as the depth has binary digits. Rounds are written to the shared
    folder. A circle of parents is an error.
    """
    spark = nodes.sparkSession
    now = nodes.select("node", F.col("parent").alias("up"), value.alias("value"))
    for k in range(64):
        path = scratch(spark, f"tree{k}")
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        if now.where("up is not null").isEmpty():
            return now.select("node", "value")
        if k > 40:
            break
        above = now.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("value").alias("above"))
        joined = now.join(above, "up", "left")
        now = joined.select("node", F.col("next").alias("up"), F.when(F.col("above").isNotNull(), combine(F.col("above"), F.col("value"))).otherwise(F.col("value")).alias("value"))
    raise ValueError("the parents form a circle")


def leaf_shares(nodes: DataFrame, temperature: float = 2.0) -> DataFrame:
    """(node, share) of the leaves of nodes(node, parent, kind, weight, size), kind "group" or "leaf".

    An explicit weight is a fraction of the parent's share; siblings without one share the rest, a leaf by
    size^(1/temperature), a group as 1. Where all siblings are explicit they are normalised to 1.
    """
    own = Window.partitionBy("parent")
    score = F.when(F.col("weight").isNotNull(), 0.0).when(F.col("kind") == "group", 1.0).otherwise(F.when(F.col("size") > 0, F.pow("size", F.lit(1 / temperature))).otherwise(0.0))
    scored = nodes.withColumn("__score", score)
    explicit, free = F.sum(F.coalesce("weight", F.lit(0.0))).over(own), F.sum("__score").over(own)
    rest = F.greatest(F.lit(0.0), 1 - explicit)
    part = F.when(F.col("weight").isNull(), F.when(free > 0, rest * F.col("__score") / free).otherwise(0.0)).when((free > 0) | (explicit == 0), F.col("weight")).otherwise(F.col("weight") / explicit)
    shared = scored.withColumn("__part", part)
    told = down_the_tree(shared, F.col("__part"), lambda above, v: above * v).withColumnRenamed("value", "share")
    return told.join(nodes.where("kind = 'leaf'").select("node"), "node")


def branch_paths(nodes: DataFrame, counts: Column) -> DataFrame:
    """(node, path): the ordinals, from the root down, of the nodes of nodes(node, parent, ordinal) for which `counts`."""
    step = F.when(counts, F.concat(F.lit("/"), F.col("ordinal").cast("string"))).otherwise("")
    return down_the_tree(nodes, step, lambda above, v: F.concat(above, v)).withColumnRenamed("value", "path")


def states_of_leaves(nodes: DataFrame, states: DataFrame) -> DataFrame:
    """(node, position, epoch, shard_id, num_shards, seen): the state of each leaf of a mixture tree.

    nodes(node, parent, ordinal, kind, size); states(node, parent, ordinal, kind, position, epoch, shard_id, num_shards)
    hold the tree of a loader: a mux for each group of several, wrappers (filters, maps, repeats) around anything, and a
    leaf iterator for each leaf. Groups of one have no mux, and wrappers no counterpart, so both trees are walked by
    what they share: the places among several siblings. seen: whole epochs of the shard, and the place in it. A tree
    that doesn't fit the other is an error.
    """
    own = Window.partitionBy("parent")
    counted = nodes.withColumn("__n", F.count("*").over(own))
    mine = branch_paths(counted, F.col("__n") > 1).join(nodes.where("kind = 'leaf'").select("node", "size"), "node")
    above = states.select(F.col("node").alias("parent"), (F.col("kind") == "mux").alias("__mux"))
    told = states.join(above, "parent", "left")
    theirs = branch_paths(told, F.coalesce(F.col("__mux"), F.lit(False))).join(states.where("kind = 'leaf'").select("node", "position", "epoch", "shard_id", "num_shards"), "node").drop("node")
    both = mine.join(theirs, "path", "full")
    fits = F.col("size").isNotNull() & F.col("position").isNotNull()
    checked = F.when(fits, F.col("position")).otherwise(F.raise_error(F.concat(F.lit("the trees differ at "), F.col("path"))).cast("long"))
    length = F.ceil(F.greatest(F.col("size") - F.col("shard_id"), F.lit(0)) / F.col("num_shards"))
    return both.select("node", checked.alias("position"), "epoch", "shard_id", "num_shards", (F.col("epoch") * length + F.col("position")).alias("seen"))
