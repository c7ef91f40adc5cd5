"""Corpus statistics, mixture trees and weights, caps, reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def statistics(samples: DataFrame, keys: list[str], duration: str = "duration", words: str = "words", speaker: str = "speaker") -> DataFrame:
    """Counts and duration and word statistics of each group, in one grouping; std is the population's, the median interpolates."""
    d, w = F.col(duration), F.col(words)
    return samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.sum(d).alias("total_duration"),
        F.min(d).alias("min_duration"),
        F.max(d).alias("max_duration"),
        F.avg(d).alias("avg_duration"),
        F.median(d).alias("median_duration"),
        F.stddev_pop(d).alias("std_duration"),
        F.sum(w).alias("total_words"),
        F.avg(w).alias("avg_words"),
        F.countDistinct(speaker).alias("num_speakers"),
    )


def three_levels(groups: DataFrame, size: str, temperature: float = 2.0, least: float | None = None) -> DataFrame:
    """groups(task, lang, dataset, size) with dataset_w, lang_w, task_w and p = their product, by size^(1/temperature).

    With `least`, p is clipped from below and normalised again.
    """
    score = F.pow(F.col(size), 1.0 / temperature)
    w = groups.withColumn("score", score)
    total = lambda *keys: F.sum("score").over(Window.partitionBy(*keys))
    w = w.withColumn("dataset_w", F.col("score") / total("task", "lang")).withColumn("lang_w", total("task", "lang") / total("task")).withColumn("task_w", total("task") / total())
    w = w.withColumn("p", F.col("dataset_w") * F.col("lang_w") * F.col("task_w"))
    if least is not None:
        w = w.withColumn("p", F.greatest(F.col("p"), F.lit(least)))
        w = w.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy()))
    return w.drop("score")


def blended(weights: DataFrame, shares: DataFrame, mode: str) -> DataFrame:
    """three_levels' weights with shares(task, lang, share) of a hand-written mixture: hard replaces, soft multiplies.

    Task shares are normalised over all, language shares inside their task; groups without a share keep their own.
    """
    by_task = shares.groupBy("task").agg(F.sum("share").alias("task_share"), F.sum("share").alias("__of_task"))
    out = weights.join(shares, ["task", "lang"], "left").join(by_task, "task", "left")
    out = out.withColumn("task_share", F.col("task_share") / by_task.agg(F.sum("task_share")).first()[0])
    out = out.withColumn("lang_share", F.col("share") / F.col("__of_task"))
    inside = lambda c, *keys: F.col(c) / F.sum(F.col(c) * F.col("__first")).over(Window.partitionBy(*keys))
    if mode == "hard":
        out = out.withColumn("task_w", F.coalesce("task_share", "task_w")).withColumn("lang_w", F.coalesce("lang_share", "lang_w"))
    elif mode == "soft":
        out = out.withColumn("task_w", F.col("task_w") * F.coalesce("task_share", F.lit(1.0))).withColumn("lang_w", F.col("lang_w") * F.coalesce("lang_share", F.lit(1.0)))
    else:
        raise ValueError(f"unknown blend {mode}")
    one = lambda *keys: (F.row_number().over(Window.partitionBy(*keys).orderBy("dataset")) == 1).cast("int")
    out = out.withColumn("__first", (F.row_number().over(Window.partitionBy("task").orderBy("lang", "dataset")) == 1).cast("int")).withColumn("task_w", inside("task_w"))
    out = out.withColumn("__first", one("task", "lang")).withColumn("lang_w", inside("lang_w", "task"))
    return out.withColumn("p", F.col("dataset_w") * F.col("lang_w") * F.col("task_w")).drop("__first", "__of_task", "share", "task_share", "lang_share")


def passes(weights: DataFrame, size: str, p: str = "p") -> DataFrame:
    """Expected passes over each dataset when as many samples are drawn as there are, and their flags."""
    n = F.sum(size).over(Window.partitionBy())
    seen = F.bround(F.col(p) * n / F.col(size), 2)
    flag = F.when(seen > 10, "critical_over").when(seen > 5, "over").when(seen < 0.1, "critical_under").when(seen < 0.25, "under").otherwise("ok")
    return weights.withColumn("passes", seen).withColumn("flag", flag)


def level_filled(rows: DataFrame, keys: list[str], share: str, size: str, limit: Column, out: str) -> DataFrame:
    """rows with `out`: shares of a group such that none is above limit times its size, the others keeping their ratios.

    The shares of a group sum to 1, and so do the new ones. In the order of share by size, a first part of the rows is
    held at the limit; what they leave is dealt to the others by their shares. Whether a row is held follows from the
    sums before it, so nothing is iterated. Where all rows would be held, `out` is null.
    """
    own = Window.partitionBy(*keys)
    order = own.orderBy(F.desc("__ratio"), size, share)
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.withColumn("__limit", limit).withColumn("__ratio", F.col(share) / F.col(size))
    level = (1 - F.col("__limit") * F.coalesce(F.sum(size).over(before), F.lit(0))) / (1 - F.coalesce(F.sum(share).over(before), F.lit(0.0)))
    cut = cut.withColumn("__over", (level * F.col("__ratio") > F.col("__limit") * (1 + 1e-12)).cast("int"))
    cut = cut.withColumn("__held", F.min("__over").over(upto))
    held = lambda c: F.sum(F.when(F.col("__held") == 1, F.col(c)).otherwise(0)).over(own)
    left = (1 - F.col("__limit") * held(size)) / (1 - held(share))
    new = F.when(F.min("__held").over(own) == 1, F.lit(None)).when(F.col("__held") == 1, F.col("__limit") * F.col(size)).otherwise(left * F.col(share))
    return cut.withColumn(out, new).drop("__limit", "__ratio", "__over", "__held")


def flat_capped(weights: DataFrame, cap: float) -> DataFrame:
    """weights(task, lang, dataset, size, dataset_w, lang_w, task_w) with dataset_w and p so that no dataset is passed more
    than cap times while all are passed once on average; the rest of its (task, lang) shares what is left. Where all are
    over, all get the same."""
    total = F.sum("size").over(Window.partitionBy())
    limit = F.lit(cap) / (total * F.col("task_w") * F.col("lang_w"))
    filled = level_filled(weights.withColumn("__cap", limit), ["task", "lang"], "dataset_w", "size", F.col("__cap"), "__w").drop("__cap")
    equal = 1 / F.count("*").over(Window.partitionBy("task", "lang"))
    return filled.withColumn("dataset_w", F.coalesce("__w", equal)).drop("__w").withColumn("p", F.col("dataset_w") * F.col("lang_w") * F.col("task_w"))


def leaves_capped(leaves: DataFrame, cap: float) -> DataFrame:
    """leaves(size, p) with p so that none is passed more than cap times, cap 1 at least; the excess goes to the others by p."""
    total = F.sum("size").over(Window.partitionBy())
    filled = level_filled(leaves.withColumn("__cap", F.lit(cap) / total), [], "p", "size", F.col("__cap"), "__p").drop("__cap")
    return filled.withColumn("p", F.coalesce("__p", "p")).drop("__p")


def flattened_tree(tree: Iterable[dict], inherited: dict | None = None, parent: int = -1, depth: int = 0, out: list[dict] | None = None) -> list[dict]:
    """Nodes (node_id, parent_id, depth, kind, weight, tags, manifest) of a mixture tree; tags go down to the leaves.

    A node without a weight has weight null; `explicit_or_one` tells how readers take it.
    """
    out = [] if out is None else out
    for node in tree:
        tags = {**(inherited or {}), **(node.get("tags") or {})}
        me = len(out)
        kind = "group" if node.get("type") == "group" else "leaf"
        out.append({"node_id": me, "parent_id": parent, "depth": depth, "kind": kind, "weight": node.get("weight"), "manifest": node.get("manifest_filepath")} | {k: tags.get(k) for k in ("task", "sub_task", "lang", "source_lang", "target_lang")})
        if kind == "group":
            flattened_tree(node.get("input_cfg") or [], tags, me, depth + 1, out)
    return out


def tree_frame(spark: SparkSession, tree: Iterable[dict]) -> DataFrame:
    """flattened_tree as a table."""
    names = "node_id int, parent_id int, depth int, kind string, weight double, manifest string, task string, sub_task string, lang string, source_lang string, target_lang string"
    rows = [tuple(r[n.split()[0]] if r[n.split()[0]] is None or n.split()[1] != "double" else float(r[n.split()[0]]) for n in names.split(", ")) for r in flattened_tree(tree)]
    return spark.createDataFrame(rows, names)


def sibling_normalised(nodes: DataFrame) -> DataFrame:
    """Leaves with `share`: weights divided by those of the siblings at each level, multiplied down; 0 or none counts as 1."""
    own = F.coalesce(F.when(F.col("weight") != 0, F.col("weight")), F.lit(1.0))
    level = nodes.withColumn("w", own / F.sum(own).over(Window.partitionBy("parent_id")))
    return _down(level)


def raw_products(nodes: DataFrame) -> DataFrame:
    """Leaves with `share`: products of raw weights along the path, normalised once over all leaves."""
    own = F.coalesce(F.when(F.col("weight") != 0, F.col("weight")), F.lit(1.0))
    leaves = _down(nodes.withColumn("w", own))
    return leaves.withColumn("share", F.col("share") / F.sum("share").over(Window.partitionBy()))


def _down(nodes: DataFrame) -> DataFrame:
    """Products of w from the top to each leaf: as many joins as the tree is deep, which the configuration bounds."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    reached = nodes.where("depth = 0").select(F.col("node_id").alias("at"), F.col("w").alias("share"))
    done = [reached]
    for k in range(1, deepest + 1):
        reached = nodes.where(F.col("depth") == k).join(reached, F.col("parent_id") == F.col("at")).select(F.col("node_id").alias("at"), (F.col("w") * F.col("share")).alias("share"))
        done.append(reached)
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    return nodes.where("kind = 'leaf'").drop("w").join(every, F.col("node_id") == F.col("at")).drop("at")


def tree_leaf_shares(nodes: list[dict], sizes: dict[int, float], temperature: float = 2.0) -> dict[int, float]:
    """Shares of the leaves: an explicit weight is a fraction of the parent; siblings without one share the rest by score.

    A leaf scores size^(1/temperature), a group 1; where all siblings are explicit they are normalised.
    """
    children: dict[int, list[dict]] = {}
    for n in nodes:
        children.setdefault(n["parent_id"], []).append(n)
    out: dict[int, float] = {}

    def walk(parent: int, share: float) -> None:
        own = children.get(parent, [])
        fixed = {n["node_id"]: float(n["weight"]) for n in own if n["weight"] is not None}
        free = [n for n in own if n["weight"] is None]
        said = sum(fixed.values())
        score = {n["node_id"]: 1.0 if n["kind"] == "group" else sizes[n["node_id"]] ** (1 / temperature) for n in free}
        for n in own:
            i = n["node_id"]
            if i in fixed:
                part = fixed[i] / said if not free and said else fixed[i]
            else:
                part = max(0.0, 1.0 - said) * score[i] / sum(score.values())
            if n["kind"] == "group":
                walk(i, share * part)
            else:
                out[i] = share * part

    walk(-1, 1.0)
    return out


def target_and_actual(datasets: DataFrame, streams: int = 1) -> DataFrame:
    """datasets(p, size, seen, avg_duration) with actual share, ratio, passes, hours and the z-score of a binomial draw."""
    total = F.sum("seen").over(Window.partitionBy())
    actual = F.col("seen") / total
    expected = F.col("p") * total
    return (
        datasets.withColumn("actual", actual)
        .withColumn("ratio", actual / F.col("p"))
        .withColumn("passes", F.col("seen") / F.col("size"))
        .withColumn("hours", F.col("seen") * F.col("avg_duration") / 3600)
        .withColumn("z", (F.col("seen") - expected) / F.sqrt(expected * (1 - F.col("p")) * streams))
    )


def total_variation(rows: DataFrame) -> DataFrame:
    """Half the summed distance of actual and target shares."""
    return rows.agg((F.sum(F.abs(F.col("actual") - F.col("p"))) / 2).alias("total_variation"))


def seen_samples(state: DataFrame) -> DataFrame:
    """state(size, num_shards, shard_id, epoch, position) with `seen`: whole epochs of the shard and the place in it."""
    length = F.ceil((F.col("size") - F.col("shard_id")) / F.col("num_shards"))
    return state.withColumn("seen", F.col("epoch") * length + F.col("position"))


def suggested_steps(samples: Column, batch: int, accumulation: int, epochs: int) -> Column:
    """Steps of the optimiser for so many epochs."""
    return F.ceil(samples / (batch * accumulation)) * epochs
