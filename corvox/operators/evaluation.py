"""Evaluation: word errors, BLEU, similarity, best checkpoints, trends."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

#: Metrics for which less is better.
ERRORS = ("wer", "cer", "der")


def word_errors(reference: list[str], hypothesis: list[str]) -> tuple[int, int, int]:
    """(insertions, deletions, substitutions) of a least-cost alignment; of equal costs the one with the fewest insertions.

    A row of the table at a time, as one array: a cell holds the cost and, below it, the insertions, so the least cell is
    the one that is looked for. Insertions run along the row and are a running minimum.
    """
    one = 1 << 32  # a cost of 1; insertions count in the lower bits
    numbers: dict[str, int] = {}
    r, h = (np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in (reference, hypothesis))
    along = np.arange(len(h) + 1, dtype=np.int64) * (one + 1)
    row = along.copy()
    for w in r:
        new = row + one
        np.minimum(new[1:], row[:-1] + np.where(h == w, 0, one), out=new[1:])
        row = np.minimum.accumulate(new - along) + along
    cost, inserted = divmod(int(row[-1]), one)
    deleted = inserted + len(r) - len(h)
    return inserted, deleted, cost - inserted - deleted


def with_word_errors(rows: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """rows with n_words, ins, del and sub of each pair of texts; null texts count as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            split = lambda t: (t or "").split()
            found = [(len(split(r)), *word_errors(split(r), split(h))) for r, h in zip(pdf[reference], pdf[hypothesis])]
            yield pdf.assign(**{n: np.array([f[k] for f in found], np.int64) for k, n in enumerate(("n_words", "ins", "del", "sub"))})

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{names}, n_words long, ins long, del long, sub long")


def error_rates(rows: DataFrame, *keys: str) -> DataFrame:
    """Corpus-level rates of each group: sums over sums."""
    n = F.sum("n_words")
    part = lambda c: F.round(F.sum(c) / n, 8)
    return rows.groupBy(*keys).agg(n.alias("n_words"), F.round((F.sum("ins") + F.sum("del") + F.sum("sub")) / n, 8).alias("wer"), part("ins").alias("ins"), part("del").alias("del"), part("sub").alias("sub"))


def clipped_ngrams(rows: DataFrame, item: str, reference: str, hypothesis: str, n: int) -> DataFrame:
    """(matches, total) of n-grams over all rows: each counted as often as both texts hold it."""
    grams = lambda c, name: rows.select(item, F.explode(X.ngrams(X.words(F.lower(F.col(c))), n)).alias("g")).groupBy(item, "g").agg(F.count(F.lit(1)).alias(name))
    h, r = grams(hypothesis, "h"), grams(reference, "r")
    both = h.join(r, [item, "g"], "left")
    return both.agg(F.coalesce(F.sum(F.least(F.col("h"), F.coalesce("r", F.lit(0)))), F.lit(0)).alias("matches"), F.coalesce(F.sum("h"), F.lit(0)).alias("total"))


def bleu(rows: DataFrame, item: str, reference: str, hypothesis: str, order: int = 4) -> DataFrame:
    """(n, matches, total, precision) for n = 1..order and the corpus BLEU with its brevity penalty, in each row."""
    lengths = rows.agg(F.sum(F.size(X.words(F.col(reference)))).alias("r"), F.sum(F.size(X.words(F.col(hypothesis)))).alias("h"))
    parts = None
    for n in range(1, order + 1):
        one = clipped_ngrams(rows, item, reference, hypothesis, n).withColumn("n", F.lit(n))
        parts = one if parts is None else parts.unionByName(one)
    p = parts.withColumn("precision", F.when(F.col("total") > 0, F.col("matches") / F.col("total")).otherwise(0.0)).crossJoin(F.broadcast(lengths))
    every = Window.partitionBy()
    mean = F.when(F.min("precision").over(every) > 0, F.exp(F.avg(F.log("precision")).over(every))).otherwise(0.0)
    penalty = F.when(F.col("h") >= F.col("r"), 1.0).otherwise(F.exp(1 - F.col("r") / F.col("h")))
    return p.select("n", "matches", "total", "precision", (mean * penalty).alias("bleu"))


def better(metric: Column) -> Column:
    """1 where more is better, else -1."""
    return F.when(metric.isin(*ERRORS), -1).otherwise(1)


def best_step(results: DataFrame, *keys: str) -> DataFrame:
    """The best step of each dataset and metric, the earliest on ties."""
    best = F.min(F.struct((-better(F.col("metric")) * F.col("value")).alias("v"), F.col("step"), F.col("value")))
    return results.groupBy(*keys, "metric").agg(best.alias("__b")).select(*keys, "metric", F.col("__b.step").alias("step"), F.col("__b.value").alias("value"))


def trends(results: DataFrame, *keys: str) -> DataFrame:
    """First and last value of each dataset and metric, and whether it got better."""
    g = results.groupBy(*keys, "metric").agg(F.min_by("value", "step").alias("first"), F.max_by("value", "step").alias("last"), F.count(F.lit(1)).alias("n"))
    gain = (F.col("last") - F.col("first")) * better(F.col("metric"))
    return g.withColumn("trend", F.when(gain > 0, "better").when(gain < 0, "worse").otherwise("same"))


def percent_change(results: DataFrame) -> DataFrame:
    """(metric, step, change): mean over datasets at each step against the first step, in percent, positive if better."""
    mean = results.groupBy("metric", "step").agg(F.avg("value").alias("mean"))
    first = F.first("mean", ignorenulls=True).over(Window.partitionBy("metric").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return mean.withColumn("change", F.when(better(F.col("metric")) < 0, first - F.col("mean")).otherwise(F.col("mean") - first) / F.abs(first) * 100).select("metric", "step", "change")


def concatenated_steps(results: DataFrame) -> DataFrame:
    """results(experiment, step, ...) with `at`: steps of each experiment behind those of the ones before."""
    most = results.groupBy("experiment").agg(F.max("step").alias("most"))
    before = most.select("experiment", F.coalesce(F.sum("most").over(Window.orderBy("experiment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    return results.join(before, "experiment").withColumn("at", F.col("step") + F.col("__b")).drop("__b")


def missing_metrics(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """The (dataset, metric) pairs that have no value yet."""
    return wanted.join(done.where(F.col("value").isNotNull()), ["dataset", "metric"], "left_anti")
