"""Similar words: the matching-blocks ratio, all pairs above one, and the closest spelling."""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to this length, words are looked up by their letters, longer ones by their pairs of letters.
SHORT = 6


def block_ratio(a: str, b: str) -> float:
    """Twice the letters in matching blocks over all letters: the longest common block counts, then those on its sides."""
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


def with_ratio(pairs: DataFrame, a: str, b: str, out: str = "ratio") -> DataFrame:
    """pairs with the block ratio of two columns, over Arrow batches; null where one of them is null."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields if f.name != out), f"`{out}` double"])
    names = [c for c in pairs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (a, b))
            found = [None if p is None or q is None else block_ratio(p, q) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*names, out])

    return pairs.select(*names).mapInArrow(run, schema)


def _grams(word: Column, n: int) -> Column:
    """The runs of n letters of a word, the k-th of equal ones marked k: sets that count as multisets do."""
    raw = F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, n))
    return F.transform(raw, lambda g, i: F.concat(g, F.size(F.filter(F.slice(raw, F.lit(1), i), lambda o: o == g)).cast("string")))


def _needed(length: Column, n: int, least: float) -> Column:
    """How many runs of n letters a word has in common, at least, with any word of a ratio of `least`.

    A partner has at least least / (2 - least) of its letters, so M, the letters in blocks, is at least that share of
    them. Common letters are M. Two neighbouring blocks have a letter outside between them, in one of the words; so
    there are at most 1 more of them than letters outside, and each loses one pair of letters.
    """
    partner = length * least / (2 - least)
    both = length + partner
    return F.ceil(both * least / 2 - 1e-9) if n == 1 else F.ceil(both * (1.5 * least - 1) - 1 - 1e-9)


def _postings(words: DataFrame, frequency: DataFrame, n: int, least: float) -> DataFrame:
    """(w, gram) for the rarest runs of each word, one more than it may miss: two similar words share one of these."""
    grams = words.select("w", F.explode(_grams(F.col("w"), n)).alias("gram"))
    rare = Window.partitionBy("w").orderBy("n", "gram")
    ranked = grams.join(frequency, "gram").withColumn("k", F.row_number().over(rare))
    return ranked.where(F.col("k") <= F.length("w") - n + 2 - F.greatest(_needed(F.length("w"), n, least), F.lit(1))).select("w", "gram")


def similar_words(left: DataFrame, right: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, ratio): all pairs of different rows' words, of left(w) and right(w), with a block ratio of at least `least`.

    No pair is lost: words of more than SHORT letters meet by their rarest pairs of letters, pairs with a shorter one by
    their rarest letters, as many as the ratio leaves them to miss. Pairs that meet are compared by length, by common
    letters, and then exactly. `least` must be 0.75 at least. Equal words are pairs of ratio 1; null and empty words
    take no part; repeated words count once.
    """
    if not 0.75 <= least <= 1:
        raise ValueError("the least ratio must be between 0.75 and 1")
    longest_partner = math.floor(SHORT * (2 - least) / least + 1e-9)
    own, other = (df.select("w").where("w <> ''").distinct() for df in (left, right))
    met = None
    for n, part in ((1, F.length("w") <= longest_partner), (2, F.length("w") > SHORT)):
        a, b = own.where(part), other.where(part)
        frequency = a.union(b).distinct().select(F.explode(_grams(F.col("w"), n)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        pairs = _postings(a, frequency, n, least).withColumnRenamed("w", "a").join(_postings(b, frequency, n, least).withColumnRenamed("w", "b"), "gram").select("a", "b")
        met = pairs if met is None else met.union(pairs)
    la, lb = F.length("a"), F.length("b")
    met = met.where(F.least(la, lb) * 2 >= least * (la + lb) - 1e-9).distinct()
    common = F.size(F.array_intersect(_grams(F.col("a"), 1), _grams(F.col("b"), 1)))
    return with_ratio(met.where(common * 2 >= least * (la + lb) - 1e-9), "a", "b").where(F.col("ratio") >= least)


def closest(words: DataFrame, spellings: DataFrame, least: float = 0.75) -> DataFrame:
    """(w, spelling, ratio): for each word of words(w) the spelling of spellings(w) that is most like it.

    The word itself comes first, then one that differs in case alone, then the highest block ratio, then the first in
    order; a word that none is like by `least`, and which differs from all in more than case, has no row.
    """
    pairs = similar_words(words, spellings, least).select(F.col("a").alias("w"), F.col("b").alias("spelling"), "ratio")
    cased = words.select(F.col("w"), F.lower("w").alias("low")).distinct().join(spellings.select(F.col("w").alias("spelling"), F.lower("w").alias("low")).distinct(), "low")
    both = pairs.unionByName(with_ratio(cased.select("w", "spelling"), "w", "spelling")).distinct()
    rank = F.struct((F.col("w") != F.col("spelling")).alias("other"), (F.lower("w") != F.lower("spelling")).alias("unlike"), (-F.col("ratio")).alias("off"), "spelling")
    best = both.groupBy("w").agg(F.min(rank).alias("b"))
    return best.select("w", "b.spelling", (-F.col("b.off")).alias("ratio"))


def confusable(distractors: DataFrame, present: DataFrame, least: float = 0.75) -> DataFrame:
    """distractors(w) with `score`, the highest block ratio with a word of present(w), in any case; null below `least`."""
    low = lambda df: df.select(F.lower("w").alias("w"))
    score = similar_words(low(distractors), low(present), least).groupBy(F.col("a").alias("__low")).agg(F.max("ratio").alias("score"))
    return distractors.join(score, F.lower("w") == F.col("__low"), "left").drop("__low")
