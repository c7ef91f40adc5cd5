"""Choosing rows and routing them: filters on files, alignments and answers, splits, labels, overrides, sums of states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inside_file(offset: Column, duration: Column, file_duration: Column, slack: float = 0.5) -> Column:
    """Whether a segment ends in its file, but for some slack; false where the file's duration isn't known."""
    return F.coalesce(F.coalesce(offset, F.lit(0.0)) + duration <= file_duration + slack, F.lit(False))


def existing(rows: DataFrame, listing: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(the rows whose file is in a listing, those whose file isn't): by equality, no file system is asked row by row."""
    known = listing.select(path).distinct()
    return rows.join(known, path, "left_semi"), rows.join(known, path, "left_anti")


def first_existing(rows: DataFrame, listing: DataFrame, path: str, bases: list[str], out: str = "resolved") -> DataFrame:
    """rows with `out`: the path under the first of the bases, in their order, where the listing has it; null if none."""
    tried = F.array(*(F.struct(F.lit(k).alias("k"), F.concat(F.lit(b), F.col(path)).alias("p")) for k, b in enumerate(bases)))
    found = rows.select(path).distinct().select(path, F.explode(tried).alias("t")).join(listing.select(F.col(path).alias("__p")).distinct(), F.col("t.p") == F.col("__p"))
    best = found.groupBy(path).agg(F.min("t")["p"].alias(out))
    return rows.join(best, path, "left")


def aligned_enough(last_end: Column, duration: Column, sentences: Column, least: float = 0.9, count: int = 3) -> Column:
    """Whether an alignment covers enough of the audio and holds enough sentences."""
    return F.coalesce((last_end / duration >= least) & (sentences >= count), F.lit(False))


def usable_answer(finish: Column, text: Column) -> Column:
    """Whether a generated answer ended by itself and holds no ideograph."""
    return F.coalesce((finish == "stop") & ~text.rlike("[\\u4e00-\\u9fff]"), F.lit(False))


def routed_split(current: Column, subset: Column, path: Column, subsets: list[str]) -> Column:
    """The split of a row; in some subsets that of its path: test is test, dev is train unless the row is dev already."""
    own = F.regexp_extract(path, r"(?:^|/)(dev|test)(?:/|$)", 1)
    moved = F.when(own == "test", "test").when((own == "dev") & (current != "dev"), "train").otherwise(current)
    return F.when(subset.isin(*subsets), moved).otherwise(current)


def collected_by_key(sources: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """(key, found): a map from the name of each source that has the key to its (smallest) value."""
    parts = [df.groupBy(key).agg(F.min(value).alias("__v")).withColumn("__s", F.lit(name)) for name, df in sources.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    entries = F.array_sort(F.collect_list(F.struct("__s", "__v")))
    return whole.groupBy(key).agg(F.map_from_entries(entries).alias("found"))


def with_default(rows: DataFrame, changes: DataFrame, key: str, text: str) -> DataFrame:
    """rows with the text of `changes`(key, text) where it has the key, else their own."""
    new = changes.groupBy(key).agg(F.min(text).alias("__new"))
    return rows.join(new, key, "left").withColumn(text, F.coalesce("__new", text)).drop("__new")


def overridden(rows: DataFrame, overrides: DataFrame, key: str, columns: list[str], defaults: dict[str, object]) -> DataFrame:
    """rows with options: those of their key's override where it has them, else the defaults."""
    own = overrides.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    return rows.join(own, key, "left").select(*rows.columns, *(F.coalesce(F.col(f"__{c}"), F.lit(defaults[c])).alias(c) for c in columns))


def summed_states(states: DataFrame, item: str, epochs: str, names: list[str]) -> DataFrame:
    """(item, sums): counters of a map from epochs to counters, added up over the epochs; what is missing counts as 0."""
    total = lambda n: F.aggregate(F.map_values(epochs), F.lit(0).cast("long"), lambda acc, s: acc + F.coalesce(s[n], F.lit(0).cast("long")))
    return states.select(item, *(F.coalesce(total(n), F.lit(0)).alias(n) for n in names))


def reused_statistics(members: DataFrame, known: DataFrame, split: str, manifest: str, values: list[str]) -> DataFrame:
    """(split, sums, complete): sums of known statistics over each split's manifests; null unless all of them are known."""
    both = members.join(known.select(manifest, *values, F.lit(1).alias("__known")), manifest, "left")
    complete = F.count(F.lit(1)) == F.count("__known")
    return both.groupBy(split).agg(*(F.when(complete, F.sum(v)).alias(v) for v in values), complete.alias("complete"))


def language_order(key: Column, ranks: dict[str, int], unknown: int = 99) -> Column:
    """The sort key of a language or pair (fr, en→fr, en-fr): lower rank, higher rank, rank of the first."""
    table = F.create_map(*(x for k, v in ranks.items() for x in (F.lit(k), F.lit(v))))
    parts = F.filter(F.split(F.replace(F.lower(F.trim(key)), F.lit("→"), F.lit("-")), "-"), lambda p: p != "")
    rank = lambda i: F.coalesce(F.element_at(table, F.get(parts, F.lit(i))), F.lit(unknown))
    second = F.when(F.size(parts) > 1, rank(1)).otherwise(rank(0))
    return F.struct(F.least(rank(0), second).alias("low"), F.greatest(rank(0), second).alias("high"), rank(0).alias("first"))


def joined_cues(texts: Column) -> Column:
    """Cues as one text: with a period where one ends without a mark and the next begins with a capital."""
    plain = F.filter(F.transform(texts, lambda t: F.trim(F.regexp_replace(F.coalesce(t, F.lit("")), r"\s+", " "))), lambda t: t != "")

    def add(acc: Column, t: Column) -> Column:
        joint = F.when(acc == "", "").when(~acc.rlike(r"[.,;:!?…]$") & t.rlike(r"^\p{Lu}"), ". ").otherwise(" ")
        return F.concat(acc, joint, t)

    return F.aggregate(plain, F.lit(""), add)


def representative(words: Column, first: Column, last: Column) -> Column:
    """One word of a span of timed words: the first with four letters or digits, else the first with any; null if none."""
    own = F.filter(F.slice(words, first + 1, F.greatest(last - first + 1, F.lit(0))), lambda w: w["word"].rlike(r"[\p{L}\p{N}]") & (w["start"] >= 0))
    long = F.filter(own, lambda w: F.length(F.regexp_replace(w["word"], r"[^\p{L}\p{N}]", "")) >= 4)
    chosen = F.get(F.when(F.size(long) > 0, long).otherwise(own), F.lit(0))
    bare = F.get(F.split(F.regexp_replace(chosen["word"], r"^[\s\"'.,;:!?()\[\]]+|[\s\"'.,;:!?()\[\]]+$", ""), r"\s+"), F.lit(0))
    return F.when(bare != "", F.struct(bare.alias("word"), chosen["start"].alias("start"), F.coalesce(chosen["end"], chosen["start"]).alias("end")))
