"""Conversation synthesis: pools of tasks, their choice, assembly shapes, walks over clips, respellings."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_u, truncated_geometric, weighted_pick
from ..functions.text import capitalised, uncapitalised
from .ranking import buckets_for, numbered

CONVERSATION = "array<struct<from:string,type:string,value:string>>"


def disjoint_chunks(items: DataFrame, group: str, order: Column, seed: str, lengths: list[tuple[int, float]]) -> DataFrame:
    """items with `chunk` and `place`: each group's items, in order, cut into runs whose lengths are drawn by weight.

    A run's length is drawn from its group and number, so any partitioning cuts alike. The groups are conversations of
    one clip, so a group is small.
    """
    most = max(n for n, _ in lengths)
    numbered = items.withColumn("__at", F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1)
    sizes = items.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    ks = sizes.select(group, "__n", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("chunk"))
    drawn = ks.withColumn("__len", weighted_pick(lengths, hash_u(seed, group, "chunk")))
    stop = F.sum("__len").over(Window.partitionBy(group).orderBy("chunk"))
    cuts = drawn.withColumn("__stop", stop).withColumn("__start", stop - F.col("__len")).where("__start < __n")
    keys = cuts.select(group, "chunk", "__start", F.explode(F.sequence(F.col("__start"), F.col("__stop") - 1)).alias("__at"))
    assert most >= 1
    return numbered.join(keys, [group, "__at"]).withColumn("place", (F.col("__at") - F.col("__start")).cast("int")).drop("__at", "__start")


def _turns(*pairs: tuple[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(who).alias("from"), F.lit("text").alias("type"), v.alias("value")) for who, v in pairs)).cast(CONVERSATION)


def sequential(qas: Column) -> Column:
    """A question and an answer at a time."""
    return F.flatten(F.transform(qas, lambda x: _turns(("User", x["question"]), ("Assistant", x["answer"]))))


def compound(qas: Column, joint: str = " And ") -> Column:
    """All questions in one turn, all answers in one."""
    first = F.get(qas, F.lit(0))["question"]
    rest = F.transform(F.slice(qas, F.lit(2), F.greatest(F.size(qas) - 1, F.lit(0))), lambda x: uncapitalised(x["question"]))
    asked = F.when(F.size(qas) > 1, F.concat(first, F.lit(joint), F.array_join(rest, joint))).otherwise(first)
    said = F.array_join(F.transform(qas, lambda x: capitalised(x["answer"])), " ")
    return _turns(("User", asked), ("Assistant", said))


def hybrid(qas: Column, together: int = 2) -> Column:
    """The first few at once, the others one at a time."""
    return F.concat(compound(F.slice(qas, 1, together)), sequential(F.slice(qas, F.lit(together + 1), F.greatest(F.size(qas) - together, F.lit(0)))))


#: How many questions are asked at once; the shares of hybrid conversations, and of compound ones among the others.
BUNDLES, HYBRID_SHARE, COMPOUND_SHARE = (2, 3), 0.5, 0.5


def bundled(qas: Column, at: Column, size: Column) -> Column:
    """One question at a time, but for `size` at once behind the first `at`."""
    behind = at + size
    return F.concat(sequential(F.slice(qas, F.lit(1), at)), compound(F.slice(qas, at + 1, size)), sequential(F.slice(qas, behind + 1, F.greatest(F.size(qas) - behind, F.lit(0)))))


def mixed(qas: Column, u: Callable[[str], Column]) -> Column:
    """One of the shapes for each conversation, by draws u(name): hybrid, compound or sequential.

    Hybrid ones, of three questions at least, ask some of BUNDLES at once at a drawn place among the turns; two if there
    are fewer than four. Compound ones ask so many at once and drop the rest.
    """
    n = F.size(qas)
    drawn = F.get(F.array(*map(F.lit, BUNDLES)), F.floor(u("size") * len(BUNDLES)).cast("int"))
    size = F.when(n < 4, F.lit(2)).otherwise(drawn)
    at = F.floor(u("place") * (n - size + 1)).cast("int")
    hybrid_ = (n >= 3) & (u("shape") < HYBRID_SHARE)
    return F.when(hybrid_, bundled(qas, at, size)).when(u("rest") < COMPOUND_SHARE, compound(F.slice(qas, F.lit(1), drawn))).otherwise(sequential(qas))


def assembled(rows: DataFrame, qas: str, shape: Column) -> DataFrame:
    """rows with `conversations` in the shape that is named: sequential, compound or hybrid."""
    q = F.col(qas)
    return rows.withColumn("conversations", F.when(shape == "compound", compound(q)).when(shape == "hybrid", hybrid(q)).otherwise(sequential(q)))


def selected_tasks(pool: DataFrame, item: str, most: int, seed: str) -> DataFrame:
    """pool(item, name, opener, needs, question, answer) with the tasks chosen for each item, in their order.

    Of tasks with one name or one answer the first by a draw stays; openers come first; a task that needs another
    comes only where that one was chosen, behind it.
    """
    u = hash_u(seed, item, "name", "question")
    rank = lambda *keys: F.row_number().over(Window.partitionBy(item, *keys).orderBy(u, "question"))
    one = pool.withColumn("__u", u).withColumn("__r", rank("name")).where("__r = 1").withColumn("__r", rank("answer")).where("__r = 1")
    order = Window.partitionBy(item).orderBy(F.col("needs").isNotNull(), ~F.col("opener"), "__u", "name")
    ranked = one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    chosen = ranked.select(item, F.col("name").alias("__has"))
    kept = ranked.join(chosen, (ranked[item] == chosen[item]) & (ranked["needs"] == chosen["__has"]), "left").select(ranked["*"], "__has")
    return kept.where(F.col("needs").isNull() | F.col("__has").isNotNull()).drop("__u", "__r", "__has")


def walks(clips: DataFrame, run: str, position: str, seed: str, p: float, most: int) -> DataFrame:
    """(run, start, left, right): for each clip, how far a walk to both sides of it goes, by reproducible draws.

    The walk's length is truncated geometric; sides alternate from a drawn one, and the ends of the run stop it.
    """
    ends = clips.groupBy(run).agg(F.min(position).alias("__lo"), F.max(position).alias("__hi"))
    length = weighted_pick(truncated_geometric(p, 1, most), hash_u(seed, run, position))
    first = hash_u(seed + "side", run, position) < 0.5
    long, short = F.ceil((length - 1) / 2), F.floor((length - 1) / 2)
    out = clips.join(ends, run).withColumn("__l", F.when(first, long).otherwise(short)).withColumn("__r", F.when(first, short).otherwise(long))
    return out.select(run, F.col(position).alias("start"), F.least("__l", F.col(position) - F.col("__lo")).cast("long").alias("left"), F.least("__r", F.col("__hi") - F.col(position)).cast("long").alias("right"))


def random_conversations(pool: DataFrame, outputs: DataFrame, seed: str, p: float, most: int, longest: float) -> DataFrame:
    """(out_id, place, id): conversations that join records of one language at random, up to a summed duration.

    pool(id, lang, duration), outputs(out_id, lang). A record's number in its language is its place in a hash order;
    each output draws a length and numbers, so records are found by an equality join, not by a scan of the pool.
    """
    placed = numbered(pool, ["lang"], hash_u(seed, "id"), ["id"], "number")
    sizes = pool.groupBy("lang").agg(F.count(F.lit(1)).alias("__n"))
    length = weighted_pick(truncated_geometric(p, 1, most), hash_u(seed + "n", "out_id"))
    draws = outputs.join(sizes, "lang").withColumn("place", F.explode(F.sequence(F.lit(1), length)))
    draws = draws.withColumn("number", F.floor(hash_u(seed + "k", "out_id", "place") * F.col("__n")))
    found = draws.join(placed, ["lang", "number"])
    first = F.row_number().over(Window.partitionBy("out_id", "id").orderBy("place"))
    found = found.withColumn("__first", first).where("__first = 1")
    run = F.sum("duration").over(Window.partitionBy("out_id").orderBy("place"))
    return found.withColumn("__run", run).where(F.col("__run") <= longest).select("out_id", "place", "id")


def compared(pairs: DataFrame) -> DataFrame:
    """pairs(a_speaker, b_speaker, a_duration, b_duration) with answers: same speaker? which clip is longer?"""
    same = F.when(F.col("a_speaker") == F.col("b_speaker"), "Yes, it is the same speaker.").otherwise("No, these are two speakers.")
    longer = F.when(F.col("a_duration") > F.col("b_duration"), "The first clip.").when(F.col("a_duration") < F.col("b_duration"), "The second clip.").otherwise("Both are as long.")
    return pairs.withColumn("same_speaker", same).withColumn("longer", longer)


def negative_pairs(clips: DataFrame, item: str, speaker: str, seed: str) -> DataFrame:
    """(item, other): for each clip one of another speaker: the next such in a hash order, after the last one the first.

    The order is cut into ranges of the hash, as many as a range has rows. In a range, runs of one speaker go to the
    first clip of the next run; the last run of a range goes on to the ranges that follow, of which only the first clip
    and the first of another speaker come to the driver. Every clip gets a partner if there are two speakers.
    """
    n = min(1 << 16, buckets_for(clips.count()))
    u = hash_u(seed, item)
    dealt = clips.select(F.col(item).alias("item"), F.col(speaker).alias("speaker"), u.alias("u")).withColumn("bin", F.floor(F.col("u") * n))
    order = Window.partitionBy("bin").orderBy("u", "item")
    start = F.coalesce(~F.col("speaker").eqNullSafe(F.lag("speaker").over(order)), F.lit(True)) | (F.row_number().over(order) == 1)
    numbered_runs = dealt.withColumn("__new", start.cast("int")).withColumn("run", F.sum("__new").over(order))
    firsts = numbered_runs.where("__new = 1").select("bin", (F.col("run") - 1).alias("run"), F.col("item").alias("other"), F.col("speaker").alias("other_speaker"))
    heads = firsts.where("run < 2").select("bin", "run", "other", "other_speaker").collect()  # two rows of a range at most
    at = {(r["bin"], r["run"]): (r["other"], r["other_speaker"]) for r in heads}
    lasts = numbered_runs.groupBy("bin").agg(F.max("run").alias("run"), F.max_by("speaker", "run").alias("speaker")).orderBy("bin").collect()
    bins = [r["bin"] for r in lasts]

    def seen_from(speaker: object, k: int) -> object:
        """The first clip of another speaker from the k-th range on."""
        head = at[bins[k], 0]
        return head[0] if head[1] != speaker else at[bins[k], 1][0] if (bins[k], 1) in at else beyond[k]

    beyond: list = [None] * len(bins)  # behind each range, the first clip of another speaker than its first one
    for k in [*range(len(bins) - 1, -1, -1)] * 2:  # twice, as the last range goes on to the first
        beyond[k] = seen_from(at[bins[k], 0][1], (k + 1) % len(bins))
    told = [(r["bin"], r["run"], seen_from(r["speaker"], (k + 1) % len(bins))) for k, r in enumerate(lasts)]
    told = [t for t in told if t[2] is not None]
    kind = firsts.schema["other"].dataType.simpleString()
    inside = firsts.where("run >= 1").select("bin", "run", "other")
    partners = inside.unionByName(clips.sparkSession.createDataFrame(told, f"bin long, run long, other {kind}"))
    return numbered_runs.join(partners, ["bin", "run"]).select(F.col("item").alias(item), "other")


def respellings(word: str, lexicon: dict[str, list[str]] | None = None) -> list[str]:
    """Variants of a word that sound alike: from a lexicon, by rules on letters, and in another case."""
    rules = [("ph", "f"), ("ck", "k"), ("qu", "k"), ("y", "i"), ("c(?=[eiy])", "s"), ("(.)\\1", r"\1"), ("th", "t"), ("eau", "o"), ("x", "ks")]
    out = list((lexicon or {}).get(word.lower(), []))
    for pattern, by in rules:
        new = re.sub(pattern, by, word.lower())
        if new != word.lower():
            out.append(new)
    shaped = [v.upper() if word.isupper() else v.capitalize() if word[:1].isupper() else v for v in out]
    return list(dict.fromkeys([*shaped, *([word.lower()] if word != word.lower() else [])]))


def perturbed(text: str, changes: dict[str, str]) -> str:
    """The text with phrases respelled: longer phrases first, whole words, any case; a word is changed once."""
    if not changes:
        return text
    keys = sorted(changes, key=lambda k: (-len(k.split()), -len(k), k))
    pattern = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, keys)) + r")(?!\w)", re.I)
    table = {k.lower(): v for k, v in changes.items()}

    def put(m: re.Match) -> str:
        new = table[m[0].lower()]
        return new[:1].upper() + new[1:] if m[0][:1].isupper() else new

    return pattern.sub(put, text)


def with_respellings(rows: DataFrame, words: str, out: str, lexicon: dict[str, list[str]] | None = None) -> DataFrame:
    """rows with `out`, a map of those words of an array column that have respellings to their first one."""
    kept = rows.drop(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: [{w: found[0] for w in own if (found := respellings(w, lexicon))} for own in pdf[words]]})

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInPandas(run, f"{names}, `{out}` map<string,string>")


def with_perturbed(rows: DataFrame, text: str, changes: str, out: str = "perturbed") -> DataFrame:
    """rows with `out`: the text after the changes of a map column; null maps change nothing."""
    kept = rows.drop(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{out: [perturbed(t or "", dict(c or {})) for t, c in zip(pdf[text], pdf[changes])]})

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInPandas(run, f"{names}, `{out}` string")
