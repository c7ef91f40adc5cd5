"""Corpus lexicon: tokens, counts, classes, phrases, collocations, pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def token_table(docs: DataFrame, item: str = "doc_id", text: str = "text") -> DataFrame:
    """(item, pos, surface, key, starts, tight): word tokens, whether each begins a sentence and follows the one before.

    A token begins a sentence if it is the first, or the characters since the token before hold ! ? … or a period that
    is followed by white space; it follows tightly if they are white space only. Keys are in lower case.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(r"([^\p{L}]*\p{L}+(?:-\p{L}+)*)"), 1)
    t = docs.select(F.col(item).alias("item"), F.posexplode(found).alias("pos", "raw"))
    surface = F.regexp_extract("raw", r"(\p{L}+(?:-\p{L}+)*)$", 1)
    t = t.select("item", "pos", surface.alias("surface"), F.regexp_extract("raw", r"^([^\p{L}]*)", 1).alias("gap"))
    return t.select("item", "pos", "surface", F.lower("surface").alias("key"), ((F.col("pos") == 0) | F.col("gap").rlike(r"[!?…]|\.\s")).alias("starts"), F.col("gap").rlike(r"^\s+$").alias("tight"))


def scanned(tokens: DataFrame) -> DataFrame:
    """One row for each key of at least two letters: count, non-start count, capitals, acronyms, documents, usual surface.

    The tokens are counted once, by key, text and surface; both sums over that share its shuffle.
    """
    upper = F.col("surface").rlike(r"^\p{Lu}")
    acronym = F.col("surface").rlike(r"^\p{Lu}{2,}$")
    once = tokens.where(F.length("key") >= 2).groupBy("key", "item", "surface").agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("starts")).cast("long")).alias("inner"))
    by_surface = once.groupBy("key", "surface").agg(F.sum("n").alias("n"), F.sum("inner").alias("inner"))
    words = by_surface.groupBy("key").agg(
        F.sum("n").alias("count"),
        F.sum("inner").alias("inner"),
        F.sum(F.when(upper, F.col("inner")).otherwise(0)).alias("capital"),
        F.sum(F.when(upper, F.col("n")).otherwise(0)).alias("any_capital"),
        F.sum(F.when(acronym, F.col("n")).otherwise(0)).alias("acronym"),
        F.min(F.struct(-F.col("inner"), -F.col("n"), F.col("surface")))["surface"].alias("usual"),
    )
    docs = once.groupBy("key").agg(F.countDistinct("item").alias("docs"))
    return words.join(docs, "key")


def classified(words: DataFrame, least: int = 2, german: bool = False) -> DataFrame:
    """The words seen at least `least` times, with is_acronym and is_proper.

    A proper noun has a capital in half of its places inside sentences, or is never inside and always has one. In German
    all nouns do, so there capitals say nothing and no word counts as proper.
    """
    acronym = F.col("acronym") / F.col("count") >= 0.5
    proper = F.when(F.col("inner") > 0, F.col("capital") / F.col("inner") >= 0.5).otherwise(F.col("any_capital") == F.col("count"))
    return words.where(F.col("count") >= least).withColumn("is_acronym", acronym).withColumn("is_proper", F.lit(not german) & proper & ~acronym)


def ranked(words: DataFrame) -> DataFrame:
    """words with `rank` from 0 by falling count, then key: places are summed over counts, not ordered in one task."""
    per = words.groupBy("count").agg(F.count(F.lit(1)).alias("n"))
    before = per.select("count", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return words.join(before, "count").withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("count").orderBy("key")) - 1).drop("before")


def rarest(tokens: DataFrame, words: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """(item, max_rank): the rank of the rarest word of each text without proper nouns, acronyms and entity phrases.

    words are classes of the corpus, few beside its tokens; words that have none, as they are too rare, don't count.
    entities(item, ...) names the texts with an entity phrase.
    """
    told = tokens.select("item", "key").join(words.select("key", "rank", (F.col("is_proper") | F.col("is_acronym")).alias("__named")), "key")
    out = told.groupBy("item").agg(F.max("rank").alias("max_rank"), F.bool_or("__named").alias("__named")).where(~F.col("__named")).drop("__named")
    return out if entities is None else out.join(entities.select("item").distinct(), "item", "left_anti")


def cutoff(ranks: DataFrame, target: float, texts: int | None = None, rank: str = "max_rank") -> int:
    """The rank below which a share `target` of all texts has all its words; above all ranks if fewer have a rank."""
    per = ranks.groupBy(rank).agg(F.count(F.lit(1)).alias("n"))
    run = F.sum("n").over(Window.orderBy(rank))
    total = (per.agg(F.sum("n")).first()[0] or 0) if texts is None else texts
    hit = per.withColumn("__run", run).where(F.col("__run") > int(target * total)).agg(F.min(rank)).first()[0]
    if hit is None:
        most = per.agg(F.max(rank)).first()[0]
        return 0 if most is None else int(most) + 1
    return int(hit)


def word_pool(words: DataFrame, least_rank: int, texts: int, tokens: int, stop: list[str], most_docs: float = 0.05) -> DataFrame:
    """Words to bias towards, with weight (ln((T + 1) / (c + 1)) + 0.001) times 3 for acronyms, 2 for proper nouns."""
    special = F.col("is_proper") | F.col("is_acronym")
    boost = F.when(F.col("is_acronym"), 3.0).when(F.col("is_proper"), 2.0).otherwise(1.0)
    keep = (F.col("count") >= 2) & (special | (F.col("rank") >= least_rank)) & (F.col("docs") <= most_docs * texts)
    plain = special | (~F.col("key").isin(stop) & (F.length("key") >= 3))
    return words.where(keep & plain).withColumn("weight", (F.log((F.lit(tokens) + 1.0) / (F.col("count") + 1)) + 0.001) * boost)


def phrases(tokens: DataFrame, n: int, tight: bool = False) -> DataFrame:
    """(item, pos, phrase): runs of n neighbouring tokens inside a sentence; tight ones have only white space between."""
    w = Window.partitionBy("item").orderBy("pos")
    broken = F.col("starts") | (~F.col("tight") if tight else F.lit(False))
    out = tokens.select("item", "pos", "key", broken.alias("__broken"))
    for k in range(1, n):
        out = out.withColumn(f"__k{k}", F.lead("key", k).over(w)).withColumn(f"__s{k}", F.lead("__broken", k).over(w))
    for k in range(1, n):
        out = out.where(F.col(f"__k{k}").isNotNull() & ~F.col(f"__s{k}"))
    return out.select("item", "pos", F.concat_ws(" ", "key", *(f"__k{k}" for k in range(1, n))).alias("phrase"))


#: Fillers, which no collocation holds.
FILLERS = ("euh", "heu", "hum", "heum", "hein", "ben", "bah", "bè", "beh", "mmh", "mh", "hmm")


def alike(a: Column, b: Column) -> Column:
    """Whether two words are the same, or share four first letters and 0.7 of the shorter one."""
    least = F.greatest(F.lit(4), F.ceil(F.lit(0.7) * F.least(F.length(a), F.length(b))).cast("int"))
    return (a == b) | ((F.least(F.length(a), F.length(b)) >= least) & (F.left(a, least) == F.left(b, least)))


def collocations(tokens: DataFrame, words: DataFrame, pool: DataFrame, n: int, total: int, least: int = 3, bits: float = 7.0, fillers: tuple[str, ...] = FILLERS) -> DataFrame:
    """Phrases of n words seen at least `least` times with pointwise mutual information of at least `bits`.

    Only white space stands between the words of a phrase; each has two letters at least; none is a proper noun, an
    acronym or a filler, no two are alike, and one at least is in the pool. words: classified, pool: its keys.
    """
    counts = phrases(tokens, n, True).groupBy("phrase").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("item").alias("docs")).where(F.col("c") >= least)
    out = counts.withColumn("__w", F.split("phrase", " "))
    pmi = F.log2("c") + F.lit(n - 1) * F.log2(F.lit(float(total)))
    anchored = F.lit(False)
    known = words.where(~(F.col("is_proper") | F.col("is_acronym")) & ~F.col("key").isin(*fillers)).join(pool.select("key", F.lit(True).alias("__anchor")), "key", "left")
    for k in range(n):
        own = known.select(F.col("key").alias(f"__k{k}"), F.col("count").alias(f"__f{k}"), F.coalesce("__anchor", F.lit(False)).alias(f"__a{k}"))
        out = out.join(own, F.get("__w", F.lit(k)) == F.col(f"__k{k}"))
        pmi -= F.log2(f"__f{k}")
        anchored |= F.col(f"__a{k}")
    for i in range(n):
        for j in range(i + 1, n):
            out = out.where(~alike(F.col(f"__k{i}"), F.col(f"__k{j}")))
    return out.where(anchored).withColumn("pmi", pmi).where(F.col("pmi") >= bits).select("phrase", "c", "docs", "pmi")


def entity_pool(runs: DataFrame, total: int, boost: float = 2.5) -> DataFrame:
    """(key, surface, count, weight) of entity phrases (item, phrase): the usual surface, and a weight as of rare words."""
    per = runs.groupBy(F.lower("phrase").alias("key"), F.col("phrase").alias("surface")).agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy("key").agg(F.min(F.struct(-F.col("n"), F.col("surface")))["surface"].alias("surface"), F.sum("n").alias("count"))
    return out.withColumn("weight", (F.log((F.lit(total) + 1.0) / (F.col("count") + 1)) + 0.001) * boost)


def ranked_distractors(words: DataFrame, pool: DataFrame, k: int, shared: int) -> DataFrame:
    """(word, distractor, similarity, place): of the pool's words with the same first letters, the k most like each word.

    Similarity is one less the edit distance over the longer length; ties go to the word that comes first.
    """
    keyed = pool.withColumn("__head", F.left("distractor", F.lit(shared)))
    pairs = words.withColumn("__head", F.left("word", F.lit(shared))).join(keyed, "__head").where("word <> distractor").drop("__head")
    ratio = 1.0 - F.levenshtein("word", "distractor") / F.greatest(F.length("word"), F.length("distractor"))
    best = Window.partitionBy("word").orderBy(F.desc("similarity"), "distractor")
    return pairs.withColumn("similarity", F.round(ratio, 6)).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def present(tokens: DataFrame, pool: DataFrame) -> DataFrame:
    """(item, keys): the pool's words that a text holds."""
    return tokens.join(pool.select("key"), "key", "left_semi").groupBy("item").agg(F.array_sort(F.collect_set("key")).alias("keys"))


def entity_runs(tokens: DataFrame, connectors: list[str], most: int = 4) -> DataFrame:
    """(item, phrase): runs of capitalised tokens inside sentences, bridged by connectors, of 2 to `most` tokens.

    A run ends before a token that is neither; connectors at its ends are left out, and so are runs that repeat a token.
    """
    w = Window.partitionBy("item").orderBy("pos")
    name = F.col("surface").rlike(r"^\p{Lu}") & ~F.col("starts")
    link = F.col("surface").isin(connectors) & ~F.col("starts")
    t = tokens.withColumn("__n", name).withColumn("__in", name | link)
    t = t.withColumn("__g", F.sum((~F.col("__in")).cast("int")).over(w)).where("__in")
    g = Window.partitionBy("item", "__g")
    first, last = F.min(F.when(F.col("__n"), F.col("pos"))).over(g), F.max(F.when(F.col("__n"), F.col("pos"))).over(g)
    t = t.withColumn("__a", first).withColumn("__b", last).where((F.col("pos") >= F.col("__a")) & (F.col("pos") <= F.col("__b")))
    out = t.groupBy("item", "__g").agg(F.sum(F.col("__n").cast("int")).alias("names"), F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "surface"))), lambda s: s["surface"]).alias("run"))
    out = out.where((F.col("names") >= 2) & (F.col("n") <= most) & (F.size(F.array_distinct("run")) == F.col("n")))
    return out.select("item", F.array_join("run", " ").alias("phrase"))


def prefix_keys(words: DataFrame, most: int = 2, times: int = 3, shared: int = 3) -> DataFrame:
    """Rare keys that are a strict prefix of a much more frequent one; candidates meet by their first letters."""
    short = words.where((F.col("count") <= most) & (F.length("key") >= shared)).select(F.col("key").alias("rare"), F.col("count").alias("c"), F.substring("key", 1, shared).alias("__p"))
    long = words.where(F.col("count") >= times).select(F.col("key").alias("full"), F.col("count").alias("f"), F.substring("key", 1, shared).alias("__p"))
    hit = short.join(long, "__p").where(F.col("full").startswith(F.col("rare")) & (F.length("full") > F.length("rare")) & (F.col("f") >= F.greatest(F.lit(times), F.col("c") * times)))
    return hit.select(F.col("rare").alias("key")).distinct()


def stutters(a: Column, b: Column, least: int = 2) -> Column:
    """Whether b repeats a or begins with it."""
    return (a == b) | (b.startswith(a) & (F.length(a) >= least))


def common_words(docs: DataFrame, item: str = "doc_id", text: str = "text", share: float = 0.8, least: int = 5) -> DataFrame:
    """Words that stand in lower case in at least `share` of at least `least` places behind a word that ends in lower case.

    Only texts with a capital and one of . , ? are read; words all in capitals or that end in a hyphen don't count.
    """
    own = docs.where(F.col(text).rlike(r"\p{Lu}") & F.col(text).rlike("[.,?]"))
    t = own.select(F.col(item).alias("item"), F.posexplode(X.words(F.col(text))).alias("pos", "raw"))
    before = F.lag("raw").over(Window.partitionBy("item").orderBy("pos"))
    t = t.withColumn("before", before).where(F.col("before").rlike(r"\p{Ll}$"))
    t = t.withColumn("word", F.regexp_extract("raw", r"^(\p{L}[\p{L}'’-]*)[.,;:!?…]*$", 1)).where((F.col("word") != "") & ~F.col("word").rlike("-$") & ~F.col("word").rlike(r"^\p{Lu}{2,}$"))
    low = F.col("word").rlike(r"^\p{Ll}").cast("int")
    return t.groupBy(F.lower("word").alias("word")).agg(F.count(F.lit(1)).alias("n"), F.avg(low).alias("share")).where((F.col("n") >= least) & (F.col("share") >= share))


def language_prior(rows: DataFrame, language: str, alpha: float, languages: int) -> DataFrame:
    """(language, prior): counts smoothed by alpha."""
    total = F.sum("n").over(Window.partitionBy())
    return rows.groupBy(language).agg(F.count(F.lit(1)).alias("n")).select(language, ((F.col("n") + alpha) / (total + alpha * languages)).alias("prior"))


def best_language(scores: DataFrame, item: str, prior: DataFrame, strength: float) -> DataFrame:
    """(item, lang): the language with the largest p * prior^strength; the first by name on ties."""
    both = scores.join(prior, "lang").withColumn("__s", F.col("p") * F.pow("prior", F.lit(strength)))
    return both.groupBy(item).agg(F.min(F.struct(-F.col("__s"), F.col("lang")))["lang"].alias("lang"))
