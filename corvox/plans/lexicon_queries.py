"""Queries of §2.9 on the lexicon of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import lexicon as X
from ..sources.scratch import scratch
from .tables import query, table
from .turn_queries import u_sql

WORD = r"(\p{L}+(?:-\p{L}+)*)"
TOKENS = rf"""raws as (select doc_id as item, unnest(r) as raw, unnest(range(len(r))) as pos from (select doc_id, regexp_extract_all(text, '[^\p{{L}}]*\p{{L}}+(?:-\p{{L}}+)*') as r from documents)),
toks as (select item, pos, surface, lower(surface) as key, pos = 0 or regexp_matches(gap, '[!?…]|\.\s') as starts, regexp_matches(gap, '^\s+$') as tight
 from (select item, pos, regexp_extract(raw, '\p{{L}}+(?:-\p{{L}}+)*$') as surface, regexp_extract(raw, '^[^\p{{L}}]*') as gap from raws))"""
WORDS = TOKENS + r""", bs as (select key, surface, count(*) as n, count(*) filter (where not starts) as inn from toks where length(key) >= 2 group by all),
ws as (select key, sum(n)::bigint as count, sum(inn)::bigint as inn, (sum(inn) filter (where regexp_matches(surface, '^\p{Lu}')))::bigint as capital, (sum(n) filter (where regexp_matches(surface, '^\p{Lu}')))::bigint as any_capital,
 (sum(n) filter (where regexp_matches(surface, '^\p{Lu}{2,}$')))::bigint as acronym from bs group by key),
ds as (select key, count(distinct item) as docs from toks where length(key) >= 2 group by key),
usual as (select key, surface as usual from (select *, row_number() over (partition by key order by inn desc, n desc, surface) as rn from bs) where rn = 1),
words as (select key, count, inn, coalesce(capital, 0) as capital, coalesce(any_capital, 0) as any_capital, coalesce(acronym, 0) as acronym, docs, usual from ws join ds using (key) join usual using (key)),
classes as (select *, acronym / count >= 0.5 as is_acronym, (case when inn > 0 then capital / inn >= 0.5 else any_capital = count end) and not (acronym / count >= 0.5) as is_proper, row_number() over (order by count desc, key) - 1 as rank from words where count >= 2),
ents as (select item, phrase from (select item, g, sum(nm::int) as names, count(*) as n, string_agg(surface, ' ' order by pos) as phrase, count(distinct surface) as k from
 (select *, min(pos) filter (where nm) over (partition by item, g) as a, max(pos) filter (where nm) over (partition by item, g) as b from
 (select *, sum((not inr)::int) over (partition by item order by pos) as g from
 (select *, regexp_matches(surface, '^\p{Lu}') and not starts as nm, (regexp_matches(surface, '^\p{Lu}') and not starts) or (surface in ('of', 'de', 'le') and not starts) as inr from toks)) where inr)
 where pos between a and b group by item, g) where names >= 2 and n <= 4 and k = n),
ranks as (select item, max(rank) as max_rank from toks join classes using (key) group by item having not bool_or(is_proper or is_acronym) and item not in (select item from ents))"""


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return X.token_table(table(spark, d, "documents").select("doc_id", "text"))


def _written_tokens(spark: SparkSession, d: str) -> DataFrame:
    """The tokens, written to the shared folder for a query that reads them several times."""
    path = scratch(spark, "tokens")
    _tokens(spark, d).write.parquet(path)
    return spark.read.parquet(path)


def _classes(tokens: DataFrame) -> DataFrame:
    return X.ranked(X.classified(X.scanned(tokens)))


def _words(spark: SparkSession, d: str) -> DataFrame:
    return _classes(_tokens(spark, d))


#: Words that join the names of an entity.
LINKS = ["of", "de", "le"]


@query(f"with {TOKENS} select item, count(*) as n, count(*) filter (where starts) as n_starts, count(distinct key) as n_keys from toks group by item")
def word_tokeniser(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("starts"), 1)).alias("n_starts"), F.countDistinct("key").alias("n_keys"))


@query(f"with {WORDS} select key, count, inn as inner_count, capital, acronym, docs, usual from words")
def corpus_scan(spark: SparkSession, d: str) -> DataFrame:
    return X.scanned(_tokens(spark, d)).select("key", "count", F.col("inner").alias("inner_count"), "capital", "acronym", "docs", "usual")


@query(f"with {WORDS} select key, rank, is_acronym, is_proper from classes where count >= 3")
def key_classes_and_ranks(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).where("count >= 3").select("key", "rank", "is_acronym", "is_proper")


@query(f"with {WORDS} select * from ranks")
def rarest_word(spark: SparkSession, d: str) -> DataFrame:
    t = _written_tokens(spark, d)
    return X.rarest(t, _classes(t), X.entity_runs(t, LINKS))


@query(f"with {WORDS}, o as (select max_rank as r, row_number() over (order by max_rank) - 1 as k from ranks) select coalesce((select min(r) from o where k >= floor(0.3 * (select count(*) from documents))), (select max(r) + 1 from o), 0)::bigint as cutoff")
def cutoff_selection(spark: SparkSession, d: str) -> DataFrame:
    t = _written_tokens(spark, d)
    ranks = X.rarest(t, _classes(t), X.entity_runs(t, LINKS))
    return spark.createDataFrame([(X.cutoff(ranks, 0.3, table(spark, d, "documents").count()),)], "cutoff long")


@query(f"""with {WORDS}, t as (select count(*) as t from toks where length(key) >= 2), e as (select lower(phrase) as key, phrase, count(*) as n from ents group by all), r as (select *, row_number() over (partition by key order by n desc, phrase) as rn from e)
select key, max(phrase) filter (where rn = 1) as surface, sum(n)::bigint as count, round((ln((t + 1.0) / (sum(n) + 1)) + 0.001) * 2.5, 6) as weight from r, t group by key, t""")
def entity_pool(spark: SparkSession, d: str) -> DataFrame:
    t = _written_tokens(spark, d)
    total = t.where(F.length("key") >= 2).count()
    return X.entity_pool(X.entity_runs(t, LINKS), total).withColumn("weight", F.round("weight", 6))


@query(f"with {WORDS} select key, is_acronym, false as is_proper from classes where count >= 5")
def key_classes_of_german(spark: SparkSession, d: str) -> DataFrame:
    return X.classified(X.scanned(_tokens(spark, d)), 5, german=True).select("key", "is_acronym", "is_proper")


@query(f"""with {WORDS}, t as (select count(*) as t from toks where length(key) >= 2), k as (select count(*) as k from documents)
select key, round((ln((t + 1.0) / (count + 1)) + 0.001) * case when is_acronym then 3.0 when is_proper then 2.0 else 1.0 end, 6) as weight from classes, t, k
where count >= 2 and (is_proper or is_acronym or rank >= 500) and docs <= 0.05 * k and (is_proper or is_acronym or (key not in ('the', 'and') and length(key) >= 3))""")
def word_pool(spark: SparkSession, d: str) -> DataFrame:
    tokens = _written_tokens(spark, d)
    w = _classes(tokens)
    t = tokens.where(F.length("key") >= 2).count()
    pool = X.word_pool(w, 500, table(spark, d, "documents").count(), t, ["the", "and"])
    return pool.select("key", F.round("weight", 6).alias("weight"))


@query(f"""with {WORDS}, t as (select count(*)::double as t from toks where length(key) >= 2),
p as (select item, key || ' ' || k1 as phrase, key as a, k1 as b from (select *, lead(key) over w as k1, lead(starts or not tight) over w as s1 from toks window w as (partition by item order by pos)) where k1 is not null and not s1),
c as (select phrase, a, b, count(*) as c, count(distinct item) as docs from p group by all having count(*) >= 3), k as (select * from classes where not is_proper and not is_acronym and key not in ('euh', 'heu', 'hum', 'heum', 'hein', 'ben', 'bah', 'bè', 'beh', 'mmh', 'mh', 'hmm')),
m as (select c.*, x.count as f, y.count as g, greatest(4, ceil(0.7 * least(length(a), length(b))))::int as q, x.rank >= 500 or y.rank >= 500 as anchored from c join k x on x.key = a join k y on y.key = b)
select phrase, c, docs, round(log2(c) + log2(t) - log2(f) - log2(g), 6) as pmi from m, t where anchored and a <> b and not (least(length(a), length(b)) >= q and left(a, q) = left(b, q)) and log2(c) + log2(t) - log2(f) - log2(g) >= 7""")
def collocations(spark: SparkSession, d: str) -> DataFrame:
    t = _written_tokens(spark, d)
    w = _classes(t)
    out = X.collocations(t, w, w.where("rank >= 500"), 2, t.where(F.length("key") >= 2).count())
    return out.select("phrase", "c", "docs", F.round("pmi", 6).alias("pmi"))


@query(f"""with {TOKENS}, p as (select item, key || ' ' || k1 || ' ' || k2 as phrase from (select *, lead(key) over w as k1, lead(starts) over w as s1, lead(key, 2) over w as k2, lead(starts, 2) over w as s2 from toks window w as (partition by item order by pos)) where k1 is not null and k2 is not null and not s1 and not s2)
select phrase, count(*) as c, count(distinct item) as docs from p group by phrase having count(*) >= 5""")
def phrase_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return X.phrases(_tokens(spark, d), 3).groupBy("phrase").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("item").alias("docs")).where("c >= 5")


@query(f"with {WORDS}, pool as (select key from classes where count between 2 and 20 and length(key) >= 6) select item, string_agg(distinct key, ' ' order by key) as keys from toks semi join pool using (key) group by item")
def present_keys(spark: SparkSession, d: str) -> DataFrame:
    t = _written_tokens(spark, d)
    pool = X.scanned(t).where("count between 2 and 20 and length(key) >= 6")
    return X.present(t, pool).select("item", F.array_join("keys", " ").alias("keys"))


@query(f"""with {WORDS}, a as (select key, count from words where count <= 2 and length(key) >= 3), b as (select key, count from words where count >= 3)
select distinct a.key from a join b on substr(a.key, 1, 3) = substr(b.key, 1, 3) and starts_with(b.key, a.key) and length(b.key) > length(a.key) and b.count >= greatest(3, 3 * a.count)""")
def prefix_disfluencies(spark: SparkSession, d: str) -> DataFrame:
    return X.prefix_keys(X.scanned(_tokens(spark, d)))


@query(f"""with {TOKENS}, t as (select *, lag(key) over (partition by item order by pos) as b from toks) select item, count(*) as n from t where b = key or (starts_with(key, b) and length(b) >= 2) group by item""")
def stutter_checks(spark: SparkSession, d: str) -> DataFrame:
    t = _tokens(spark, d).withColumn("b", F.lag("key").over(Window.partitionBy("item").orderBy("pos")))
    return t.where(X.stutters(F.col("b"), F.col("key"))).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {TOKENS}, t as (select *, regexp_matches(surface, '^\\p{{Lu}}') and not starts as nm, (regexp_matches(surface, '^\\p{{Lu}}') and not starts) or (surface in ('of', 'de', 'le') and not starts) as inr from toks),
g as (select *, sum((not inr)::int) over (partition by item order by pos) as g from t), r as (select *, min(pos) filter (where nm) over (partition by item, g) as a, max(pos) filter (where nm) over (partition by item, g) as b from g where inr)
select item, phrase from (select item, g, sum(nm::int) as names, count(*) as n, string_agg(surface, ' ' order by pos) as phrase, count(distinct surface) as k from r where pos between a and b group by item, g) where names >= 2 and n <= 4 and k = n""")
def entity_phrases(spark: SparkSession, d: str) -> DataFrame:
    return X.entity_runs(_tokens(spark, d), ["of", "de", "le"])


@query(r"""with w as (select doc_id as item, unnest(r) as raw, unnest(range(len(r))) as pos from (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') as r from documents where regexp_matches(text, '\p{Lu}') and regexp_matches(text, '[.,?]'))),
b as (select *, lag(raw) over (partition by item order by pos) as before from w), x as (select regexp_extract(raw, '^(\p{L}[\p{L}''’-]*)[.,;:!?…]*$', 1) as word from b where regexp_matches(before, '\p{Ll}$'))
select lower(word) as word, count(*) as n, round(avg(regexp_matches(word, '^\p{Ll}')::int), 6) as share from x where word <> '' and not regexp_matches(word, '-$') and not regexp_matches(word, '^\p{Lu}{2,}$') group by lower(word) having count(*) >= 5 and avg(regexp_matches(word, '^\p{Ll}')::int) >= 0.8""")
def common_words(spark: SparkSession, d: str) -> DataFrame:
    return X.common_words(table(spark, d, "documents").select("doc_id", "text")).select("word", "n", F.round("share", 6).alias("share"))


@query("""select lang, round((n + 1.0) / (sum(n) over () + 1.0 * 10), 8) as prior from (select lang, count(*) as n from documents group by lang)""")
def prompt_language_prior(spark: SparkSession, d: str) -> DataFrame:
    return X.language_prior(table(spark, d, "documents"), "lang", 1.0, 10).select("lang", F.round("prior", 8).alias("prior"))


@query(f"""with pr as (select lang, (n + 1.0) / (sum(n) over () + 10.0) as prior from (select lang, count(*) as n from documents group by lang)), s as (select doc_id, l.lang, {u_sql("p", "doc_id", "l.lang")} as p from documents d, (select distinct lang from documents) l)
select doc_id, lang from (select doc_id, s.lang, row_number() over (partition by doc_id order by p * pow(prior, 0.5) desc, s.lang) as rn from s join pr using (lang)) where rn = 1""")
def bayesian_language_choice(spark: SparkSession, d: str) -> DataFrame:
    """Scores for every text and language are given; here they are drawn, for the languages that there are."""
    docs = table(spark, d, "documents")
    langs = docs.groupBy().agg(F.array_sort(F.collect_set("lang")).alias("langs"))  # one row of the languages' codes
    scores = docs.select("doc_id").join(F.broadcast(langs)).select("doc_id", F.explode("langs").alias("lang")).withColumn("p", hashing.hash_u("p", "doc_id", "lang"))
    return X.best_language(scores, "doc_id", X.language_prior(docs, "lang", 1.0, 10), 0.5)


@query("""select source, lang as majority from (select source, lang, row_number() over (partition by source order by count(*) desc, lang) as rn from documents group by source, lang) where rn = 1""")
def majority_language(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("source").agg(F.min(F.struct(-F.col("n"), F.col("lang")))["lang"].alias("majority"))


@query(f"""with x as (select doc_id, c, case when c then {u_sql("neg", "doc_id")} < 0.4 else true end as keep from (select doc_id, n_chars < 1000 as c from documents)) select doc_id, twin from (select doc_id, unnest(case when c then [false] else [true, false] end) as twin from x where keep)""")
def paired_expansion(spark: SparkSession, d: str) -> DataFrame:
    """Texts with candidates twice, with and without; of the others a share."""
    c = F.col("n_chars") < 1000
    docs = table(spark, d, "documents").where(~c | (hashing.hash_u("neg", "doc_id") < 0.4))
    return docs.select("doc_id", F.explode(F.when(c, F.array(F.lit(False))).otherwise(F.array(F.lit(True), F.lit(False)))).alias("twin"))


@query(f"""with l as (select l_orderkey, string_agg('w' || l_partkey, ', ' order by {u_sql("list", "l_orderkey", "l_linenumber")}, l_linenumber, 'w' || l_partkey) as words from lineitem group by l_orderkey) select l_orderkey, 'Words that may occur: ' || words || '.' as prompt from l""")
def hotword_lists(spark: SparkSession, d: str) -> DataFrame:
    item = F.struct(hashing.hash_u("list", "l_orderkey", "l_linenumber").alias("u"), "l_linenumber", F.concat(F.lit("w"), "l_partkey").alias("w"))
    words = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["w"]), ", ")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("Words that may occur: "), words, F.lit(".")).alias("prompt"))


@query("""select c_custkey, string_split(replace(regexp_extract(p, ': (.*)\\.$', 1), ', ', ','), ',')[2] as second from (select c_custkey, 'Words: ' || c_name || ', ' || c_mktsegment || '.' as p from customer)""")
def prompt_parse_back(spark: SparkSession, d: str) -> DataFrame:
    p = F.concat(F.lit("Words: "), "c_name", F.lit(", "), "c_mktsegment", F.lit("."))
    return table(spark, d, "customer").select("c_custkey", F.get(F.split(F.regexp_extract(p, r": (.*)\.$", 1), ", "), F.lit(1)).alias("second"))


@query("""with w as (select distinct w from (select unnest(string_split_regex(lower(text), '[^a-z]+')) as w from benchmark) where length(w) >= 5),
p as (select a.w as word, b.w as distractor, round(1.0 - levenshtein(a.w, b.w) * 1.0 / greatest(length(a.w), length(b.w)), 6) as similarity from w a join w b on left(a.w, 3) = left(b.w, 3) and a.w <> b.w),
r as (select *, row_number() over (partition by word order by similarity desc, distractor) as place from p) select word, distractor, similarity, place from r where place <= 3""")
def distractor_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The three words most like each word of the benchmark, of those that begin as it does."""
    words = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where(F.length("word") >= 5).distinct()
    return X.ranked_distractors(words, words.withColumnRenamed("word", "distractor"), 3, 3)


@query("""with g as (select item_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i + 7], ' ')))) as g from (select item_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') as w from benchmark)),
d as (select doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i + 7], ' ')))) as g from (select doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') as w from documents))
select doc_id, item_id, count(*) as shared from d join g using (g) group by all""")
def lexical_overlap_gate(spark: SparkSession, d: str) -> DataFrame:
    """8-word runs that a document shares with an item of the benchmark: runs meet by a hash, equal runs are then told.

    The benchmark's hashes are few; as long as they are (a checked count), they are sent to every worker, so that of the
    documents' runs only those that hit are moved.
    """
    grams = lambda t, i: table(spark, d, t).select(i, F.explode(F.array_distinct(text.ngrams(text.words(F.lower("text")), 8))).alias("g"))
    listed = grams("benchmark", "item_id").withColumn("h", F.xxhash64("g"))
    hashes = listed.select("h").distinct()
    few = hashes.limit(1_000_001).count() <= 1_000_000
    hit = grams("documents", "doc_id").withColumn("h", F.xxhash64("g")).join(F.broadcast(hashes) if few else hashes, "h", "left_semi")
    return hit.join(listed, ["h", "g"]).groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("shared"))
