"""Queries of §2.12 on corpus statistics and mixture weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import mixture as M
from ..operators.ranking import buckets_for, running_total
from .tables import CORPUS, MANIFEST, corpus, manifest, query, table

GROUPS = f"""{CORPUS}, groups as (select task, lang, dataset, count(*) as size, sum(duration) as dur from corpus group by all),
scored as (select *, pow(size, 0.5) as s from groups),
w as (select *, s / sum(s) over (partition by task, lang) as dataset_w, sum(s) over (partition by task, lang) / sum(s) over (partition by task) as lang_w, sum(s) over (partition by task) / sum(s) over () as task_w from scored)"""


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return corpus(spark, d).groupBy("task", "lang", "dataset").agg(F.count(F.lit(1)).alias("size"), F.sum("duration").alias("dur"))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(f"""with {CORPUS} select task, lang, dataset, count(*) as num_samples, round(sum(duration), 4) as total_duration, min(duration) as min_duration, max(duration) as max_duration, round(avg(duration), 4) as avg_duration,
 round(median(duration), 4) as median_duration, round(stddev_pop(duration), 4) as std_duration, sum(words)::bigint as total_words, round(avg(words), 4) as avg_words, count(distinct speaker) as num_speakers from corpus group by all""")
def manifest_statistics(spark: SparkSession, d: str) -> DataFrame:
    out = M.statistics(corpus(spark, d), ["task", "lang", "dataset"])
    return _rounded(out, 4, "total_duration", "avg_duration", "median_duration", "std_duration", "avg_words")


@query("""select role, count(*) as n_turns, round(sum(n), 4) as total, min(n) as low, max(n) as high, round(avg(n), 4) as mean, round(median(n), 4) as middle, round(stddev_pop(n), 4) as spread
from (select role, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))::double as n from conversations) group by role""")
def turn_statistics(spark: SparkSession, d: str) -> DataFrame:
    n = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).cast("double")
    t = table(spark, d, "conversations").select("role", n.alias("n"))
    r = lambda c, name: F.round(c, 4).alias(name)
    return t.groupBy("role").agg(F.count(F.lit(1)).alias("n_turns"), r(F.sum("n"), "total"), F.min("n").alias("low"), F.max("n").alias("high"), r(F.avg("n"), "mean"), r(F.median("n"), "middle"), r(F.stddev_pop("n"), "spread"))


@query(f"with {GROUPS} select task, lang, dataset, size, round(dataset_w, 8) as dataset_w, round(lang_w, 8) as lang_w, round(task_w, 8) as task_w, round(dataset_w * lang_w * task_w, 8) as p from w")
def mixture_weights(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.three_levels(_groups(spark, d), "size").select("task", "lang", "dataset", "size", "dataset_w", "lang_w", "task_w", "p"), 8, "dataset_w", "lang_w", "task_w", "p")


@query(f"""with {GROUPS}, c as (select *, greatest(dataset_w * lang_w * task_w, 0.002) as q from w) select task, lang, dataset, round(q / sum(q) over (), 8) as p from c""")
def min_weight_clip(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.three_levels(_groups(spark, d), "size", least=0.002).select("task", "lang", "dataset", "p"), 8, "p")


@query(f"""with {CORPUS}, groups as (select task, lang, dataset, sqrt(sum(duration)) / (sum(duration) / count(*)) as s from corpus group by all) select task, lang, dataset, round(s / sum(s) over (), 8) as share from groups""")
def duration_corrected_scores(spark: SparkSession, d: str) -> DataFrame:
    g = _groups(spark, d).withColumn("s", F.sqrt("dur") / (F.col("dur") / F.col("size")))
    return g.select("task", "lang", "dataset", F.round(F.col("s") / F.sum("s").over(Window.partitionBy()), 8).alias("share"))


SHARES = """shares as (select task, lang, share from (select distinct task, lang, case when lang < 'H' then 2.0 else 1.0 end * case when task < '3' then 3.0 else 1.0 end as share from groups)),
k as (select *, sum(share) over (partition by task) as ts, sum(share) over () as total from shares)"""


@query(f"with {GROUPS}, {SHARES} select w.task, w.lang, dataset, round(dataset_w * (share / ts) * (ts / total), 8) as p from w join k on w.task = k.task and w.lang = k.lang")
def hard_blend(spark: SparkSession, d: str) -> DataFrame:
    return _blend(spark, d, "hard")


@query(f"""with {GROUPS}, {SHARES}, j as (select w.*, share / ts as ls, ts / total as tsh from w join k on w.task = k.task and w.lang = k.lang),
l as (select distinct task, lang, lang_w * ls as lw, task_w * tsh as tw from j), m as (select task, lang, lw / sum(lw) over (partition by task) as lw, tw from l), t as (select task, tw / sum(tw) over () as tw from (select distinct task, tw from l))
select j.task, j.lang, j.dataset, round(dataset_w * m.lw * t.tw, 8) as p from j join m on m.task = j.task and m.lang = j.lang join t on t.task = j.task""")
def soft_blend(spark: SparkSession, d: str) -> DataFrame:
    return _blend(spark, d, "soft")


def _blend(spark: SparkSession, d: str, mode: str) -> DataFrame:
    g = _groups(spark, d)
    share = F.when(F.col("lang") < "H", 2.0).otherwise(1.0) * F.when(F.col("task") < "3", 3.0).otherwise(1.0)
    shares = g.select("task", "lang").distinct().withColumn("share", share)
    return _rounded(M.blended(M.three_levels(g, "size"), shares, mode).select("task", "lang", "dataset", "p"), 8, "p")


@query(f"""with {GROUPS}, p as (select *, round_even(dataset_w * lang_w * task_w * sum(size) over () / size, 2) as passes from w)
select task, lang, dataset, passes, case when passes > 10 then 'critical_over' when passes > 5 then 'over' when passes < 0.1 then 'critical_under' when passes < 0.25 then 'under' else 'ok' end as flag from p""")
def expected_passes(spark: SparkSession, d: str) -> DataFrame:
    return M.passes(M.three_levels(_groups(spark, d), "size"), "size").select("task", "lang", "dataset", "passes", "flag")


def _by_lang(spark: SparkSession, d: str) -> DataFrame:
    """A row for each pair of task and dataset language, with its weights."""
    g = corpus(spark, d).groupBy("task", F.lit("all").alias("lang"), F.col("lang").alias("dataset")).agg(F.count(F.lit(1)).alias("size"))
    return M.three_levels(g, "size")


#: The same in SQL, and rows held at a limit: {0} the keys, {1} the share, {2} the limit of a unit of size.
BY_LANG = f"""{CORPUS}, groups as (select task, lang as dataset, count(*) as size from corpus group by all), scored as (select *, pow(size, 0.5) as s from groups),
w as (select *, s / sum(s) over (partition by task) as dataset_w, sum(s) over (partition by task) / sum(s) over () as task_w, s / sum(s) over () as p, sum(size) over () as total from scored)"""
HELD = """f as (select *, {1} as x, {2} as c, {1} / size as r from w),
g as (select *, (1 - c * coalesce(sum(size) over (partition by {0} order by r desc, size, x rows between unbounded preceding and 1 preceding), 0)) / (1 - coalesce(sum(x) over (partition by {0} order by r desc, size, x rows between unbounded preceding and 1 preceding), 0)) as level from f),
h as (select *, min((level * r > c * (1 + 1e-12))::int) over (partition by {0} order by r desc, size, x rows between unbounded preceding and current row) as held from g),
v as (select *, case when min(held) over (partition by {0}) = 1 then null when held = 1 then c * size else x * (1 - c * sum(held * size) over (partition by {0})) / (1 - sum(held * x) over (partition by {0})) end as y, count(*) over (partition by {0}) as n from h)"""


@query(f"""with {BY_LANG}, {HELD.format("task", "dataset_w", "1.05 / (total * task_w)")} select task, dataset, round(coalesce(y, 1.0 / n) * task_w, 8) as p from v""")
def flat_cap(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.flat_capped(_by_lang(spark, d), 1.05).select("task", "dataset", "p"), 8, "p")


@query(f"""with {BY_LANG}, {HELD.format("1", "p", "1.05 / total")} select task, dataset, round(coalesce(y, p), 8) as p from v""")
def tree_cap(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.leaves_capped(_by_lang(spark, d), 1.05).select("task", "dataset", "p"), 8, "p")


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    """A mixture tree of depth 2: regions are groups, nations leaves."""
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("node_id"), F.lit(-1).alias("parent_id"), F.lit(0).alias("depth"), F.lit("group").alias("kind"), (F.col("r_regionkey") % 3).cast("double").alias("weight"), F.lit(None).cast("string").alias("manifest"))
    n = table(spark, d, "nation").select((F.col("n_nationkey") + 100).alias("node_id"), F.col("n_regionkey").alias("parent_id"), F.lit(1).alias("depth"), F.lit("leaf").alias("kind"), F.length("n_name").cast("double").alias("weight"), F.col("n_name").alias("manifest"))
    return r.unionByName(n)


RW = "case when r_regionkey % 3 = 0 then 1.0 else r_regionkey % 3 end"


@query(f"""with r as (select r_regionkey, {RW} / sum({RW}) over () as w from region) select n_name as manifest, round(w * length(n_name) / sum(length(n_name)) over (partition by n_regionkey), 8) as share from nation join r on n_regionkey = r_regionkey""")
def tree_weight_normalisation(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.sibling_normalised(_nodes(spark, d)).select("manifest", "share"), 8, "share")


@query(f"""with x as (select n_name as manifest, {RW} * length(n_name) as w from nation join region on n_regionkey = r_regionkey) select manifest, round(w / sum(w) over (), 8) as share from x""")
def raw_weight_product(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.raw_products(_nodes(spark, d)).select("manifest", "share"), 8, "share")


@query(f"with {CORPUS} select task, lang, count(*) as num_samples, round(sum(duration) / 3600, 6) as hours from corpus group by rollup (task, lang)")
def task_totals_rollup(spark: SparkSession, d: str) -> DataFrame:
    return corpus(spark, d).rollup("task", "lang").agg(F.count(F.lit(1)).alias("num_samples"), F.round(F.sum("duration") / 3600, 6).alias("hours"))


@query(f"with {CORPUS} select dataset, lang, min(duration) as low, max(duration) as high, max(duration) - min(duration) as range, round(sum(duration) / 3600, 6) as hours from corpus group by dataset, lang order by hours desc, dataset limit 15")
def duration_ranges(spark: SparkSession, d: str) -> DataFrame:
    g = corpus(spark, d).groupBy("dataset", "lang").agg(F.min("duration").alias("low"), F.max("duration").alias("high"), (F.max("duration") - F.min("duration")).alias("range"), F.round(F.sum("duration") / 3600, 6).alias("hours"))
    return g.orderBy(F.desc("hours"), "dataset").limit(15)


@query("""select split_part(p_type, ' ', 1) as sub_task, n_name as lang, count(*) as n from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all order by n desc, sub_task, lang limit 20""")
def top_task_breakdown(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("part"), F.split_part(F.col("p_type"), F.lit(" "), F.lit(1)).alias("sub_task"))
    return corpus(spark, d).select("part", "lang").join(p, "part").groupBy("sub_task", "lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "sub_task", "lang").limit(20)


@query("""select lang, count(*) as n, (ceil(count(*) / (8.0 * 4)) * 3)::bigint as steps, round(100.0 * count(*) / sum(count(*)) over (), 4) as percent from documents group by lang""")
def steps_and_composition(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return g.select("lang", "n", M.suggested_steps(F.col("n"), 8, 4, 3).cast("long").alias("steps"), F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4).alias("percent"))


REPORT = f"""{CORPUS}, groups as (select dataset, count(*) as size, count(*) filter (where speaker % 2 = 0) as seen, avg(duration) as ad, sqrt(count(*)) as s from corpus group by dataset),
x as (select *, s / sum(s) over () as p, sum(seen) over () as t from groups)"""


def _report(spark: SparkSession, d: str) -> DataFrame:
    g = corpus(spark, d).groupBy("dataset").agg(F.count(F.lit(1)).alias("size"), F.count(F.when(F.col("speaker") % 2 == 0, 1)).alias("seen"), F.avg("duration").alias("avg_duration"))
    g = g.withColumn("s", F.sqrt("size")).withColumn("p", F.col("s") / F.sum("s").over(Window.partitionBy()))
    return M.target_and_actual(g, 2)


@query(f"with {REPORT} select dataset, round(seen / t, 8) as actual, round(seen / t / p, 6) as ratio, round(seen / size, 6) as passes, round(seen * ad / 3600, 6) as hours, round((seen - p * t) / sqrt(p * t * (1 - p) * 2), 6) as z from x")
def target_vs_actual(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_rounded(_report(spark, d).select("dataset", "actual", "ratio", "passes", "hours", "z"), 8, "actual"), 6, "ratio", "passes", "hours", "z")


@query(f"with {REPORT} select round(sum(abs(seen / t - p)) / 2, 8) as total_variation from x")
def total_variation_distance(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.total_variation(_report(spark, d)), 8, "total_variation")


@query(f"with {REPORT} select dataset, round(abs(seen / t / p - 1), 6) as off from x order by off desc, dataset limit 5")
def top_deviations(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).select("dataset", F.round(F.abs(F.col("ratio") - 1), 6).alias("off")).orderBy(F.desc("off"), "dataset").limit(5)


@query("""select user_id, event_type, (sum((event_id % 3) * ceil((1000 - event_id % 4) / 4.0) + event_id % 100))::bigint as seen from events group by all""")
def seen_from_state(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    state = table(spark, d, "events").select("user_id", "event_type", F.lit(1000).alias("size"), F.lit(4).alias("num_shards"), (i % 4).alias("shard_id"), (i % 3).alias("epoch"), (i % 100).alias("position"))
    return M.seen_samples(state).groupBy("user_id", "event_type").agg(F.sum("seen").cast("long").alias("seen"))


@query("""select lang, source, coalesce(sum(case when doc_id % 4 = 0 then null else n_chars end)::bigint::varchar, 'null') as chars from (select case when doc_id % 5 = 0 then null else lang end as lang, source, doc_id, n_chars from documents) group by all""")
def null_keeping_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("lang"), "source", F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("n"))
    return docs.groupBy("lang", "source").agg(F.coalesce(F.sum("n").cast("string"), F.lit("null")).alias("chars"))


@query("""select vec_id, len(embedding)::int as n, round(len(embedding) / 16000.0, 8) as seconds, round(20 * log10(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double)) / len(embedding))), 4) as db from embeddings""")
def array_durations(spark: SparkSession, d: str) -> DataFrame:
    energy = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n = F.size("embedding")
    return table(spark, d, "embeddings").select("vec_id", n.alias("n"), F.round(n / 16000.0, 8).alias("seconds"), F.round(20 * F.log10(F.sqrt(energy / n)), 4).alias("db"))


@query("""select d.source, d.lang, count(*) as n from documents d left join (select distinct source, lang from documents where doc_id % 10 = 0) k on k.source = d.source and k.lang = d.lang where k.source is null group by all""")
def incremental_refresh(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    return docs.join(docs.where("doc_id % 10 = 0").select("source", "lang").distinct(), ["source", "lang"], "left_anti").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("""with f as (select part, min(doc) as doc from (select l_partkey as part, l_orderkey as doc from lineitem) group by part), n as (select part, doc, row_number() over (partition by part % 50 order by part) as k from f)
select part, doc, case when k = 1 then 'p' || (part % 50) else 'p' || (part % 50) || '_' || k end as destination from n""")
def global_path_dedup(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.min("l_orderkey").alias("doc"))
    ends = first.agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).first()
    n = buckets_for(ends["n"])
    width = ((ends["high"] or 0) - (ends["low"] or 0)) // n + 1
    grouped = first.withColumn("group", F.col("part") % 50)
    placed = running_total(grouped, ["group"], F.floor((F.col("part") - (ends["low"] or 0)) / width), ["part"], None, "k").withColumn("k", F.col("k") + 1)
    base = F.concat(F.lit("p"), F.col("group").cast("string"))
    return placed.select("part", "doc", F.when(F.col("k") == 1, base).otherwise(F.concat(base, F.lit("_"), F.col("k").cast("string"))).alias("destination"))


@query("""select source, lang, string_agg(distinct d, ',' order by d) as used from (select source, lang, 'b' || (doc_id % 3) as d from documents) group by all""")
def licence_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "lang", F.concat(F.lit("b"), (F.col("doc_id") % 3).cast("string")).alias("d"))
    return docs.groupBy("source", "lang").agg(F.array_join(F.array_sort(F.collect_set("d")), ",").alias("used"))


@query("""select substr(a, 1, (select coalesce(max(i), 0) from (select unnest(range(1, least(length(a), length(b)) + 1)) as i) where substr(a, 1, i) = substr(b, 1, i) and substr(a, i, 1) = '/')::int) as prefix from (select min(url) as a, max(url) as b from pages)""")
def common_directory_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The common prefix of all paths is that of the smallest and the largest; it ends at a slash."""
    ends = table(spark, d, "pages").agg(F.min("url").alias("a"), F.max("url").alias("b"))
    n = F.least(F.length("a"), F.length("b"))
    at = F.filter(F.sequence(F.lit(1), n), lambda i: (F.col("a").substr(F.lit(1), i) == F.col("b").substr(F.lit(1), i)) & (F.col("a").substr(i, F.lit(1)) == "/"))
    return ends.select(F.substring("a", 1, F.coalesce(F.array_max(at), F.lit(0))).alias("prefix"))


@query("""select o_orderkey, (floor(t / 86400))::bigint || 'd ' || lpad((floor(t % 86400 / 3600))::bigint::varchar, 2, '0') || 'h ' || lpad((floor(t % 3600 / 60))::bigint::varchar, 2, '0') || 'm ' || lpad((t % 60)::bigint::varchar, 2, '0') || 's' as lasts from (select o_orderkey, floor(o_totalprice)::bigint as t from orders)""")
def duration_formatting(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", text.duration_text(F.col("o_totalprice")).alias("lasts"))


@query(f"""with {MANIFEST} select len(conversations)::int as n_turns, count(*) as n, round(avg(list_sum(list_transform(conversations, lambda t: length(t."value")))), 4) as chars from manifest group by all""")
def conversation_shape(spark: SparkSession, d: str) -> DataFrame:
    chars = F.aggregate("conversations", F.lit(0), lambda s, t: s + F.length(t["value"]))
    return manifest(spark, d).groupBy(F.size("conversations").alias("n_turns")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(chars), 4).alias("chars"))
