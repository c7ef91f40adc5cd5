"""Queries on choosing and routing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import selection as S
from .qa_queries import ALIGNED, _aligned
from .tables import query, segments, segments_sql, table


@query("""select l_orderkey, l_linenumber, coalesce((l_orderkey % 50)::double + l_quantity <= o_totalprice / 5000 + 0.5, false) as inside from lineitem join orders on l_orderkey = o_orderkey""")
def segments_inside_files(spark: SparkSession, d: str) -> DataFrame:
    """Line items as segments of files that are as long as their order's price says."""
    l, o = table(spark, d, "lineitem"), table(spark, d, "orders")  # noqa: E741
    both = l.join(o, l["l_orderkey"] == o["o_orderkey"])
    return both.select("l_orderkey", "l_linenumber", S.inside_file((F.col("l_orderkey") % 50).cast("double"), F.col("l_quantity"), F.col("o_totalprice") / 5000).alias("inside"))


@query("""select c_custkey, c_custkey in (select o_custkey from orders) as found from customer""")
def files_in_listing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("a/"), "c_custkey").alias("path"))
    there, missing = S.existing(rows, table(spark, d, "orders").select(F.concat(F.lit("a/"), "o_custkey").alias("path")), "path")
    return there.select("c_custkey", F.lit(True).alias("found")).unionByName(missing.select("c_custkey", F.lit(False).alias("found")))


@query("""with l as (select 'new/' || o_custkey as p from orders where o_orderkey % 2 = 0 union select 'old/' || o_custkey from orders)
select c_custkey, case when 'new/' || c_custkey in (select p from l) then 'new/' || c_custkey when 'old/' || c_custkey in (select p from l) then 'old/' || c_custkey end as resolved from customer""")
def resolution_by_priority(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    listing = o.where("o_orderkey % 2 = 0").select(F.concat(F.lit("new/"), "o_custkey").alias("path")).unionByName(o.select(F.concat(F.lit("old/"), "o_custkey").alias("path")))
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("path"))
    return S.first_existing(rows, listing, "path", ["new/", "old/"]).select("c_custkey", "resolved")


@query(f"""with {segments_sql()}, p as (select recording, max("end") - min("start") as last, count(*) as n, sum("end" - "start") as d from segments group by recording) select recording, coalesce(d / last >= 0.01 and n >= 3, false) as kept from p""")
def alignment_coverage(spark: SparkSession, d: str) -> DataFrame:
    per = segments(spark, d).groupBy("recording").agg((F.max("end") - F.min("start")).alias("last"), F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("d"))
    return per.select("recording", S.aligned_enough(F.col("d"), F.col("last"), F.col("n"), 0.01).alias("kept"))


@query("""select doc_id, lang <> 'xx' and doc_id % 7 <> 0 and not regexp_matches(text || case when doc_id % 11 = 0 then '漢' else '' end, '[\\x{4e00}-\\x{9fff}]') as kept from documents""")
def finished_answers(spark: SparkSession, d: str) -> DataFrame:
    finish = F.when((F.col("lang") != "xx") & (F.col("doc_id") % 7 != 0), "stop").otherwise("length")
    said = F.concat("text", F.when(F.col("doc_id") % 11 == 0, "漢").otherwise(""))
    return table(spark, d, "documents").select("doc_id", S.usable_answer(finish, said).alias("kept"))


@query("""select doc_id, case when doc_id % 2 = 0 then cur when doc_id % 4 = 0 then 'test' when doc_id % 4 = 1 and cur <> 'dev' then 'train' else cur end as split from (select doc_id, case doc_id % 3 when 0 then 'train' when 1 then 'dev' else 'test' end as cur from documents)""")
def split_routing(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    cur = F.when(i % 3 == 0, "train").when(i % 3 == 1, "dev").otherwise("test")
    path = F.when(i % 4 == 0, "a/test/x").when(i % 4 == 1, "a/dev/x").otherwise("a/b/x")
    subset = F.when(i % 2 == 0, "other").otherwise("celebs")
    return table(spark, d, "documents").select("doc_id", S.routed_split(cur, subset, path, ["celebs"]).alias("split"))


@query("""with p as (select p_size as k, 'part' as s, min(p_name) as v from part group by 1 union all select s_nationkey, 'supplier', min(s_name) from supplier group by 1 union all select c_nationkey, 'customer', min(c_name) from customer group by 1)
select k, string_agg(s || '=' || v, ';' order by s) as found from p group by k""")
def same_key_collect(spark: SparkSession, d: str) -> DataFrame:
    sources = {"part": ("part", "p_size", "p_name"), "supplier": ("supplier", "s_nationkey", "s_name"), "customer": ("customer", "c_nationkey", "c_name")}
    tables = {s: table(spark, d, t).select(F.col(k).cast("long").alias("k"), F.col(v).alias("v")) for s, (t, k, v) in sources.items()}
    return S.collected_by_key(tables, "k", "v").select("k", F.array_join(F.transform(F.map_entries("found"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("found"))


@query("""select doc_id, coalesce('q' || quality, source) as source from documents left join (select doc_id, min(quality) as quality from labels group by doc_id) using (doc_id)""")
def default_where_missing(spark: SparkSession, d: str) -> DataFrame:
    new = table(spark, d, "labels").select("doc_id", F.concat(F.lit("q"), "quality").alias("source"))
    return S.with_default(table(spark, d, "documents").select("doc_id", "source"), new, "doc_id", "source")


@query("""select c_custkey, coalesce(case when n_regionkey % 2 = 0 then 100 + n_regionkey end, 512)::int as batch, coalesce(case when n_regionkey > 2 then n_name end, 'greedy') as decoding from customer left join nation on c_nationkey = n_nationkey""")
def dataset_overrides(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_regionkey") % 2 == 0, (100 + F.col("n_regionkey")).cast("int")).alias("batch"), F.when(F.col("n_regionkey") > 2, F.col("n_name")).alias("decoding"))
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return S.overridden(rows, n, "c_nationkey", ["batch", "decoding"], {"batch": 512, "decoding": "greedy"}).drop("c_nationkey")


@query("""select user_id, sum(n)::bigint as kept, 0::bigint as discarded from (select user_id, event_type, count(*) as n from events group by all) group by user_id""")
def diagnostic_sums(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.col("event_type").alias("k"), F.struct(F.col("n").alias("kept"), F.lit(None).cast("long").alias("discarded")).alias("v"))
    return S.summed_states(per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(entry)).alias("e")), "user_id", "e", ["kept", "discarded"])


@query("""with k as (select o_custkey as m, count(*) as n, sum(o_orderkey)::bigint as p from orders group by 1) select c_nationkey as split, case when count(*) = count(n) then sum(n)::bigint end as n, case when count(*) = count(n) then sum(p)::bigint end as p, count(*) = count(n) as complete
from customer left join k on m = c_custkey group by c_nationkey""")
def split_statistics_reuse(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("m")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("long").alias("p"))
    return S.reused_statistics(table(spark, d, "customer").select(F.col("c_nationkey").alias("split"), F.col("c_custkey").alias("m")), known, "split", "m", ["n", "p"])


@query("""select doc_id, least(a, b) as low, greatest(a, b) as high, a as first from (select doc_id, case lang when 'en' then 0 when 'fr' then 1 when 'de' then 2 else 99 end as a,
 case when doc_id % 2 = 0 then 1 else case lang when 'en' then 0 when 'fr' then 1 when 'de' then 2 else 99 end end as b from documents)""")
def label_order(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("doc_id") % 2 == 0, F.concat(F.upper("lang"), F.lit("→fr"))).otherwise(F.concat(F.lit(" "), "lang"))
    return table(spark, d, "documents").select("doc_id", S.language_order(key, {"en": 0, "fr": 1, "de": 2}).alias("o")).select("doc_id", "o.low", "o.high", "o.first")


@query(r"""with t as (select conv_id, turn, regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), case when turn % 2 = 0 then '[.,;:!?…]+$' else '^$' end, '') as t from conversations), n as (select *, lag(t) over (partition by conv_id order by turn) as b from t where t <> '')
select conv_id, string_agg(case when b is null then '' when not regexp_matches(b, '[.,;:!?…]$') and regexp_matches(t, '^\p{Lu}') then '. ' else ' ' end || t, '' order by turn) as text from n group by conv_id""")
def cue_joiner(spark: SparkSession, d: str) -> DataFrame:
    plain = F.trim(F.regexp_replace("text", r"\s+", " "))
    cue = F.when(F.col("turn") % 2 == 0, F.regexp_replace(plain, "[.,;:!?…]+$", "")).otherwise(plain)
    cues = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("t")))), lambda s: s["t"]).alias("cues"))
    return cues.select("conv_id", S.joined_cues(F.col("cues")).alias("text"))


@query(rf"""with {ALIGNED}, s as (select item_id, list_filter(words[3:7], lambda w: regexp_matches(w.word, '[\p{{L}}\p{{N}}]')) as own from aligned),
c as (select item_id, coalesce(list_filter(own, lambda w: length(regexp_replace(w.word, '[^\p{{L}}\p{{N}}]', '', 'g')) >= 4)[1], own[1]) as w from s)
select item_id, trim(w.word, ' "''.,;:!?()[]') as word, w."start" as "start" from c""")
def representative_words(spark: SparkSession, d: str) -> DataFrame:
    r = S.representative(F.col("words"), F.lit(2), F.lit(6))
    return _aligned(spark, d).select("item_id", r["word"].alias("word"), r["start"].alias("start"))
