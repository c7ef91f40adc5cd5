"""Queries of §2.13 and §2.14 on evaluation results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import evaluation as E
from .tables import query, table

RESULTS = """results as (select l_suppkey % 10 as dataset, (l_linenumber * 1000)::bigint as step, metric, round(avg(case when metric = 'wer' then l_discount else l_tax * 10 end), 6) as value, l_suppkey % 2 as experiment
 from lineitem, (values ('wer'), ('bleu')) m(metric) group by all)"""


def _results(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").select((F.col("l_suppkey") % 10).alias("dataset"), (F.col("l_linenumber") * 1000).cast("long").alias("step"), "l_discount", "l_tax", (F.col("l_suppkey") % 2).alias("experiment"))  # noqa: E741
    g = l.groupBy("dataset", "step", "experiment").agg(F.round(F.avg("l_discount"), 6).alias("wer"), F.round(F.avg(F.col("l_tax") * 10), 6).alias("bleu"))
    return g.select("dataset", "step", F.expr("stack(2, 'wer', wer, 'bleu', bleu) as (metric, value)"), "experiment")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each text with a damaged copy of itself: as reference and hypothesis."""
    words = X.words(F.col("text"))
    damaged = F.filter(F.transform(words, lambda w, i: F.when(i % 11 == 3, F.lit("X")).when(i % 13 != 5, w)), lambda w: w.isNotNull())
    return table(spark, d, "benchmark").select("item_id", "text", F.array_join(damaged, " ").alias("hyp"))


@query()
def word_error_rate(spark: SparkSession, d: str) -> DataFrame:
    return E.error_rates(E.with_word_errors(_pairs(spark, d), "text", "hyp"))


PAIRS = """w as (select item_id, text, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') as r from benchmark),
p as (select item_id, text, r, list_filter(list_transform(range(1, len(r) + 1), lambda i: case when (i - 1) % 11 = 3 then 'X' when (i - 1) % 13 <> 5 then r[i] end), lambda x: x is not null) as h from w)"""


@query(f"""with {PAIRS}, n as (select unnest(range(1, 5)) as n), hg as (select n, item_id, unnest(list_transform(range(1, greatest(len(h) - n + 2, 1)), lambda i: lower(array_to_string(h[i:i + n - 1], ' ')))) as g from p, n),
rg as (select n, item_id, unnest(list_transform(range(1, greatest(len(r) - n + 2, 1)), lambda i: lower(array_to_string(r[i:i + n - 1], ' ')))) as g from p, n),
hc as (select n, item_id, g, count(*) as h from hg group by all), rc as (select n, item_id, g, count(*) as r from rg group by all),
m as (select n, sum(least(h, coalesce(r, 0)))::bigint as matches, sum(h)::bigint as total from hc left join rc using (n, item_id, g) group by n), l as (select sum(len(r)) as rl, sum(len(h)) as hl from p)
select n::int as n, matches, total, round(matches / total, 8) as precision, round(exp(avg(ln(matches / total)) over ()) * case when hl >= rl then 1.0 else exp(1 - rl / hl) end, 8) as bleu from m, l""")
def bleu_precisions(spark: SparkSession, d: str) -> DataFrame:
    out = E.bleu(_pairs(spark, d), "item_id", "text", "hyp")
    return out.select("n", "matches", "total", F.round("precision", 8).alias("precision"), F.round("bleu", 8).alias("bleu"))


@query(f"""with {PAIRS}, s as (select item_id, list_distinct(list_transform(r, lambda x: lower(x))) as a, list_distinct(list_transform(h, lambda x: lower(x))) as b from p)
select item_id, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 8) as similarity, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) >= 0.8 as similar from s""")
def word_jaccard(spark: SparkSession, d: str) -> DataFrame:
    j = X.jaccard(F.col("text"), F.col("hyp"))
    return _pairs(spark, d).select("item_id", F.round(j, 8).alias("similarity"), (j >= 0.8).alias("similar"))


@query(f"""with {PAIRS} select count(*) as n, min(len(h))::int as low, max(len(h))::int as high, round(avg(len(h)), 6) as mean, round(sum(len(h)) / sum(len(r)), 6) as ratio, count(*) filter (where r = h) as exact from p""")
def generation_statistics(spark: SparkSession, d: str) -> DataFrame:
    h, r = F.size(X.words(F.col("hyp"))), F.size(X.words(F.col("text")))
    return _pairs(spark, d).agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("low"), F.max(h).alias("high"), F.round(F.avg(h), 6).alias("mean"), F.round(F.sum(h) / F.sum(r), 6).alias("ratio"), F.count(F.when(X.words(F.col("hyp")) == X.words(F.col("text")), 1)).alias("exact"))


BEST = "select dataset, experiment, metric, step, value from (select *, row_number() over (partition by dataset, experiment, metric order by case when metric = 'wer' then value else -value end, step) as rn from results) where rn = 1"


@query(f"with {RESULTS} {BEST}")
def best_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    return E.best_step(_results(spark, d), "dataset", "experiment")


@query(f"""with {RESULTS}, g as (select dataset, experiment, metric, arg_min(value, step) as "first", arg_max(value, step) as "last", count(*) as n from results group by all)
select *, case when ("last" - "first") * (case when metric = 'wer' then -1 else 1 end) > 0 then 'better' when "last" = "first" then 'same' else 'worse' end as trend from g""")
def metric_trends(spark: SparkSession, d: str) -> DataFrame:
    return E.trends(_results(spark, d), "dataset", "experiment")


@query(f"""with {RESULTS}, m as (select metric, step, avg(value) as mean from results group by all) select metric, step, round(case when metric = 'wer' then f - mean else mean - f end / abs(f) * 100, 6) as change from (select *, first_value(mean) over (partition by metric order by step) as f from m)""")
def percent_change(spark: SparkSession, d: str) -> DataFrame:
    return E.percent_change(_results(spark, d)).select("metric", "step", F.round("change", 6).alias("change"))


@query(f"""with {RESULTS}, b as (select experiment, coalesce(sum(m) over (order by experiment rows between unbounded preceding and 1 preceding), 0) as b from (select experiment, max(step) as m from results group by all)) select dataset, experiment, metric, step, (step + b)::bigint as "at" from results join b using (experiment)""")
def step_concatenation(spark: SparkSession, d: str) -> DataFrame:
    return E.concatenated_steps(_results(spark, d)).select("dataset", "experiment", "metric", "step", F.col("at").cast("long").alias("at"))


@query(f"""with {RESULTS}, w as (select d as dataset, metric from range(0, 20) t(d), (values ('wer'), ('bleu'), ('rouge')) m(metric)) select dataset::bigint as dataset, metric from w anti join results using (dataset, metric)""")
def metric_cache_check(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.range(20).select(F.col("id").alias("dataset"), F.explode(F.array(*map(F.lit, ("wer", "bleu", "rouge")))).alias("metric"))
    return E.missing_metrics(wanted, _results(spark, d))


@query("""select event_type, round(sum(value) / (count(*) * 0.1), 6) as rtfx from events group by event_type""")
def real_time_factor(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.sum("value") / (F.count(F.lit(1)) * 0.1), 6).alias("rtfx"))


@query(f"""with {RESULTS}, a as (select dataset, metric, step, value from results where experiment = 0), b as (select dataset, metric, step, value from results where experiment = 1)
select metric, step, count(*) as n, round(avg(b.value - a.value), 6) as diff from a join b using (metric, step) where a.dataset % 2 = 0 and b.dataset = a.dataset + 1 group by all""")
def cross_checkpoint_compare(spark: SparkSession, d: str) -> DataFrame:
    r = _results(spark, d)
    a = r.where("experiment = 0").select((F.col("dataset") + 1).alias("dataset"), "metric", "step", F.col("value").alias("a"))
    b = r.where("experiment = 1").select("dataset", "metric", "step", F.col("value").alias("b"))
    return a.join(b, ["dataset", "metric", "step"]).groupBy("metric", "step").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("b") - F.col("a")), 6).alias("diff"))


@query("""select p_partkey, case when p_type like '%BRASS%' then 'asr' when p_type like '%TIN%' then 'ast' else 'other' end as kind, case when p_size > 40 then 'long' else 'short' end as length_class from part""")
def dataset_classification(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("p_type").contains("BRASS"), "asr").when(F.col("p_type").contains("TIN"), "ast").otherwise("other")
    return table(spark, d, "part").select("p_partkey", kind.alias("kind"), F.when(F.col("p_size") > 40, "long").otherwise("short").alias("length_class"))


@query("""select n_nationkey, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) as label, md5(n_name) as hash, round_even(n_nationkey / 8.0, 1) as even, round(ln(n_nationkey + 1), 8) as ln1, round(log2(n_nationkey + 1), 8) as lg2 from nation""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, d, "nation").select("n_nationkey", X.capitalised(F.lower("n_name")).alias("label"), F.md5("n_name").alias("hash"), F.bround(n / 8.0, 1).alias("even"), F.round(F.log(n + 1), 8).alias("ln1"), F.round(F.log2(n + 1), 8).alias("lg2"))


@query("""select event_id, (props->>'$.k')::bigint as k, '{"user":' || user_id || ',"k":' || (props->>'$.k') || '}' as packed from events""")
def json_functions(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return table(spark, d, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("user_id").alias("user"), k.alias("k"))).alias("packed"))
