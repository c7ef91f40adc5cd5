"""Queries of §2.3, §2.4 and §2.11 on manifest records."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import turns as T
from ..operators.ranking import numbered
from .tables import MANIFEST, manifest, query, table

U = "(('0x' || substr(md5({}), 1, 8))::ubigint / 4294967296.0)"


def u_sql(seed: str, *ids: str) -> str:
    """hash_u in SQL."""
    return U.format(f"concat_ws(':', '{seed}', " + ", ".join(f"{i}::varchar" for i in ids) + ")")


def flt(x: str, cond: str) -> str:
    return f"list_filter({x}, lambda t: {cond})"


ASSIST = flt("conversations", "t.\"from\" = 'Assistant' and t.\"type\" = 'text'")
USER = flt("conversations", "t.\"from\" = 'User' and t.\"type\" = 'text'")
AUDIO = flt("conversations", "t.\"type\" = 'audio'")


@query(f'with {MANIFEST} select conv_id, {ASSIST}[-1]."value" as answer, {ASSIST}[1]."value" as first_answer, {USER}[1]."value" as prompt from manifest')
def turn_accessors(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("conversations")
    return manifest(spark, d).select("conv_id", T.last_assistant_text(c).alias("answer"), T.first_assistant_text(c).alias("first_answer"), T.first_user_text(c).alias("prompt"))


@query(f'with {MANIFEST} select conv_id, {AUDIO}[1]."value" as audio, round({AUDIO}[1].duration, 6) as duration, {AUDIO}[1]."offset" as "offset" from manifest')
def first_audio_turn(spark: SparkSession, d: str) -> DataFrame:
    a = T.first_audio(F.col("conversations"))
    return manifest(spark, d).select("conv_id", a["value"].alias("audio"), F.round(a["duration"], 6).alias("duration"), a["offset"].alias("offset"))


def _flat(turns):  # noqa: ANN001, ANN202
    return F.array_join(F.transform(turns, lambda t: F.concat_ws("|", t["from"], t["type"], t["value"])), "\n")


def flat_sql(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda t: concat_ws('|', t.\"from\", t.\"type\", t.\"value\")), chr(10))"


@query(f"""with {MANIFEST}, p as (select conv_id, list_concat({USER}, {flt("conversations", "not (t.\"from\" = 'User' and t.\"type\" = 'text')")}) as x from manifest)
select conv_id, {flat_sql("x")} as turns from p""")
def prompt_first_order(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("conv_id", _flat(T.prompt_first(F.col("conversations"))).alias("turns"))


@query("""select conv_id, string_agg(concat_ws('|', case when role = 'assistant' then 'Assistant' else 'User' end, case when role = 'system' then 'audio' else 'text' end,
 case when role = 'assistant' and turn = last_turn then text || ' [fixed]' else text end), chr(10) order by turn) as turns
from (select *, max(case when role = 'assistant' then turn end) over (partition by conv_id) as last_turn from conversations) group by conv_id""")
def set_answer_text(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("conversations")
    return manifest(spark, d).select("conv_id", _flat(T.set_last_assistant_text(c, F.concat(T.last_assistant_text(c), F.lit(' [fixed]')))).alias("turns"))


@query(f"with {MANIFEST} select conv_id, 'User|text|Transcribe.' || chr(10) || {flat_sql('conversations')} as turns from manifest")
def prepend_prompt_turn(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("conv_id", _flat(T.with_prompt(F.col("conversations"), F.lit("Transcribe."))).alias("turns"))


@query(f"""with {MANIFEST}, q as (select conv_id, conversations, len({USER}) as n, ['Listen.', 'Write it down.', 'What is said?'][floor({u_sql("prompt", "conv_id")} * 3)::int + 1] as p from manifest)
select conv_id, case when n > 0 then {flat_sql("conversations")} else 'User|text|' || p || chr(10) || {flat_sql("conversations")} end as turns from q""")
def attach_context(spark: SparkSession, d: str) -> DataFrame:
    prompt = hashing.pick(["Listen.", "Write it down.", "What is said?"], hashing.hash_u("prompt", "conv_id"))
    return manifest(spark, d).select("conv_id", _flat(T.attach_prompt(F.col("conversations"), prompt)).alias("turns"))


@query(f"""with {MANIFEST} select conv_id from manifest where len(conversations) > 0 and conversations[1]."from" = 'User' and conversations[-1]."from" = 'Assistant'""")
def valid_conversations(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).where(T.valid(F.col("conversations"))).select("conv_id")


@query(f"with {MANIFEST} select conv_id, {flat_sql('conversations')} as turns from manifest")
def messages_round_trip(spark: SparkSession, d: str) -> DataFrame:
    back = T.from_messages(T.to_messages(F.col("conversations")))
    return manifest(spark, d).select("conv_id", _flat(back).alias("turns"))


@query(f"""with {MANIFEST} select conv_id, array_to_string(list_transform(conversations, lambda t: t."from" || '|' || t."type" || '|' || case when t."type" <> 'text' then t."value"
 when t."from" = 'User' then 'Q: ' || t."value" else t."value" || ' (end)' end), chr(10)) as turns from manifest""")
def rewrite_templates(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("conv_id", _flat(T.rewrite_by_template(F.col("conversations"), "Q: {}", "{} (end)")).alias("turns"))


@query("""select conv_id, string_agg(case when role = 'assistant' then 'Assistant' else 'User' end || ': ' || text, chr(10) order by turn) as transcript from conversations group by conv_id""")
def transcript_rendering(spark: SparkSession, d: str) -> DataFrame:
    return manifest(spark, d).select("conv_id", T.rendered(F.col("conversations")).alias("transcript"))


@query("""select coalesce(nullif(case when doc_id % 7 = 0 then '' else 'doc' || doc_id end, ''), 'fallback_' || doc_id) as id, lang as language, '{"source":"' || source || '","n_chars":' || n_chars || '}' as extra from documents""")
def uniform_records(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("key", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.concat(F.lit("doc"), F.col("doc_id"))))
    out = T.uniform(docs, "key", F.concat(F.lit("fallback_"), F.col("doc_id")), "text", "lang", ["source", "n_chars"])
    return out.select("id", "language", "extra")


@query("""select page_id, list_filter(string_split(url, '/'), lambda p: p in ('en', 'fr', 'de', 'es'))[-1] as lang,
 case when starts_with(url, 'https://') then 'store/' || substr(url, 9) else 'store//' || string_split(url, '/')[-1] end as moved from pages""")
def path_language_and_rebase(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", T.path_language(u, ["en", "fr", "de", "es"]).alias("lang"), T.rebased(u, "https://", "store/").alias("moved"))


@query("""with p as (select distinct url as path, string_split(url, '/')[-1] as base from pages), c as (select distinct replace(url, 'https://', 'store/') as cand, string_split(url, '/')[-1] as base from pages),
s as (select path, cand, (select coalesce(min(i) - 1, least(len(a), len(b))) from (select unnest(range(1, least(len(a), len(b)) + 1)) as i) where a[i] <> b[i]) as score
 from (select path, cand, list_reverse(string_split(path, '/')) as a, list_reverse(string_split(cand, '/')) as b from p join c using (base)))
select path, min(cand) as found from (select *, max(score) over (partition by path) as m from s) where score = m group by path""")
def path_remap(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    moved = pages.select(F.replace("url", F.lit("https://"), F.lit("store/")).alias("cand")).distinct()
    out = T.best_suffix(pages.select(F.col("url").alias("path")).distinct(), "path", moved, "cand")
    return out.withColumnRenamed("cand", "found")


@query("""select p_partkey, coalesce(case when p_size <> 0 and p_size % 5 <> 0 then p_size end, case when p_retailprice <> 0 then p_retailprice::int end)::int as size, coalesce(nullif(case when p_size % 3 = 0 then '' else p_brand end, ''), p_name) as label from part""")
def alias_probing(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    size = T.first_truthy(T.without_zero(F.when(F.col("p_size") % 5 != 0, F.col("p_size"))), T.without_zero(F.bround("p_retailprice", 0).cast("int")))
    label = T.first_truthy(T.without_empty(F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand"))), F.col("p_name"))
    return p.select("p_partkey", size.alias("size"), label.alias("label"))


@query("""select conv_id, unnest(generate_series(1, 3)) as q, 'conv' || conv_id || '_q' || unnest(generate_series(1, 3)) as id from (select distinct conv_id from conversations)""")
def unique_ids_with_suffix(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3))))
    q = F.row_number().over(Window.partitionBy("conv_id").orderBy("k")).cast("long")
    return rows.select("conv_id", q.alias("q"), F.concat(F.lit("conv"), "conv_id", F.lit("_q"), q).alias("id"))


@query("""select doc_id, lang, source from documents where length(trim(text)) > 0 and n_chars / 15.0 >= 0.1 and not (n_chars / 15.0 > 60 and length(text) / (n_chars / 15.0) < 1) and n_chars / 15.0 <= 600""")
def content_filters(spark: SparkSession, d: str) -> DataFrame:
    dur = F.col("n_chars") / 15.0
    docs = table(spark, d, "documents")
    return docs.where((F.length(F.trim("text")) > 0) & (dur >= 0.1) & ~((dur > 60) & (F.length("text") / dur < 1)) & (dur <= 600)).select("doc_id", "lang", "source")


@query("""select d.doc_id from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1) and not exists (select 1 from labels l where l.doc_id = d.doc_id and toxic = 1)""")
def keep_list_and_blacklist(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    return table(spark, d, "documents").select("doc_id").join(labels.where("quality = 1"), "doc_id", "left_semi").join(labels.where("toxic = 1"), "doc_id", "left_anti")


@query("""select event_id from events where coalesce(case when user_id % 2 = 0 then 5.0 end, '-infinity'::double) <= value and value <= coalesce(case when user_id % 3 = 0 then 60.0 end, 'infinity'::double)""")
def duration_band(spark: SparkSession, d: str) -> DataFrame:
    low = F.coalesce(F.when(F.col("user_id") % 2 == 0, 5.0), F.lit(float("-inf")))
    high = F.coalesce(F.when(F.col("user_id") % 3 == 0, 60.0), F.lit(float("inf")))
    return table(spark, d, "events").where(F.col("value").between(low, high)).select("event_id")


#: Markers of anonymised texts in these tables, and what is stripped in place.
ANONYMISED, GARBAGE = [r"\b[A-Z]pers\b", r"\[(?:name|email|phone)\]", "https?://", "@"], [r"[*%$&]{3,}", r"\bthe the\b"]


@query(r"""with c as (select doc_id, text, regexp_replace(regexp_replace(text, '[*%$&]{3,}', '', 'g'), '\bthe the\b', '', 'g') as bare from documents)
select doc_id, regexp_matches(text, '(\b[A-Z]pers\b)|(\[(name|email|phone)\])|https?://|@') as anonymised, case when bare = text then text else trim(regexp_replace(bare, ' {2,}', ' ', 'g'), ' ') end as cleaned from c""")
def anonymisation_and_garbage(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    docs = table(spark, d, "documents")
    return docs.select("doc_id", T.matches_any(t, ANONYMISED).alias("anonymised"), T.without_garbage(t, GARBAGE).alias("cleaned"))


@query("""with q as (select text from conversations where role = 'user' group by text having count(distinct conv_id) >= 2) select distinct conv_id from conversations where conv_id not in (select conv_id from conversations where role = 'user' and text in (select text from q))""")
def drop_by_question(spark: SparkSession, d: str) -> DataFrame:
    """Conversations without a question of a list; the list holds those that come in several conversations."""
    asked = table(spark, d, "conversations").where("role = 'user'")
    listed = asked.groupBy("text").agg(F.countDistinct("conv_id").alias("n")).where("n >= 2").select("text")
    return T.without_questions(manifest(spark, d), listed, "text").select("conv_id")


@query("""select conv_id, count(*) as n_turns, count(distinct role) as n_roles from conversations group by conv_id having count(*) filter (where role in ('assistant')) >= 2""")
def task_mix_filter(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("conversations")
    roles = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), F.countDistinct("role").alias("n_roles"))
    return manifest(spark, d).where(F.size(F.filter(c, lambda t: t["from"] == "Assistant")) >= 2).select("conv_id").join(roles, "conv_id")


@query("""select doc_id from documents where contains(lower(text), 'licen')""")
def text_search(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.lower("text").contains("licen")).select("doc_id")


@query("""select doc_id, case when h < 50 then 'test' when h < 100 then 'validation' else 'train' end as split from (select doc_id, (('0x' || md5(doc_id::varchar))::uhugeint % 1000)::bigint as h from documents)""")
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", hashing.split_for(F.col("doc_id").cast("string")).alias("split"))


@query("""select c_custkey, case when c_mktsegment in ('BUILDING') then 'test' when regexp_matches(c_name, '[05]$') then 'dev' else 'train' end as split from customer""")
def fixed_list_split(spark: SparkSession, d: str) -> DataFrame:
    split = F.when(F.col("c_mktsegment").isin("BUILDING"), "test").when(F.col("c_name").rlike("[05]$"), "dev").otherwise("train")
    return table(spark, d, "customer").select("c_custkey", split.alias("split"))


@query(f"""select user_id, case when row_number() over (order by {u_sql("dev", "user_id")}, user_id) <= ceil(0.1 * count(*) over ()) then 'dev' else 'train' end as split from (select distinct user_id from events)""")
def speaker_disjoint_split(spark: SparkSession, d: str) -> DataFrame:
    speakers = table(spark, d, "events").select("user_id").distinct()
    n = speakers.count()
    placed = numbered(speakers.withColumn("all", F.lit(0)), ["all"], hashing.hash_u("dev", "user_id"), ["user_id"], "place", n)
    return placed.select("user_id", F.when(F.col("place") < math.ceil(0.1 * n), "dev").otherwise("train").alias("split"))


@query("""select conv_id, user_text as question, answer from (select conv_id, text as user_text, turn, lead(text) over w as answer, lead(role) over w as next_role, role,
 row_number() over (partition by conv_id, text order by turn) as nth from conversations window w as (partition by conv_id order by turn)) where role = 'user' and next_role = 'assistant' and nth = 1""")
def question_answer_pairs(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, d, "conversations").withColumn("answer", F.lead("text").over(w)).withColumn("next_role", F.lead("role").over(w))
    t = t.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "text").orderBy("turn")))
    return t.where("role = 'user' and next_role = 'assistant' and nth = 1").select("conv_id", F.col("text").alias("question"), "answer")


@query(f"""with v as (select user_id, event_type, sum(case when value < 20 then 1.0 when value < 60 then 0.5 else 0.1 end) as votes from events group by all),
r as (select *, row_number() over (partition by user_id order by votes desc, event_type) as rn, lead(votes) over (partition by user_id order by votes desc, event_type) as second from v)
select user_id, event_type as answer, round(votes::double, 6) as votes from r where rn = 1 and votes > 1 and (second is null or abs(votes - second) > 1e-9)""")
def weighted_votes(spark: SparkSession, d: str) -> DataFrame:
    weight = F.when(F.col("value") < 20, 1.0).when(F.col("value") < 60, 0.5).otherwise(0.1)
    votes = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum(weight).alias("votes"))
    w = Window.partitionBy("user_id").orderBy(F.desc("votes"), "event_type")
    ranked = votes.withColumn("rn", F.row_number().over(w)).withColumn("second", F.lead("votes").over(w))
    return ranked.where((F.col("rn") == 1) & (F.col("votes") > 1) & (F.col("second").isNull() | (F.abs(F.col("votes") - F.col("second")) > 1e-9))).select("user_id", F.col("event_type").alias("answer"), F.round("votes", 6).alias("votes"))


@query("""select conv_id, turn, text from conversations where turn between 1 and 3""")
def query_spans(spark: SparkSession, d: str) -> DataFrame:
    c = manifest(spark, d).select("conv_id", F.posexplode(F.slice("conversations", 2, 3)).alias("k", "t"))
    return c.select("conv_id", (F.col("k") + 1).cast("long").alias("turn"), F.col("t.value").alias("text"))


@query("""select n_nationkey, field, value from (select n_nationkey, unnest(['name', 'region']) as field, unnest([n_name, n_regionkey::varchar]) as value from nation)""")
def caption_explode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select("n_nationkey", F.expr("stack(2, 'name', n_name, 'region', cast(n_regionkey as string)) as (field, value)"))


@query(f"""select doc_id, (row_number() over (order by {u_sql("shuffle", "doc_id")}, doc_id) - 1) % 8 as shard from documents""")
def reshuffle_shards(spark: SparkSession, d: str) -> DataFrame:
    """Places along a hash order, dealt to 8 shards in turn; places are counted by ranges of the hash, not in one task."""
    docs = table(spark, d, "documents").select("doc_id").withColumn("u", hashing.hash_u("shuffle", "doc_id")).withColumn("bin", F.floor(F.col("u") * 1024))
    before = docs.groupBy("bin").count().select("bin", F.coalesce(F.sum("count").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("bin").orderBy("u", "doc_id")) - 1
    return docs.join(before, "bin").select("doc_id", F.pmod(place, F.lit(8)).alias("shard"))


@query(f"""with p as (select user_id, event_id, row_number() over (partition by user_id order by {u_sql("pair", "event_id")}, event_id) as r from events)
select a.user_id, a.event_id as first_id, b.event_id as second_id from p a join p b on a.user_id = b.user_id and b.r = a.r + 1 where a.r % 2 = 1""")
def positive_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id")
    return T.drawn_pairs(e, "user_id", "event_id", hashing.hash_u("pair", "event_id"))


@query(f"""select c_custkey, case when c_nationkey < 5 then 'q' else 'r' end as kind, case when {u_sql("task", "c_custkey")} < 0.5 then 'asr' when {u_sql("task", "c_custkey")} < 0.8 then 'ast' else 'qa' end as task,
 least(50, greatest(1, floor(exp({u_sql("size", "c_custkey")} * (ln(51) - ln(1))))))::int as n from customer""")
def weighted_draws(spark: SparkSession, d: str) -> DataFrame:
    task = hashing.weighted_pick([("asr", 0.5), ("ast", 0.3), ("qa", 0.2)], hashing.hash_u("task", "c_custkey"))
    return table(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") < 5, "q").otherwise("r").alias("kind"), task.alias("task"), hashing.list_size("loguniform", hashing.hash_u("size", "c_custkey"), 1, 50).alias("n"))


@query(f"""select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by pow({u_sql("aes", "event_id")}, 1.0 / (value + 1)) desc, event_id) as r from events) where r <= 3""")
def weighted_sampling(spark: SparkSession, d: str) -> DataFrame:
    key = F.pow(hashing.hash_u("aes", "event_id"), 1.0 / (F.col("value") + 1))
    e = table(spark, d, "events").select("user_id", "event_id", key.alias("key"))
    return T.best_of(e, ["user_id"], [F.desc("key"), F.col("event_id")], 3, F.col("event_id")).select("user_id", "event_id")


@query("""with s as (select user_id, event_type, event_id, ts, row_number() over (partition by user_id, event_type order by ts, event_id) as k from events)
select user_id, ((row_number() over (partition by user_id order by k, event_type, event_id) - 1) // 5)::bigint as chunk, event_id from s""")
def answer_spread_chunks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return T.spread_chunks(e, "user_id", "event_type", ["ts", "event_id"], F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000), 5).select("user_id", "chunk", "event_id")


@query(f"""select conv_id, turn, role, not (role = lag(role, 2) over (partition by conv_id order by turn) and {u_sql("dup", "conv_id", "turn")} < 0.5) is true as keep from conversations""")
def instruction_dedup(spark: SparkSession, d: str) -> DataFrame:
    again = F.col("role") == F.lag("role", 2).over(Window.partitionBy("conv_id").orderBy("turn"))
    return table(spark, d, "conversations").select("conv_id", "turn", "role", (~F.coalesce(again & (hashing.hash_u("dup", "conv_id", "turn") < 0.5), F.lit(False))).alias("keep"))


@query("""with s as (select lang, count(*)::double as n from documents group by lang), t as (select sum(n) filter (where lang not in ('en')) as rest from s)
select lang, round(case when lang = 'en' then 0.5 else 0.5 * n / rest end, 6) as share from s, t""")
def language_shares(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rest = F.sum(F.when(F.col("lang") != "en", F.col("n"))).over(Window.partitionBy())
    return s.select("lang", F.round(F.when(F.col("lang") == "en", 0.5).otherwise(F.col("n") / rest * 0.5), 6).alias("share"))


@query("""with c as (select lang, avg(case when n_chars > 2000 then 1.0 else 0.0 end) as cover, count(*) * 1.0 / sum(count(*)) over () as w from documents group by lang), k as (select sum(cover * w) as coverage from c)
select round(coverage, 6) as coverage, round(least(1.0, 0.3 / coverage), 6) as chance from k""")
def weighted_coverage(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "documents").groupBy("lang").agg(F.avg(F.when(F.col("n_chars") > 2000, 1.0).otherwise(0.0)).alias("cover"), F.count(F.lit(1)).alias("n"))
    k = c.agg((F.sum(F.col("cover") * F.col("n")) / F.sum("n")).alias("coverage"))
    return k.select(F.round("coverage", 6).alias("coverage"), F.round(F.least(F.lit(1.0), 0.3 / F.col("coverage")), 6).alias("chance"))


@query(f"""with x as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) > 1 as again, row_number() over (order by {u_sql("draw", "event_id")}, event_id) as o from events)
select event_id, again and sum(again::int) over (order by o) > 0.3 * o as refused from x""")
def reuse_budget(spark: SparkSession, d: str) -> DataFrame:
    """Repeats up to a share of the draws so far; the running count is summed by ranges of the draw order."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    first = e.groupBy("user_id").agg(F.min(F.struct("ts", "event_id"))["event_id"].alias("first_id"))
    again = (F.col("event_id") != F.col("first_id")).cast("int")
    e = e.join(first, "user_id").select("event_id", "user_id", "ts", again.alias("again"), hashing.hash_u("draw", "event_id").alias("u"))
    e = e.withColumn("bin", F.floor(F.col("u") * 1024))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = e.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("again").alias("a"))
    sums = sums.select("bin", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("n0"), F.coalesce(F.sum("a").over(upto), F.lit(0)).alias("a0"))
    w = Window.partitionBy("bin").orderBy("u", "event_id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    spent = F.col("a0") + F.sum("again").over(run)
    return e.join(sums, "bin").select("event_id", ((F.col("again") == 1) & (spent > 0.3 * (F.col("n0") + F.row_number().over(w)))).alias("refused"))
