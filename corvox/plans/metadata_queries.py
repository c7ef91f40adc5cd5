"""Queries of §2.1 to §2.5 and §2.10 on metadata, small filters, sinks and the pieces of time-aligned words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import metadata as A
from ..operators import qa as Q
from ..sources import readers as R
from ..sources import writers as W
from ..sources.scratch import scratch
from .qa_queries import ALIGNED, SPOKEN, _aligned, _spoken
from .tables import query, table
from .turn_queries import u_sql


@query("""select user_id, event_id, case event_id % 4 when 0 then 'twenties' when 1 then 'sixties' else '' end as age, case event_id % 3 when 0 then 'Midland' else '' end as accent from events""")
def age_and_accent(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    age = F.when(i % 4 == 0, " Twenties").when(i % 4 == 1, "sixties").when(i % 4 == 2, "young")
    accent = F.when(i % 3 == 0, "Midland,Northern").when(i % 3 == 1, "Fr")
    return table(spark, d, "events").select("user_id", "event_id", A.usable_age(age).alias("age"), A.usable_accent(accent).alias("accent"))


@query("""with i as (select event_id, event_type as city, printf('%08d', 1012020 + user_id % 20) as date from events),
f as (select event_type as city, printf('%08d', 1012020 + user_id % 20) as date, min('/a/' || event_type || '/mp3/council ' || printf('%08d', 1012020 + user_id % 20) || '_' || user_id || '.mp3') as audio from events where user_id % 3 = 0 group by all)
select event_id, case when event_id % 7 = 0 then null else audio end as audio from i left join f using (city, date)""")
def council_audio(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    date = F.format_string("%08d", 1012020 + F.col("user_id") % 20)
    form = F.when(F.col("event_id") % 7 == 0, "_Meeting_").otherwise("CityCouncil_")
    items = e.select("event_id", F.concat("event_type", form, date, F.lit("_X"), F.col("event_id").cast("string")).alias("uid"))
    files = e.where("user_id % 3 = 0").select(F.col("event_type").alias("city"), F.concat(F.lit("/a/"), "event_type", F.lit("/mp3/council "), date, F.lit("_"), F.col("user_id").cast("string"), F.lit(".mp3")).alias("path")).distinct()
    return A.meeting_audio(items, files).select("event_id", "audio")


@query("""select n_name, case when contains(lower(r_name || '/' || n_name), 'united') then 'C' when contains(lower(r_name || '/' || n_name), 'asia') then 'B' when contains(lower(r_name || '/' || n_name), 'an') then 'A' else 'unknown' end as licence from nation join region on n_regionkey = r_regionkey""")
def licence_registry(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    licence = A.policy(F.concat_ws("/", "r_name", "n_name"), [("an", "A"), ("UNITED", "C"), ("Asia", "B"), ("", "X")], "unknown")
    return both.select("n_name", licence.alias("licence"))


@query("""select user_id, event_id, case when event_id % 5 > 0 then event_type || ' ' || event_id end as prompt from events""")
def session_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Prompts written as lines of a key and a text, four of five, and read back for their segments."""
    e, path = table(spark, d, "events"), scratch(spark, "prompts")
    key = F.concat(F.lit("u"), "user_id", F.lit("/mfc/a"), "event_id")
    e.where("event_id % 5 > 0").select(F.concat(key, F.lit(" "), "event_type", F.lit(" "), "event_id").alias("value")).write.text(path)
    segments = e.select("user_id", "event_id", F.concat(F.lit("u"), "user_id").alias("session"), F.concat(F.lit("a"), "event_id").alias("utterance"))
    return A.with_prompts(segments, R.key_text(spark, path)).select("user_id", "event_id", "prompt")


@query("""select event_id from events where value >= 30""")
def long_talks(spark: SparkSession, d: str) -> DataFrame:
    return A.at_least(table(spark, d, "events"), "value", 30.0).select("event_id")


@query("""select conv_id, turn from conversations where length(text) <= 300""")
def short_questions(spark: SparkSession, d: str) -> DataFrame:
    return A.no_longer(table(spark, d, "conversations"), "text").select("conv_id", "turn")


@query("""select doc_id from documents where doc_id % 3 = 0 and trim(source) <> ''""")
def with_genres(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 3
    genres = F.when(k == 0, F.array(F.lit(" "), F.col("source"))).when(k == 1, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return A.with_metadata(table(spark, d, "documents").select("doc_id", genres.alias("genres")), "genres").select("doc_id")


@query("""with n as (select event_type, row_number() over (order by event_type) - 1 as k from (select distinct event_type from events)) select event_id from events join n using (event_type) where k in (0, 3) or event_type = 'view'""")
def chosen_datasets(spark: SparkSession, d: str) -> DataFrame:
    return A.of_datasets(table(spark, d, "events"), "event_type", [0, "view", 3]).select("event_id")


@query("select doc_id, lang from documents")
def gzip_glob_scan(spark: SparkSession, d: str) -> DataFrame:
    """Manifests in gzip files of several folders, found by a pattern."""
    path = scratch(spark, "gz")
    docs = table(spark, d, "documents").select("doc_id", "lang", (F.col("doc_id") % 3).alias("k"))
    for k in range(3):
        W.jsonl(docs.where(F.col("k") == k).drop("k"), f"{path}/set{k}", gzip=True)
    return R.manifest(spark, f"{path}/set*/*.json.gz", "doc_id long, lang string").select("doc_id", "lang")


@query(rf"""with {SPOKEN} select conv_id, turn, ltrim(string_agg(case when letters or i = 1 then ' ' || word else word end, '' order by i)) as text from spoken group by conv_id, turn""")
def attached_marks(spark: SparkSession, d: str) -> DataFrame:
    return _spoken(spark, d).where(F.size("words") > 0).select("conv_id", "turn", F.array_join(F.transform(Q.attached(F.col("words")), lambda w: w["word"]), " ").alias("text"))


@query(f"""with {ALIGNED} select item_id, array_to_string(list_transform(list_filter(words, lambda w: w."start" >= words[4]."start" - 0.0005 and w."end" <= words[7]."end" + 0.001), lambda w: w.word), ' ') as said from aligned""")
def answer_spans(spark: SparkSession, d: str) -> DataFrame:
    w = F.col("words")
    return _aligned(spark, d).select("item_id", Q.answer_words(w, F.get(w, F.lit(3))["start"] + 0.0005, F.get(w, F.lit(6))["end"]).alias("said"))


@query(f"""with {ALIGNED}, e as (select item_id, unnest(words) as w, unnest(range(1, len(words) + 1)) as pos from aligned),
s as (select item_id, pos, w, coalesce(sum(regexp_matches(w.word, '[.?!]$')::int) over (partition by item_id order by pos rows between unbounded preceding and 1 preceding), 0) as s from e),
t as (select item_id, s, string_agg(w.word, ' ' order by pos) as text, min(w."start") as a, max(w."end") as b from s group by item_id, s)
select item_id, coalesce(string_agg(text, '|' order by s) filter (where (a + b) / 2 between 2 and 10), '') as told from t group by item_id""")
def middle_sentences(spark: SparkSession, d: str) -> DataFrame:
    found = Q.sentences_between(Q.sentences(F.col("words")), F.lit(2.0), F.lit(10.0))
    return _aligned(spark, d).select("item_id", F.array_join(F.transform(found, lambda s: s["text"]), "|").alias("told"))


@query(f"""with {ALIGNED}, t as (select item_id, list_transform(words[1:item_id % 5], lambda w: w.word) as l from aligned)
select item_id, case when len(l) = 0 then '' when len(l) = 1 then l[1] when len(l) = 2 then l[1] || ' and ' || l[2] else array_to_string(l[1:len(l) - 1], ', ') || ', and ' || l[-1] end as told from t""")
def spoken_lists(spark: SparkSession, d: str) -> DataFrame:
    first = F.transform(F.slice("words", F.lit(1), (F.col("item_id") % 5).cast("int")), lambda w: w["word"])
    return _aligned(spark, d).select("item_id", text.oxford(first).alias("told"))


@query(f"""select doc_id, least(6, 1 + floor(ln(1 - {u_sql("decay", "doc_id")}) / ln(0.6::double)))::int as n from documents""")
def decaying_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", hashing.decaying_count(hashing.hash_u("decay", "doc_id"), 0.6, 1, 6).alias("n"))


@query("""select doc_id, case when n >= 1e6 then printf('%.1fM', n / 1e6::double) when n >= 1e3 then printf('%.1fK', n / 1e3::double) else n::varchar end as told from (select doc_id, doc_id * doc_id * 4 + 3 as n from documents)""")
def compact_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.short_number(F.col("doc_id") * F.col("doc_id") * 4 + 3).alias("told"))


@query("""select lang, case when lang in ('en', 'de') then 'second' else 'first' end as run, count(*) as n from documents group by lang""")
def output_folders(spark: SparkSession, d: str) -> DataFrame:
    """A folder for each language, written twice; the second run, of two languages, replaces their folders only."""
    path, docs = scratch(spark, "outputs"), table(spark, d, "documents").select("doc_id", "lang")
    W.outputs(docs.withColumn("run", F.lit("first")), path, "lang")
    W.outputs(docs.where("lang in ('en', 'de')").withColumn("run", F.lit("second")), path, "lang")
    return spark.read.schema("doc_id long, run string, lang string").json(path).groupBy("lang", "run").agg(F.count("*").alias("n"))


@query("""select lang, 'first' as run, count(*) as n from documents group by lang""")
def written_once(spark: SparkSession, d: str) -> DataFrame:
    """A sink that is there is left as it is."""
    path, docs = scratch(spark, "once"), table(spark, d, "documents").select("doc_id", "lang")
    W.jsonl(docs.withColumn("run", F.lit("first")), path, mode="ignore")
    W.jsonl(docs.limit(3).withColumn("run", F.lit("second")), path, mode="ignore")
    return spark.read.schema("doc_id long, lang string, run string").json(path).groupBy("lang", "run").agg(F.count("*").alias("n"))


@query("""select event_type, count(*) as n, round(sum(value), 2) as total from events group by event_type union all select 'all', count(*), round(sum(value), 2) from events""")
def statistics_table(spark: SparkSession, d: str) -> DataFrame:
    """A CSV table of groups, and a row that is appended."""
    e, path = table(spark, d, "events"), scratch(spark, "csv")
    figures = (F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    W.statistics_csv(e.groupBy("event_type").agg(*figures), path, ["event_type"])
    W.append_row(e.agg(*figures).select(F.lit("all").alias("event_type"), "n", "total"), path)
    return R.delimited(spark, f"{path}/*.csv", "event_type string, n long, total double")


@query("""select split, n, round(hours, 6) as hours, path from (select case when doc_id % 10 = 0 then 'test' else 'train' end as split, count(*) as n, sum(n_chars) / 15.0::double / 3600 as hours, 'data/' || case when doc_id % 10 = 0 then 'test' else 'train' end || '.jsonl' as path from documents group by all)""")
def split_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of an export, a JSON record for each split, with its statistics as CSV; read back and put together."""
    path = scratch(spark, "index")
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 0, "test").otherwise("train").alias("split"), (F.col("n_chars") / 15.0).alias("duration"))
    W.split_index(docs, path, "split", "duration")
    index = spark.read.schema("split string, path string").json(f"{path}/index")
    told = R.delimited(spark, f"{path}/statistics/*.csv", "split string, n long, hours double")
    return index.join(told, "split").select("split", "n", F.round("hours", 6).alias("hours"), "path")


@query("""select event_type as metric, max(value) as best, 2::bigint as runs from events group by event_type""")
def metrics_log(spark: SparkSession, d: str) -> DataFrame:
    """Nested metrics, appended run by run."""
    e, path = table(spark, d, "events"), scratch(spark, "metrics")
    for run in range(2):
        W.append_metrics(e.groupBy("event_type").agg(F.max("value").alias("v")).select(F.struct(F.lit(run).alias("run"), F.struct("event_type", "v").alias("best")).alias("metrics")), path)
    back = spark.read.schema("run int, best struct<event_type:string,v:double>").json(path)
    return back.groupBy(F.col("best.event_type").alias("metric")).agg(F.max("best.v").alias("best"), F.countDistinct("run").alias("runs"))


@query("""select string_agg(row, '' order by k) as card from (select 0 as k, '| region | nations |' || chr(10) || '| --- | --- |' || chr(10) as row union all select 1 + row_number() over (order by r_name), '| ' || r_name || ' | ' || n || ' |' || chr(10) from (select r_name, count(*) as n from region join nation on n_regionkey = r_regionkey group by r_name))""")
def dataset_card(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = both.groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("nations")).orderBy("region")
    return spark.createDataFrame([(W.markdown_table(rows),)], "card string")
