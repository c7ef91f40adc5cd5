"""Queries of §2.1 on annotation files, listings and streams: events are written in a format, one file a user, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import qa as Q
from ..operators import timeline as L
from ..operators import turns as T
from ..sources import markup as M
from ..sources import readers as R
from ..sources.scratch import scratch
from ..streaming import streams as S
from .qa_queries import ALIGNED, _aligned
from .tables import query, segments, segments_sql, table

ROOT = '<nite:root xmlns:nite="http://nite.sourceforge.net/">'


def _files(spark: SparkSession, d: str, name: str, head: str, line: Column, tail: str) -> str:
    """A file for each user, with a line for each of its events in the order of their ids; the pattern of their paths."""
    path = scratch(spark, name)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda s: s["line"])
    whole = table(spark, d, "events").groupBy("user_id").agg(F.concat(F.lit(head), F.array_join(lines, ""), F.lit(tail)).alias("value"))
    whole.write.partitionBy("user_id").text(path)
    return f"{path}/user_id=*"


def _user(c: str = "file") -> Column:
    return F.regexp_extract(c, r"user_id=(\d+)", 1).cast("long").alias("user_id")


def _id() -> Column:
    return F.col("event_id")


def _sec() -> Column:
    return F.format_string("%d.5", _id() % 1000)


@query("""select user_id, 'w' || event_id as id, row_number() over (partition by user_id order by event_id) - 1 as pos, case when event_id % 5 = 0 then '.' when event_id % 7 = 0 then event_type || '-' when event_id % 11 = 0 then '[laugh]' else event_type end as text,
 case when event_id % 13 = 0 then null else event_id % 1000 + 0.5::double end as "start", case when event_id % 5 = 0 then 'left' end as "join", not (event_id % 5 = 0 or (event_id % 11 = 0 and event_id % 7 <> 0)) as lex from events""")
def word_annotations(spark: SparkSession, d: str) -> DataFrame:
    start = F.when(_id() % 13 == 0, "").otherwise(F.concat(F.lit(' starttime="'), _sec(), F.lit('"')))
    tag = lambda more, text: F.concat(F.lit('<w nite:id="w'), _id(), F.lit('"'), start, F.lit(more), text, F.lit("</w>"))
    sound = F.concat(F.lit('<vocalsound nite:id="w'), _id(), F.lit('" type="laugh"'), start, F.lit("/>"))
    line = F.when(_id() % 5 == 0, tag(' punc="true">', F.lit("."))).when(_id() % 7 == 0, tag(' trunc="true">', F.col("event_type"))).when(_id() % 11 == 0, sound).otherwise(tag(">", F.col("event_type")))
    out = M.parsed(spark, _files(spark, d, "words", ROOT, line, "</nite:root>"), M.nxt_words, M.WORDS)
    return out.select(_user(), "id", "pos", "text", "start", "join", "lex")


@query("""select user_id, 's' || event_id as id, event_id % 1000 + 0.5::double as "start", 'w' || event_id as first_word, 'w' || (event_id + 3) as last_word from events""")
def segment_annotations(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit('<segment nite:id="s'), _id(), F.lit('" transcriber_start="'), _sec(), F.lit('"><nite:child href="a.words.xml#id(w'), _id(), F.lit(")..id(w"), _id() + 3, F.lit(')"/></segment>'))
    out = M.parsed(spark, _files(spark, d, "segments", ROOT, line, "</nite:root>"), M.nxt_segments, M.SEGMENTS)
    return out.select(_user(), "id", "start", "first_word", "last_word")


@query("""select user_id, 't' || event_id as id, null::varchar as parent, event_type as label, 'w' || event_id as first_word from events union all select user_id, 'u' || event_id, 't' || event_id, 'inner', null from events where event_id % 3 = 0""")
def topic_annotations(spark: SparkSession, d: str) -> DataFrame:
    inner = F.when(_id() % 3 == 0, F.concat(F.lit('<topic nite:id="u'), _id(), F.lit('" description="inner"/>'))).otherwise("")
    line = F.concat(F.lit('<topic nite:id="t'), _id(), F.lit('" description="'), F.col("event_type"), F.lit('"><nite:child href="a#id(w'), _id(), F.lit(')"/>'), inner, F.lit("</topic>"))
    out = M.parsed(spark, _files(spark, d, "topics", ROOT, line, "</nite:root>"), M.nxt_topics, M.TOPICS)
    return out.select(_user(), "id", "parent", "label", "first_word")


@query("""select user_id, 'a' || event_id as id, event_type as type, 'w' || event_id as first_word from events""")
def act_annotations(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit('<dact nite:id="a'), _id(), F.lit('"><nite:pointer role="da-aspect" href="t.xml#id('), F.col("event_type"), F.lit(')"/><nite:child href="a#id(w'), _id(), F.lit(')"/></dact>'))
    out = M.parsed(spark, _files(spark, d, "acts", ROOT, line, "</nite:root>"), M.nxt_acts, M.ACTS)
    return out.select(_user(), "id", "type", "first_word")


@query("""select user_id, 'x' || event_id as sentence, 'a' || event_id as act from events""")
def summary_links(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit('<summlink><nite:pointer role="extractive" href="d#id(a'), _id(), F.lit(')"/><nite:pointer role="abstractive" href="s#id(x'), _id(), F.lit(')"/></summlink>'))
    return M.parsed(spark, _files(spark, d, "links", ROOT, line, "</nite:root>"), M.nxt_links, M.LINKS).select(_user(), "sentence", "act")


@query("""select user_id, 'abstract' as section, row_number() over (partition by user_id order by event_id) - 1 as pos, 'x' || event_id as id, event_type || ' ' || event_id as text from events""")
def summary_sentences(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit('<sentence nite:id="x'), _id(), F.lit('">'), F.concat_ws(" ", "event_type", _id()), F.lit("</sentence>"))
    out = M.parsed(spark, _files(spark, d, "abstracts", ROOT + "<abstract>", line, "</abstract></nite:root>"), M.nxt_abstracts, M.ABSTRACTS)
    return out.select(_user(), "section", "pos", "id", "text")


@query("""with t as (select *, row_number() over (partition by user_id order by event_id) - 1 as turn from events)
select user_id, turn, 'Ann' as speaker, (event_id % 1000)::double as "start", event_id % 1000 + 1::double as "end", event_type || case when event_id % 4 = 0 then ' [rire]' else '' end as text, (event_id % 4 = 0)::bigint as events from t
union all select user_id, turn, 'Bob', (event_id % 1000)::double, event_id % 1000 + 1::double, 'oh', 0 from t union all select user_id, turn, 'Ann', event_id % 1000 + 1::double, event_id % 1000 + 2::double, 'next', 0 from t""")
def transcriber_turns(spark: SparkSession, d: str) -> DataFrame:
    at = lambda k: (_id() % 1000 + k).cast("string")
    event = F.when(_id() % 4 == 0, F.lit('<Event desc="rire"/>')).otherwise("")
    line = F.concat(F.lit('<Turn speaker="s1 s2" startTime="'), at(0), F.lit('" endTime="'), at(2), F.lit('"><Sync time="'), at(0), F.lit('"/><Who nb="1"/>'), F.col("event_type"), F.lit(" "), event, F.lit('<Who nb="2"/>oh<Sync time="'), at(1), F.lit('"/>next</Turn>'))
    head = '<Trans><Speakers><Speaker id="s1" name="Ann"/><Speaker id="s2" name="Bob"/></Speakers><Episode><Section>'
    return M.parsed(spark, _files(spark, d, "trs", head, line, "</Section></Episode></Trans>"), M.transcriber, M.TRANSCRIBER).select(_user(), "turn", "speaker", "start", "end", "text", "events")


@query("""select user_id, 'tier' as tier, event_id % 1000 + 0.5::double as "start", event_id % 1000 + 1.5::double as "end", event_type || ' "' || event_id || '"' as text from events""")
def textgrid_intervals(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "textgrid")
    end = F.format_string("%d.5", _id() % 1000 + 1)
    line = F.concat_ws("\n", _sec(), end, F.concat(F.lit('"'), "event_type", F.lit(' ""'), _id(), F.lit('"""')))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda s: s["line"])
    head = 'File type = "ooTextFile"\nObject class = "TextGrid"\n\n0\n2000\n<exists>\n1\n"IntervalTier"\n"tier"\n0\n2000\n'
    whole = table(spark, d, "events").groupBy("user_id").agg(F.concat(F.lit(head), F.count(F.lit(1)), F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("value"))
    whole.write.partitionBy("user_id").text(path)
    return M.parsed(spark, f"{path}/user_id=*", M.textgrid, M.TEXTGRID).select(_user(), "tier", "start", "end", "text")


@query("""select user_id, (event_id % 3)::double as "start", 10 + (event_id % 3)::double as "end", event_type as speaker, 'one' as text from events union all select user_id, 10 + (event_id % 3)::double, 20.0::double, event_type, 'two' from events""")
def tei_utterances(spark: SparkSession, d: str) -> DataFrame:
    k = (_id() % 3).cast("string")
    line = F.concat(F.lit('<u who="#'), "event_type", F.lit('" start="#A'), k, F.lit('" end="#T2">one<anchor synch="#B'), k, F.lit('"/>two</u>'))
    whens = '<when xml:id="T0"/>' + "".join(f'<when xml:id="A{i}" interval="{i}" since="#T0"/><when xml:id="B{i}" interval="10" since="#A{i}"/>' for i in range(3)) + '<when xml:id="T2" interval="20" since="#T0"/>'
    head = f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><timeline>{whens}</timeline>'
    return M.parsed(spark, _files(spark, d, "tei", head, line, "</TEI>"), M.tei, M.TEI).select(_user(), "start", "end", "speaker", "text")


@query("""select user_id, row_number() over (partition by user_id order by event_id) - 1 as pos, event_type as word, event_id % 1000 + 0.5::double as "start" from events""")
def word_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "whisper")
    word = F.struct(F.col("event_type").alias("word"), (_id() % 1000 + 0.5).alias("start"), (_id() % 1000 + 0.7).alias("end"))
    words = F.transform(F.array_sort(F.collect_list(F.struct("event_id", word.alias("w")))), lambda s: s["w"])
    rows = table(spark, d, "events").groupBy("user_id").agg(words.alias("words"))
    cut = F.floor(F.size("words") / 2).cast("int")
    parts = F.array(F.struct(F.slice("words", F.lit(1), cut).alias("words")), F.struct(F.slice("words", cut + 1, F.size("words")).alias("words")))
    rows.select("user_id", F.to_json(F.struct(parts.alias("segments"))).alias("value")).write.partitionBy("user_id").text(path)
    return R.whisper_words(spark, f"{path}/user_id=*").select(_user(), F.col("pos").cast("long").alias("pos"), "word", "start")


@query("""select user_id, count(*) as rows from events group by user_id""")
def index_sidecars(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "idx")
    rows = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    rows.select("user_id", F.repeat(F.lit("x"), (8 * (F.col("n") + 1) - 1).cast("int")).alias("value")).write.partitionBy("user_id").text(path)
    return R.index_rows(spark, f"{path}/user_id=*").select(_user(), "rows")


@query("""select 'user_id=' || user_id as parent, 1::bigint as files from (select distinct user_id from events)""")
def audio_listing(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "audio")
    table(spark, d, "events").select("user_id").distinct().withColumn("value", F.lit("x")).write.partitionBy("user_id").text(path)
    return R.audio_index(spark, path, ("txt",), exclude=["_SUCCESS"]).groupBy("parent").agg(F.count(F.lit(1)).alias("files"))


@query("""select 'c' || c_custkey as stem, c_name || ' "x' as text from customer where c_custkey in (select o_custkey from orders)""")
def clip_table(spark: SparkSession, d: str) -> DataFrame:
    """An unquoted table of clips, joined to the stems that a manifest has."""
    path = scratch(spark, "clips") + ".tsv"
    c = table(spark, d, "customer").select(F.concat_ws("\t", F.concat(F.lit("a/c"), "c_custkey", F.lit(".mp3")), F.concat("c_name", F.lit(' "x'))).alias("value"))
    c.select(F.concat(F.lit("path\ttext\n"), "value")).write.text(path)
    keep = table(spark, d, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("stem"))
    out = R.clip_index(spark, path, "path string, text string", "path", keep)
    return out.where("path <> 'path'").select("stem", "text")


@query("""select c_custkey::varchar as key, c_name as name, c_mktsegment as segment from customer where c_custkey % 4 <> 0""")
def headerless_fields(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "fields")
    short = F.col("c_custkey") % 4 == 0
    table(spark, d, "customer").select(F.when(short, F.concat_ws("\t", "c_custkey", "c_name")).otherwise(F.concat_ws("\t", "c_custkey", "c_name", "c_mktsegment"))).write.text(path)
    return R.fields(spark, path, ["key", "name", "segment"])


@query("""select c_nationkey::bigint as step, 's' as dataset, 'n' as metric, count(*)::double as value from customer group by c_nationkey""")
def results_of_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "results")
    rows = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    rows.select("step", F.format_string('{"s": {"n": %d, "lang": "fr"}}', "n").alias("value")).write.partitionBy("step").text(path)
    return R.results(spark, path, "part-*")


def _streamed(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of JSON lines, with the time of each."""
    path = scratch(spark, "stream")
    segments(spark, d).select("recording", "seg_id", "start", "text").write.json(path)
    rows = S.manifest_stream(spark, path, "recording long, seg_id long, start double, text string", 10_000)
    return rows.withColumn("ts", F.timestamp_micros(F.round(F.col("start") * 1e6).cast("long")))


def _drained(df: DataFrame, name: str, mode: str) -> DataFrame:
    """All that a stream gives for what is there now: a table of the shared folder."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", path + "-state").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", path).start().awaitTermination()
    else:  # each batch holds the whole result so far
        writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query(f"""with {segments_sql()}, g as (select recording, "start", case when "start" - lag("start") over w <= 7200 then 0 else 1 end as new from segments window w as (partition by recording order by "start")),
s as (select *, sum(new) over (partition by recording order by "start") as k from g) select recording, round(min("start"), 3) as "start", round(max("start") + 7200, 3) as "end", count(*) as n from s group by recording, k""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    out = _drained(S.sessions(_streamed(spark, d), "ts", ["recording"], "2 hours", "1 hour"), "sessions", "complete")
    return out.select("recording", F.round(F.unix_micros("start") / 1e6, 3).alias("start"), F.round(F.unix_micros("end") / 1e6, 3).alias("end"), "n")


@query(f"""with {segments_sql()} select recording, floor("start" / 86400) * 86400.0::double as "start", count(*) as n from segments group by 1, 2""")
def stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    out = _drained(S.windowed_counts(_streamed(spark, d), "ts", ["recording"], "1 day", "1 hour"), "counts", "complete")
    return out.select("recording", (F.unix_micros("start") / 1e6).alias("start"), "n")


@query(f"""with {segments_sql()} select seg_id, text || '.' as text, false as dropped from segments""")
def stream_cleaning(spark: SparkSession, d: str) -> DataFrame:
    rows = _streamed(spark, d).select("seg_id", "text")
    out = _drained(S.cleaned_stream(rows, C.resolved(["drop_unknown_brackets", "add_final_period"], {})), "cleaned", "append")
    return out.select("seg_id", "text", F.col("dropped_by").isNotNull().alias("dropped"))


@query(f"""with {segments_sql()}, n as (select *, lead(event) over w as after from (select *, case when seg_id % 3 = 0 then 'The end' when seg_id % 3 = 1 then 'Gange' else 'He said so' end as event from segments) window w as (partition by recording order by "start", "end", seg_id))
select recording, seg_id, event || case when after = 'The end' then '.' else '' end as text from n""")
def period_if_next_sentence(spark: SparkSession, d: str) -> DataFrame:
    cue = F.when(F.col("seg_id") % 3 == 0, "The end").when(F.col("seg_id") % 3 == 1, "Gange").otherwise("He said so")
    return L.sentence_follows(segments(spark, d).withColumn("text", cue), ["the", "a"]).select("recording", "seg_id", "text")


@query("""select vec_id || '_qa' as id, 'what is ' || label || '?' as question, 'v' || vec_id || '.wav' as audio, vec_id / 10.0::double as duration, label::varchar as answer from embeddings""")
def question_records(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.concat(F.lit("what is "), "label", F.lit("?")).alias("q"), F.concat(F.lit("v"), "vec_id", F.lit(".wav")).alias("a"), (F.col("vec_id") / 10.0).alias("s"), F.col("label").cast("string").alias("y"))
    turn = lambda k, f: F.get("conversations", F.lit(k))[f]
    return T.qa_record(e, "vec_id", "qa", "q", "a", "s", "y").select("id", turn(0, "value").alias("question"), turn(1, "value").alias("audio"), turn(1, "duration").alias("duration"), turn(2, "value").alias("answer"))


@query(f"""with {ALIGNED}, s as (select item_id, lower(words[3].word || ' ' || words[4].word) as given, array_to_string(list_transform(list_filter(words, lambda w: w."start" >= 1.499 and w."end" <= words[4]."end" + 0.001), lambda w: w.word), ' ') as own from aligned)
select item_id, case when lower(own) = given then own else given end as said from s""")
def cased_answers(spark: SparkSession, d: str) -> DataFrame:
    w = _aligned(spark, d)
    given = F.lower(F.concat_ws(" ", F.get("words", F.lit(2))["word"], F.get("words", F.lit(3))["word"]))
    return w.select("item_id", Q.cased_answer(F.col("words"), F.lit(1.5), F.get("words", F.lit(3))["end"], given).alias("said"))


@query("""select user_id, regexp_replace(regexp_replace(string_agg(case when event_id % 5 = 0 then chr(1) || '.' when event_id % 7 = 0 then event_type || chr(2) else event_type end, ' ' order by event_id), ' ' || chr(1), '', 'g'), chr(2) || ' ?|^' || chr(1), '', 'g') as text from events group by user_id""")
def detokenised_words(spark: SparkSession, d: str) -> DataFrame:
    join = F.when(_id() % 5 == 0, "left").when(_id() % 7 == 0, "right")
    word = F.struct("event_id", F.when(_id() % 5 == 0, ".").otherwise(F.col("event_type")).alias("text"), join.alias("join"))
    return table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(word)).alias("w")).select("user_id", T.detokenised(F.col("w")).alias("text"))
