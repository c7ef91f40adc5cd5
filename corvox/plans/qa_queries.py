"""Queries of §2.8 and §2.10 on time-aligned words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import qa as Q
from ..operators import rebuild as R
from .tables import query, table

ALIGNED = """raw as (select item_id, list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') as r from benchmark), aligned as (select item_id, list_transform(range(1, len(r) + 1), lambda i: struct_pack(word := r[i], "start" := (i * 0.5)::double, "end" := (i * 0.5)::double + length(r[i]) * 0.05::double)) as words from raw)"""


def _aligned(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, words): held-out texts with a word every half second, each as long as its letters."""
    r = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    words = F.transform(r, lambda w, i: F.struct(w.alias("word"), ((i + 1) * 0.5).alias("start"), ((i + 1) * 0.5 + F.length(w) * 0.05).alias("end")))
    return table(spark, d, "benchmark").select("item_id", words.cast(Q.WORDS).alias("words"))


@query(f"""with {ALIGNED} select item_id, len(words)::int as n, round(words[1]."start", 4) as first_start, round(words[-1]."end", 4) as last_end, round(100 - list_max(list_transform(words, lambda w: w."end")), 4) as trailing_gap,
 round(list_max(list_transform(range(2, len(words) + 1), lambda i: words[i]."start" - words[i - 1]."end")), 4) as longest_pause from aligned""")
def word_times(spark: SparkSession, d: str) -> DataFrame:
    w = F.col("words")
    return _aligned(spark, d).select("item_id", F.size(w).alias("n"), F.round(F.get(w, F.lit(0))["start"], 4).alias("first_start"), F.round(F.try_element_at(w, F.lit(-1))["end"], 4).alias("last_end"), F.round(Q.trailing_gap(w, F.lit(100.0)), 4).alias("trailing_gap"), F.round(Q.longest_pause(w), 4).alias("longest_pause"))


@query(f"""with {ALIGNED}, e as (select item_id, unnest(words) as w, unnest(range(len(words))) as pos from aligned), s as (select item_id, pos, w, coalesce(sum(regexp_matches(w.word, '[.?!]$')::int) over (partition by item_id order by pos rows between unbounded preceding and 1 preceding), 0) as s from e)
select item_id, s::int as sentence, string_agg(w.word, ' ' order by pos) as text, round(min(w."start"), 4) as "start", round(max(w."end"), 4) as "end", count(*)::int as n from s group by item_id, s""")
def sentence_spans(spark: SparkSession, d: str) -> DataFrame:
    s = _aligned(spark, d).select("item_id", F.posexplode(Q.sentences(F.col("words"))).alias("sentence", "s"))
    return s.select("item_id", "sentence", "s.text", F.round("s.start", 4).alias("start"), F.round("s.end", 4).alias("end"), "s.n")


#: Turns as timed tokens: marks are tokens of their own without a time, two thirds of the turns have lost theirs; in half
#: of the conversations a silence stands before every ninth token, in all a long one before every fiftieth, and each
#: eleventh token has lost its time.
SPOKEN = r"""raw as (select conv_id, turn, regexp_extract_all(case when (conv_id + turn) % 3 = 0 then text else regexp_replace(text, '[.?!]', '', 'g') end, '[\p{L}\p{N}''-]+|[^\s\p{L}\p{N}''-]+') as r from conversations),
tok as (select conv_id, turn, unnest(range(1, len(r) + 1)) as i, unnest(r) as word from raw),
spoken as (select conv_id, turn, i, word, regexp_matches(word, '[\p{L}\p{N}]') as letters, regexp_matches(word, '[.?!]$') as stop, case when not regexp_matches(word, '[\p{L}\p{N}]') or i % 11 = 0 then -1.0 else i * 0.5 + case when conv_id % 2 = 0 then i // 9 * 1.25 else 0 end + i // 50 * 20.0 end::double as "start",
 case when not regexp_matches(word, '[\p{L}\p{N}]') or i % 11 = 0 then -1.0 else i * 0.5 + case when conv_id % 2 = 0 then i // 9 * 1.25 else 0 end + i // 50 * 20.0 + 0.25 end::double as "end" from tok)"""


def _spoken(spark: SparkSession, d: str) -> DataFrame:
    """(conv_id, turn, words): turns as timed tokens, as in SPOKEN."""
    text = F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.col("text")).otherwise(F.regexp_replace("text", "[.?!]", ""))
    tokens = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}'-]+|[^\s\p{L}\p{N}'-]+"), 0)

    def timed_token(w: Column, i: Column) -> Column:
        at = (i + 1) * 0.5 + F.when(F.col("conv_id") % 2 == 0, F.floor((i + 1) / 9) * 1.25).otherwise(0.0) + F.floor((i + 1) / 50) * 20.0
        lost = ~w.rlike(Q.LETTERS) | ((i + 1) % 11 == 0)
        return F.struct(w.alias("word"), F.when(lost, -1.0).otherwise(at).alias("start"), F.when(lost, -1.0).otherwise(at + 0.25).alias("end"))

    return table(spark, d, "conversations").select("conv_id", "turn", F.transform(tokens, timed_token).cast(Q.WORDS).alias("words"))


@query(rf"""with recursive {SPOKEN}, w as (select *, row_number() over (partition by conv_id, turn order by i) as k from spoken where not letters or "start" >= 0),
f(conv_id, turn, k, is_open, a, b, n, sid, own) as (
 select conv_id, turn, 0::bigint, false, 0.0::double, 0.0::double, 0::bigint, 0::bigint, -1::bigint from (select distinct conv_id, turn from w)
 union all
 select conv_id, turn, k, (is_open or letters) and not (stop or letters and (n >= 35 or b - a >= 18)), a, b, n, sid, case when is_open or letters then sid else -1 end from (
  select conv_id, turn, k, is_open, letters, stop, case when fresh then s else a end as a, case when letters then e else b end as b, (case when fresh then 0 else n end + letters::int)::bigint as n, sid + fresh::int as sid from (
   select f.conv_id, f.turn, w.k, f.is_open, f.a, f.b, f.n, f.sid, w.letters, w.stop, w."start" as s, w."end" as e, w.letters and (not f.is_open or w."start" - f.b >= 1 and f.n >= 5) as fresh from f join w on w.conv_id = f.conv_id and w.turn = f.turn and w.k = f.k + 1)))
select conv_id, turn, (own - 1)::int as sentence, ltrim(string_agg(case when letters then ' ' || word else word end, '' order by k)) as text, round(min(case when letters then "start" end), 4) as "start", round(max(case when letters then "end" end), 4) as "end", count(*) filter (where letters)::int as n
from f join w using (conv_id, turn, k) where own >= 0 group by conv_id, turn, own""")
def built_sentences(spark: SparkSession, d: str) -> DataFrame:
    s = _spoken(spark, d).select("conv_id", "turn", F.posexplode(Q.built_sentences(F.col("words"))).alias("sentence", "s"))
    return s.select("conv_id", "turn", "sentence", "s.text", F.round("s.start", 4).alias("start"), F.round("s.end", 4).alias("end"), "s.n")


@query(f"""with {ALIGNED}, t as (select item_id, words, lower(regexp_replace(words[3].word, '[^\\p{{L}}\\p{{N}}''-]', '', 'g')) as term from aligned)
select item_id, term, array_to_string(list_transform(list_filter(words, lambda w: lower(regexp_replace(w.word, '[^\\p{{L}}\\p{{N}}''-]', '', 'g')) = term), lambda w: printf('%.2f', w."start")), ',') as times from t""")
def word_occurrences(spark: SparkSession, d: str) -> DataFrame:
    term = F.lower(F.regexp_replace(F.get("words", F.lit(2))["word"], r"[^\p{L}\p{N}'-]", ""))
    t = _aligned(spark, d).withColumn("term", term)
    return t.select("item_id", "term", F.array_join(F.transform(Q.occurrences(F.col("words"), F.col("term")), lambda s: F.format_string("%.2f", s)), ",").alias("times"))


@query(f"""with {ALIGNED} select item_id, array_to_string(list_transform(list_filter(words, lambda w: w."start" >= 2 and w."end" <= 6), lambda w: w.word), ' ') as said from aligned""")
def exact_window_text(spark: SparkSession, d: str) -> DataFrame:
    return _aligned(spark, d).select("item_id", Q.window_words(F.col("words"), F.lit(2.0), F.lit(6.0)).alias("said"))


@query(f"""with {ALIGNED} select item_id, array_to_string(list_transform(words, lambda w: '[' || printf('%.2f', w."start") || '-' || printf('%.2f', w."end") || '] ' || w.word), chr(10)) as brackets, array_to_string(list_transform(words, lambda w: printf('%.2f', w."start") || 's: ' || w.word), chr(10)) as seconds from aligned""")
def timestamped_transcription(spark: SparkSession, d: str) -> DataFrame:
    units = F.transform("words", lambda w: F.struct(w["word"].alias("text"), w["start"].alias("start"), w["end"].alias("end")))
    return _aligned(spark, d).select("item_id", Q.rendered(units, "brackets").alias("brackets"), Q.rendered(units, "seconds").alias("seconds"))


def _units(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    unit = F.struct("event_id", F.col("event_type").alias("speaker"), F.concat(F.lit("t"), "event_id").alias("text"), (F.col("event_id") % 1000).cast("double").alias("start"), (F.col("event_id") % 1000 + 1.25).alias("end"))
    return e.groupBy("user_id").agg(F.array_sort(F.collect_list(unit)).alias("units"))


@query("""select user_id, string_agg(event_type || ': t' || event_id, chr(10) order by event_id) as colon, string_agg('SPEAKER audio 1 ' || printf('%.2f', (event_id % 1000)::double) || ' 1.25 <NA> <NA> ' || event_type || ' <NA> <NA>', chr(10) order by event_id) as rttm from events group by user_id""")
def diarization_formats(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("units")
    return _units(spark, d).select("user_id", Q.rendered_speakers(u, "colon").alias("colon"), Q.rendered_speakers(u, "rttm").alias("rttm"))


def clock_sql(x: str, mark: str) -> str:
    """hh:mm:ss and milliseconds in SQL."""
    ms = f"round({x} * 1000)::bigint"
    return f"printf('%02d:%02d:%02d{mark}%03d', {ms} // 3600000, {ms} % 3600000 // 60000, {ms} % 60000 // 1000, {ms} % 1000)"


@query(rf"""with u as (select *, (event_id % 1000)::double as a, event_id % 1000 + 1.25::double as b, row_number() over (partition by user_id order by event_id) as k from events),
t as (select *, {clock_sql("a", ",")} || ' --> ' || {clock_sql("b", ",")} as srt, {clock_sql("a", ".")} || ' --> ' || {clock_sql("b", ".")} as vtt from u)
select user_id, string_agg(k || chr(10) || srt || chr(10) || event_type || ': t' || event_id || chr(10), chr(10) order by event_id) as srt,
 'WEBVTT' || chr(10) || chr(10) || string_agg(vtt || chr(10) || '<v ' || event_type || '>t' || event_id || chr(10), chr(10) order by event_id) as vtt,
 '[' || string_agg('{{"speaker":"' || event_type || '","start":' || a::varchar || ',"end":' || b::varchar || ',"text":"t' || event_id || '"}}', ',' order by event_id) || ']' as json,
 string_agg('[' || event_type || '] t' || event_id, chr(10) order by event_id) as brackets, string_agg(printf('%.2f-%.2f ', a, b) || event_type, chr(10) order by event_id) as times,
 string_agg(printf('%.2f', a) || chr(9) || printf('%.2f', b) || chr(9) || event_type || chr(9) || 't' || event_id, chr(10) order by event_id) as tsv, string_agg('<' || event_type || '> t' || event_id, chr(10) order by event_id) as angle from t group by user_id""")
def subtitle_formats(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("units")
    return _units(spark, d).select("user_id", *(Q.rendered_speakers(u, f).alias(f) for f in ("srt", "vtt", "json", "brackets", "times", "tsv", "angle")))


KEY = "lower(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}''-]', '', 'g'))"


@query(rf"""with {ALIGNED}, e as (select item_id, unnest(words) as w, unnest(range(1, len(words) + 1)) as pos from aligned),
s as (select item_id, pos, w, coalesce(sum(regexp_matches(w.word, '[.?!]$')::int) over (partition by item_id order by pos rows between unbounded preceding and 1 preceding), 0) as s from e),
sentences as (select item_id, s, string_agg(w.word, ' ' order by pos) as text, min(w."start") as a, max(w."end") as b from s group by item_id, s),
t as (select item_id, words, words[3].word as term, 3.1::double as moment, list_transform(list_filter(words, lambda w: {KEY.format('w.word')} = lower(words[3].word)), lambda w: w."start") as starts from aligned),
said as (select *, list_transform(starts, lambda x: printf('%.2f s', x)) as l from t),
near as (select item_id, arg_min(s.text, (not (s.a <= moment and s.b >= moment), case when s.a <= moment and s.b >= moment then s.s else abs((s.a + s.b) / 2 - moment) end, s.s)) as text from t join sentences s using (item_id) group by item_id),
holds as (select item_id, arg_min(s.text, s.s) as text from t join sentences s using (item_id) where contains(lower(s.text), lower(term)) group by item_id),
every as (
 select item_id, 'word2time' as task, 'When is ' || term || ' said?' as question, case when len(l) = 0 then 'It is not said.' when len(l) = 1 then l[1] when len(l) = 2 then l[1] || ' and ' || l[2] else array_to_string(l[1:len(l) - 1], ', ') || ', and ' || l[-1] end as answer from said
 union all select item_id, 'time2word', 'Which word is said at 3.10 s?', list_filter(words, lambda w: w."start" <= moment and w."end" >= moment)[1].word from t
 union all select item_id, 'time2sentence', 'Which sentence is said at 3.10 s?', text from near
 union all select t.item_id, 'word2sentence', 'In which sentence is ' || term || ' said?', text from t left join holds using (item_id)
 union all select item_id, 'answer_with_json', 'Give the times of ' || term || ' as JSON.', '{{"word":"' || term || '","starts":[' || array_to_string(list_transform(starts, lambda x: x::varchar), ',') || ']}}' from t)
select * from every where answer is not null""")
def time_tasks(spark: SparkSession, d: str) -> DataFrame:
    w = _aligned(spark, d).withColumn("term", F.get("words", F.lit(2))["word"]).withColumn("at", F.lit(3.1))
    return Q.tasks(w)


@query(rf"""with {ALIGNED}, k as (select *, list_filter(list_transform(words, lambda w: lower(regexp_replace(w.word, '[^\p{{L}}]', '', 'g'))), lambda x: length(x) >= 5) as keys,
 list_sort(list_filter(['the', 'moon', 'river'], lambda c: len(list_filter(words, lambda w: lower(w.word) = c)) = 0)) as free, ('0x' || substr(md5('oov:' || item_id), 1, 8))::bigint / 4294967296.0::double as u from aligned)
select item_id, len(list_filter(range(1, len(words) + 1), lambda i: (i = 1 or abs(words[i]."start" - words[i - 1]."start") >= 0.15) and (i = len(words) or abs(words[i]."start" - words[i + 1]."start") >= 0.15)))::int as n_clear,
 array_to_string(list_filter(keys, lambda x: len(list_filter(keys, lambda o: o = x)) = 1), ' ') as content, free[floor(u * len(free))::int + 1] as unheard, list_filter(words, lambda w: w."start" >= 1)[3]."end" as phrase_end from k""")
def word_choices(spark: SparkSession, d: str) -> DataFrame:
    w = F.col("words")
    oov = Q.out_of_vocabulary(F.array(*map(F.lit, ("the", "moon", "river"))), w, hashing.hash_u("oov", "item_id"))
    return _aligned(spark, d).select("item_id", F.size(Q.unambiguous(w)).alias("n_clear"), F.array_join(Q.content_words(w), " ").alias("content"), oov.alias("unheard"), Q.phrase_end(w, F.lit(1.0), F.lit(3)).alias("phrase_end"))


@query("""select conv_id, turn, len(w) between 1 and 4 and len(list_filter(w, lambda x: x not in ('the', 'of', 'and', 'is', 'in'))) = 0 as backchannel, array_to_string(list_filter(string_split(text, ' '), lambda x: lower(regexp_replace(x, '[^\\p{L}''-]', '', 'g')) not in ('the', 'of', 'and', 'is', 'in')), ' ') as stripped
from (select *, list_filter(string_split_regex(lower(text), '[^\\p{L}''-]+'), lambda x: x <> '') as w from conversations)""")
def backchannels(spark: SparkSession, d: str) -> DataFrame:
    fillers = ["the", "of", "and", "is", "in"]
    t = F.col("text")
    return table(spark, d, "conversations").select("conv_id", "turn", Q.is_backchannel(t, fillers).alias("backchannel"), Q.without_fillers(t, fillers).alias("stripped"))


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    raw = F.filter(F.transform(words, lambda w, i: F.when(i % 17 != 5, F.lower(F.regexp_replace(w, r"[.,]", "")))), lambda w: w.isNotNull())
    return table(spark, d, "benchmark").select("item_id", F.array_join(raw, " ").alias("raw"), "text")


@query()
def format_transfer(spark: SparkSession, d: str) -> DataFrame:
    return R.transferred(_damaged(spark, d), "raw", "text").select("item_id", "text", "ratio")


@query()
def redistribution(spark: SparkSession, d: str) -> DataFrame:
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    cuts = table(spark, d, "benchmark").select("item_id", F.array(F.array_join(F.slice(words, 1, 10), " "), F.array_join(F.slice(words, 11, 10), " "), F.array_join(F.slice(words, F.lit(21), F.greatest(F.size(words) - 20, F.lit(0))), " ")).alias("pieces"))
    return R.redistributed(_damaged(spark, d).drop("text").join(cuts, "item_id"), "raw", "pieces").select("item_id", "piece", "text")


@query("""with c as (select lower(w) as w, count(*) as n from (select unnest(regexp_extract_all(text, '\\p{L}+')) as w from documents) group by 1), p as (select strip_accents(w) as plain, w, n from c)
select plain, w as accented from (select a.plain, a.w, row_number() over (partition by a.plain order by a.n desc, a.w) as rn from p a left join p b on b.w = a.plain where a.w <> a.plain and a.n > 5 * coalesce(b.n, 0) and a.n >= 5) where rn = 1""")
def accent_restoration(spark: SparkSession, d: str) -> DataFrame:
    return R.accent_table(table(spark, d, "documents").select("text"))


def _rebuild_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Held-out texts as segments of one second, some windows twice, and their damaged raw texts, of which some are missing."""
    t = _damaged(spark, d).withColumn("recording", F.col("item_id") % 5).withColumn("start", F.col("item_id").cast("double"))
    own = t.select("recording", F.concat(F.lit("s"), "item_id").alias("seg_id"), "start", (F.col("start") + 1).alias("end"), "text")
    twice = own.where(F.col("start") % 4 == 0).select("recording", F.concat("seg_id", F.lit("b")).alias("seg_id"), "start", "end", "text")
    reason = F.when(F.col("item_id") % 9 == 0, "censored")
    raws = t.where("item_id % 7 <> 0").select("recording", "start", (F.col("start") + 1).alias("end"), F.when(reason.isNull(), F.col("raw")).alias("raw"), reason.alias("reason"))
    return own.unionByName(twice), raws


@query()
def windowed_rebuild(spark: SparkSession, d: str) -> DataFrame:
    return R.rebuilt_windows(*_rebuild_inputs(spark, d))


@query()
def cut_aware_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Each segment in two pieces of half a second, rebuilt from the raw text of the whole."""
    own, raws = _rebuild_inputs(spark, d)
    words = F.split("text", r"\s+")
    half = F.ceil(F.size(words) / 2).cast("int")
    pieces = F.array(F.struct(F.lit(1).alias("k"), F.array_join(F.slice(words, F.lit(1), half), " ").alias("t")), F.struct(F.lit(2).alias("k"), F.array_join(F.slice(words, half + 1, F.size(words)), " ").alias("t")))
    cut = own.where(~F.col("seg_id").endswith("b")).withColumn("p", F.explode(pieces))
    cut = cut.select("recording", F.concat("seg_id", F.lit("_cut"), F.col("p.k")).alias("seg_id"), (F.col("start") - 0.5 + F.col("p.k") * 0.5).alias("start"), (F.col("start") + F.col("p.k") * 0.5).alias("end"), F.col("p.t").alias("text"))
    return R.rebuilt_cuts(cut, raws)
